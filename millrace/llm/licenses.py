"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A block is a line. It meets a template if it holds at least ``CONTAINMENT`` of the
template's distinct words. Words are ordered by their frequency over all documents,
rare ones first. A block that meets a template of n words with at least k of them has
one of the template's first n - k + 1 words, so the join runs on these prefixes. A
pair is then dropped by length (too few words of any template in the block) or by
position (too few words left behind the shared one), and the rest is counted exactly.
The templates are a fixed list, so their table has a fixed size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrase -> label of the base scan.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# (label, template text); opening sentences of public licenses and the notices that name them.
TEMPLATES = (
    ("mit", "released under the MIT license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache", "licensed under the Apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the "
               "license at http www apache org licenses"),
    ("gpl", "licensed under the GNU general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the GNU "
            "general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under CC BY NC 4 0"),
    ("cc-by", "this work is licensed under a Creative Commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the Mozilla public license"),
)
CONTAINMENT = 0.8


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case. ``lower`` does that fast; only the Kelvin sign would become an ASCII letter."""
    upper = "".join(map(chr, range(65, 91)))
    return F.when(F.contains(text, F.lit("K")), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def words_of(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def template_words(text: str) -> frozenset[str]:
    return frozenset(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))


def _needed(size: int, containment: float) -> int:
    """The least overlap that meets the threshold; the small slack keeps exact multiples exact."""
    return max(1, math.ceil(size * containment - 1e-9))


def _starts(words: Column, phrase: str) -> Column:
    """The places where the phrase's words stand, as an array."""
    parts = phrase.split()
    every = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.filter(
        every, lambda i: reduce(Column.__and__, [F.get(words, i + k) == part for k, part in enumerate(parts)])
    )


def _block_matches(
    bodies: DataFrame, templates: Sequence[tuple[str, str]], containment: float, frequency: Mapping[str, int]
) -> DataFrame:
    """(key, label, score) of every block of ``bodies(key, body)`` that meets a template."""
    spark = bodies.sparkSession
    rank = {w: i for i, w in enumerate(sorted(frequency, key=lambda w: (frequency[w], w)))}
    prefixes = []
    for number, (label, text) in enumerate(templates):
        ordered = sorted(template_words(text), key=rank.__getitem__)
        needed = _needed(len(ordered), containment)
        for place, word in enumerate(ordered[: len(ordered) - needed + 1]):
            prefixes.append((rank[word], number, label, place, needed, ordered))
    table = spark.createDataFrame(
        prefixes, "rank int, template int, label string, place int, needed int, ordered array<string>"
    )
    in_order = F.array(*[F.lit(w) for w in rank])
    letters = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
    first = "|".join(sorted({re.escape(list(rank)[p[0]]) for p in prefixes}))
    some_prefix = f"(?<!{letters})(?:{first})(?!{letters})"
    blocks = bodies.select("key", F.explode(F.filter(F.split("body", "\n"), lambda line: line.rlike(some_prefix))))
    # Words outside all templates cannot add to an overlap; what is left is in frequency order.
    blocks = blocks.select("key", F.array_intersect(in_order, words_of(F.col("col"))).alias("own"))
    tokens = blocks.select("key", "own", F.posexplode("own").alias("at", "word"))
    joined = tokens.select("*", (F.array_position(in_order, F.col("word")) - 1).cast("int").alias("rank")).join(
        F.broadcast(table), "rank"
    )
    length = F.size("own") >= F.col("needed")
    left = F.least(F.size("ordered") - F.col("place"), F.size("own") - F.col("at"))
    # The first shared word sees all the overlap; later ones would only find the pair again.
    position = left >= F.col("needed")
    overlap = F.size(F.array_intersect("own", "ordered"))
    found = joined.filter(length & position).select("key", "label", "needed", overlap.alias("n"), F.size("ordered").alias("of"))
    return found.filter("n >= needed").select("key", "label", (F.col("n") / F.col("of")).alias("score"))


def scan(
    df: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``df``: key, ``n_words``, phrase places, labels and ``score``.

    ``labels`` joins those of the phrases and of the templates met; ``score`` is 1 where
    a phrase stands, else the greatest containment found, else 0. NULL texts count as
    empty: no words, no labels. Rows with the same key are judged each by its own text.
    Other columns are ignored; an empty table gives no rows.
    """
    bodies = df.select(F.col(key).alias("id"), ascii_lower(F.coalesce(F.col(text), F.lit(""))).alias("body"))
    # A row is known by its key and two hashes of its text, so rows that share a key keep apart.
    row = F.struct("id", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(1), "body").alias("h2"))
    bodies = bodies.select(row.alias("key"), "body")
    vocabulary = sorted(set().union(*(template_words(t) for _, t in templates)))
    literals = F.array(*[F.lit(w) for w in vocabulary])
    seen = bodies.select(F.explode(F.array_intersect(literals, words_of(F.col("body")))).alias("word"))
    counts = {r["word"]: r["count"] for r in seen.groupBy("word").count().collect()}  # one row per template word
    frequency = {w: counts.get(w, 0) for w in vocabulary}
    met = _block_matches(bodies, templates, containment, frequency).groupBy("key").agg(
        F.collect_set("label").alias("met"), F.max("score").alias("best")
    )
    split = bodies.select("key", "body", words_of(F.col("body")).alias("words"))
    words = F.col("words")
    none = F.array().cast("array<int>")
    places = [
        F.when(F.contains("body", F.lit("license")), _starts(words, phrase)).otherwise(none).alias(f"p{i}")
        for i, phrase in enumerate(PHRASES)
    ]
    placed = split.select("key", F.size("words").cast("long").alias("n_words"), *places)
    every = F.concat(*[F.col(f"p{i}") for i in range(len(PHRASES))])
    found = [F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]
    base = placed.select(
        "key", "n_words", every.alias("every"), F.array_sort(F.array_compact(F.array(*found))).alias("base")
    )
    joined = base.join(met, "key", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("met", F.array().cast("array<string>"))))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return joined.select(
        F.col("key.id").alias(key), "n_words", F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"), F.array_max("every").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )
