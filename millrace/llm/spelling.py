"""Spelling variants by generation over a reduced alphabet.

Letters are hashed to eight symbols, so a word of length L has a one-edit neighbourhood
of about 16 L reduced words instead of some 180 L words. The steps:

1. all words are counted; each gets the key of its reduced word;
2. every distinct reduced word generates its one-edit neighbourhood, which is joined with
   the reduced vocabulary. Two reduced words that are one edit apart need be found from one
   end only: insertions are found as deletions of the longer word, replacements from the
   end with the smaller symbol. Words that reduce to the same word may differ anywhere;
3. what is left are places: (reduced word, place at which an edit leads to a known one).
   Words are verified there on their own letters: without the letter at that place they
   must be equal, or equal to a whole word.

No two words are paired for sharing a reduced word: equal rests meet by an equality join,
and words with an equal rest at the same place number at most one per letter.
Keys are 64-bit hashes; a collision gives a candidate more, never a wrong pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.session import reliable_checkpoint

SYMBOLS = 8
LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form is this many times as frequent as its variant.
RATIO = 10
# One in this many runs of a document loses a letter.
DAMAGE = 31

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Neighbours made at a time.
_BLOCK = 1 << 21


def without(word: Column, at: Column) -> Column:
    """``word`` without the code point at place ``at`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the damaged runs of letters of all texts with at least ``least_count`` occurrences.

    NULL texts have no runs; a NULL ``doc_id`` counts as empty text in the hash. Runs shorter
    than ``least_length`` cannot become words, as damage only shortens.
    """
    lower = F.translate("text", _UPPER, _LOWER)
    found = F.regexp_extract_all(lower, F.lit(rf"([a-zÀ-ÿ]{{{least_length},}})"), F.lit(0))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(name.alias("name"), F.explode(found).alias("run"))
    h = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    damaged = without(F.col("run"), (h % F.length("run")).cast("int"))
    words = runs.select(F.when(h % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _matrices(words: list[str], per_word: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, symbols) for blocks of words of one length; ``per_word`` numbers are made per letter."""
    letters = [w.encode("latin-1") for w in words]
    lengths = np.fromiter(map(len, letters), dtype=np.int64, count=len(letters))
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        rows = max(1, _BLOCK // (per_word * int(length)))
        for first in range(0, len(places), rows):
            some = places[first : first + rows]
            codes = np.frombuffer(b"".join(letters[i] for i in some), dtype=np.uint8)
            yield some, (codes.reshape(len(some), length) % SYMBOLS).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    """Powers of the base, the last letter's first power last."""
    factors = np.full(length, _BASE)
    factors[0] = 1
    return np.multiply.accumulate(factors)[::-1]


def _keys(symbols: np.ndarray) -> np.ndarray:
    return ((symbols + np.uint64(1)) * _powers(symbols.shape[1])).sum(axis=1, dtype=np.uint64)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        keys = np.zeros(len(words), dtype=np.uint64)
        for some, symbols in _matrices(words, 4):
            keys[some] = _keys(symbols)
        yield {"word": batch.column("word"), "n": batch.column("n"), "reduced": keys.view(np.int64)}


def _neighbours(symbols: np.ndarray, least_length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, key): replacements by greater symbols at ``place``, deletions at ``-1 - place``."""
    length = symbols.shape[1]
    powers, values = _powers(length), symbols + np.uint64(1)
    terms = values * powers
    whole = terms.sum(axis=1, dtype=np.uint64)
    for step in range(1, SYMBOLS):
        rows, places = np.nonzero(symbols + np.uint64(step) < SYMBOLS)
        yield rows, places, whole[rows] + np.uint64(step) * powers[places]
    if length > least_length:
        before = np.zeros_like(terms)
        np.cumsum(values[:, :-1] * powers[1:], axis=1, out=before[:, 1:])
        after = whole[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
        rows, places = np.indices(symbols.shape)
        yield rows.ravel(), -1 - places.ravel(), (before + after).ravel()


def _generate(least_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            own = batch.column("reduced").to_numpy()
            for some, symbols in _matrices(batch.column("word").to_pylist(), 1):
                for rows, places, keys in _neighbours(symbols, least_length):
                    yield {"met": keys.view(np.int64), "reduced": own[some[rows]], "at": places.astype(np.int32)}

    return run


def reduce_words(words: DataFrame) -> DataFrame:
    """(word, n, reduced): the key of each word's reduced form."""
    return map_batches(words.select("word", "n"), _reduce, "word string, n long, reduced long")


def edit_places(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(reduced, at): where one edit of a reduced word gives a reduced word of the vocabulary.

    ``at`` is the place of a replacement, or -1 - place of a deletion.
    """
    vocabulary = words.groupBy("reduced").agg(F.min("word").alias("word"), F.count(F.lit(1)).alias("members"))
    made = map_batches(
        vocabulary.select("reduced", "word"), _generate(least_length), "met long, reduced long, at int"
    )
    met = made.join(vocabulary.select(F.col("reduced").alias("met")), "met")
    # A replacement leads back from the other end at the same place.
    ends = F.when(F.col("at") >= 0, F.array("reduced", "met")).otherwise(F.array("reduced"))
    apart = met.select(F.explode(ends).alias("reduced"), "at")
    alike = vocabulary.filter("members > 1").select(
        "reduced", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("at")
    )
    return apart.unionByName(alike).distinct()


def nearest(words: DataFrame, places: DataFrame) -> DataFrame:
    """(word, n, n_near, best): number of words one edit away, and the most frequent of them.

    ``best`` is a struct of ``back`` (minus its n) and ``word``; NULL without a near word.
    """
    candidates = places.join(words, "reduced").select("word", "n", "at")
    me = F.struct((-F.col("n")).alias("back"), "word").alias("me")

    # Replacements: equal rests at one place. At most as many words as there are letters.
    replaced = candidates.filter("at >= 0").select("at", without(F.col("word"), F.col("at")).alias("rest"), me)
    groups = replaced.groupBy("at", "rest").agg(F.sort_array(F.collect_list("me")).alias("all")).filter("size(all) > 1")
    members = groups.select(F.explode("all").alias("me"), "all").select(
        F.col("me.word").alias("word"), (F.size("all") - 1).alias("near"),
        F.when(F.col("me") == F.col("all")[0], F.col("all")[1]).otherwise(F.col("all")[0]).alias("best"),
    )

    # Deletions: of equal letters in a row only the last is taken away.
    at = -1 - F.col("at")
    once = F.substring("word", at + 1, F.lit(1)) != F.substring("word", at + 2, F.lit(1))
    deleted = candidates.filter("at < 0").filter(once).select(me, without(F.col("word"), at).alias("rest"))
    other = words.select(F.col("word").alias("rest"), F.struct((-F.col("n")).alias("back"), "word").alias("you"))
    both = F.explode(F.array(F.struct(F.col("me").alias("a"), F.col("you").alias("b")), F.struct(F.col("you").alias("a"), F.col("me").alias("b"))))
    pairs = deleted.join(other, "rest").select(both.alias("p")).select(
        F.col("p.a.word").alias("word"), F.lit(1).alias("near"), F.col("p.b").alias("best")
    )

    own = words.select(
        "word", "n", F.lit(0).alias("near"), F.lit(None).cast("struct<back: bigint, word: string>").alias("best")
    )
    seen = members.unionByName(pairs).withColumn("n", F.lit(None).cast("long"))
    return own.unionByName(seen).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every (word, form): the end of the chain of forms, by doubling of pointers.

    A form is ``RATIO`` times as frequent as its word, so chains have no loops and as many
    steps as the greatest count has digits; rounds are the logarithm of that.
    """
    links = reliable_checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = links.join(ahead, "root", "left")
        links = reliable_checkpoint(
            stepped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        )
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text).

    An empty table, or one without words, gives no rows; other columns are not read.
    Repeated rows count as often as they stand.
    """
    words = reliable_checkpoint(reduce_words(word_counts(docs, least_length, least_count)))
    near = nearest(words, edit_places(words, least_length))
    better = -F.col("best.back") >= ratio * F.col("n")
    found = reliable_checkpoint(near.select(
        "word", F.when(better, F.col("best.word")).alias("form"), "n", "n_near",
        F.when(better, -F.col("best.back")).alias("form_n"),
    ))
    ends = roots(found.filter("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
