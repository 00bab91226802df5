"""The pipeline as a whole and stage by stage, on a given table and on awkward ones."""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import mixing, secrets
from millrace.llm.queries import VOCABULARY
from millrace.sources.lines import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` int, `set` long"
BASE = " ".join(f"word{i * 7 % 83}x{i}" for i in range(120))


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2) for i, t in rows], SCHEMA).repartition(3)


def test_rows_that_share_an_id_are_not_lost(spark, folder):
    rows = [(1, BASE), (1, "quite another text of a few words here"), (2, BASE + " end"), (3, "third"), (3, "third"), (None, "third"), (4, None)]
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows), folder)
    assert kept.columns == frame(spark, rows).columns
    found = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert found == Counter({rows[0]: 1, rows[1]: 1, (3, "third"): 1, (None, "third"): 1, (4, None): 1})


def test_near_duplicates_of_a_whole_table(spark, folder):
    docs = table(spark, folder, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets = {i: shingle_set(t) for i, t in rows.items()}
    part = {i: i for i in rows}
    for _ in range(4):
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    part[a] = part[b] = min(part[a], part[b])
    kept = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({part[i] for i in rows})


def test_run(spark, folder):
    """All stages: what comes out are the texts of kept documents, masked, as often as the mix takes them."""
    ids = {i: text for i, text in ((r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect())}
    out = corpus_pipeline.run(spark, folder).collect()
    tool = Tokenizer.from_file(VOCABULARY)
    assert out and {r["doc_id"] for r in out} <= ids.keys()
    docs = table(spark, folder, "documents")
    staged = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        staged = stage(spark, staged, folder)
        if name == "near_duplicates":
            staged = spark.createDataFrame(staged.collect(), docs.schema)
    texts = {r["doc_id"]: r["text"] for r in staged.collect()}
    for r in out:
        assert r["n_tokens"] == len(r["ids"]) and tool.decode(r["ids"], skip_special_tokens=False) == texts[r["doc_id"]]
        assert not secrets.base_spans(texts[r["doc_id"]])
    copies = Counter(r["doc_id"] for r in out)
    emitted = Counter(r["doc_id"] for r in mixing.emit(staged).collect())
    assert copies == emitted and max(copies.values()) <= 2


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_tables(spark, folder, name, stage):
    docs = table(spark, folder, "documents")
    got = stage(spark, docs.limit(0), folder)
    assert got.count() == 0
    if name != "encoding":
        assert got.columns == docs.columns


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_nulls_in_every_column(spark, folder, name, stage):
    docs = table(spark, folder, "documents")
    nothing = docs.limit(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema])
    got = stage(spark, nothing, folder)
    assert got.count() <= 6


def test_near_duplicates_shuffle_whole_rows_once(spark, folder):
    """The join that finds the kept rows and the grouping of repeated ones share one exchange."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            corpus_pipeline.near_duplicates(spark, frame(spark, [(i, f"{BASE} of {i}") for i in range(9)]), folder).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    steps = re.findall(r"SortAggregate|SortMergeJoin|Exchange", text.getvalue())
    assert steps[:4] == ["SortAggregate", "SortAggregate", "SortMergeJoin", "Exchange"]


def test_repeated_rows_that_differ_in_other_columns(spark, folder):
    """Of rows with one id and text the least stays; other texts under the id stay too, a NULL one included."""
    rows = [(1, BASE, "en", "b", 1, 1, 2), (1, BASE, "en", "a", 9, 1, 2), (1, None, "en", "c", 0, 1, 2), (2, BASE, "en", "a", 1, 1, 2),
            (None, BASE, "en", "a", 1, 1, 2), (None, BASE, "en", "a", 1, 1, 2)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), folder)
    assert Counter(map(tuple, kept.collect())) == Counter([rows[1], rows[2], rows[4], rows[5]])
