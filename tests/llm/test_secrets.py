"""Secret scans: the fixed patterns on whole tables, and what the field finds beyond them."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from millrace.llm import secrets
from millrace.llm.common import bounded_sample, bounded_samples

LETTERS = "abcdefghijklmnopqrstuvwxyz"
MIXED, DIGITS = LETTERS + LETTERS.upper(), "0123456789"


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def field(table):
    return secrets.train(secrets.sample_texts(table))


def plain(text):
    """The base spans, pattern by pattern."""
    found = []
    for m in re.finditer(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def test_base_spans_of_a_whole_table(table, field):
    texts = {r["doc_id"]: r["text"] or "" for r in table.select("doc_id", "text").collect()}
    found = {r["doc_id"]: r for r in secrets.scan(table, field).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        spans = plain(text)
        kinds = [k for k, _, _ in spans]
        row = found[i]
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(map(kinds.count, ("assign", "access", "hex")))
        assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        assert set(f"{k}:{s}:{e}" for k, s, e in spans) <= set(row["spans"].split(",") if row["spans"] else [])


HELD_OUT = {
    "ghp": lambda mk: "ghp_" + mk(MIXED + DIGITS, 36),
    "jwt": lambda mk: "Bearer eyJ" + mk(MIXED + DIGITS, 20) + ".eyJ" + mk(MIXED + DIGITS, 40) + "." + mk(MIXED + DIGITS + "_-", 43),
    "sk_live": lambda mk: "sk_live_" + mk(MIXED + DIGITS, 24),
    "auth": lambda mk: "auth=" + mk(MIXED + DIGITS, 32),
    "credential": lambda mk: "credential: " + mk(MIXED + DIGITS, 28),
    "capital hex": lambda mk: mk(DIGITS + "ABCDEF", 40),
    "ASIA": lambda mk: "ASIA" + mk(LETTERS.upper() + DIGITS, 16),
    "letters": lambda mk: mk(MIXED, 40),
}


@pytest.mark.parametrize("form", HELD_OUT)
def test_the_field_finds_forms_it_was_not_shown(table, field, form):
    rng = random.Random(form)
    prose = [r["text"].split() for r in table.filter("length(text) BETWEEN 200 AND 5000").orderBy("doc_id").limit(60).collect()]
    caught = 0
    for words in prose:
        value = HELD_OUT[form](lambda letters, n: "".join(rng.choices(letters, k=n)))
        at = rng.randrange(3, len(words) - 3)
        text = " ".join([*words[:at], value, *words[at:]])
        end = len(" ".join(words[:at])) + 1 + len(value)
        start = end - len(value.split()[-1])
        caught += any(s <= start + 5 and e >= end for s, e, _ in secrets.all_spans(field, text))
    assert caught >= 0.9 * len(prose)


def test_clean_documents_are_left_alone(spark, field):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 5 = 1").select("text").collect()]
    clean = [t for t in texts if t and len(t) < 50_000 and not plain(t)]
    wrong = [t for t in clean if secrets.all_spans(field, t)]
    assert len(clean) > 1500 and len(wrong) <= len(clean) / 1000 + 1


def test_numbers_and_addresses_are_no_secrets(field):
    for value in ("4556123412341234", "jane.roe@example.com", "https://example.com/a/b?c=1", "Donaudampfschifffahrt", "2024-01-01T00:00:00"):
        assert secrets.all_spans(field, f"They wrote to us about {value} and went home early that day.") == []


def test_awkward_texts(field):
    assert secrets.all_spans(field, "") == [] and secrets.all_spans(field, " \n\t ") == []
    long = "plain words of no interest " * 40_000
    assert secrets.all_spans(field, long) == []


def test_the_sample_tells_suspects_once_per_row(spark):
    """The sample is that of two separate ones; what tells them apart is asked once per row and for the rows chosen."""
    texts = [f"words {i} password: {i}abcdefg" if i % 3 else f"words {i}" for i in range(40)]
    df = spark.createDataFrame([*enumerate(texts), (0, texts[0]), (90, None), (91, ""), (None, "x")], "doc_id long, text string")
    asked = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def suspect(text):
        asked.add(1)
        return "password" in text

    found = bounded_samples(df, "text", suspect("text"), ["doc_id"], 5, 11)
    assert asked.value <= df.count() + 10
    plain = F.col("text").contains("password")
    want = [bounded_sample(df.filter(w), "text", ["doc_id"], 5, 11) for w in (plain, ~plain)]
    assert [len(w) for w in want] == [5, 5] and found == want[0] + want[1]
    assert bounded_samples(df.limit(0), "text", plain, ["doc_id"], 5, 11) == []
    assert secrets.sample_texts(df) and secrets.sample_texts(df) == [
        t for w in (plain, ~plain) for t in bounded_sample(df.filter(w), "text", ["doc_id"], 300, 11)]
