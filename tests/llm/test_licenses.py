"""License scans: rows that share a key, and the containment join against a plain one."""

from __future__ import annotations

import re

import pytest

from millrace.llm import licenses
from millrace.sources.lines import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, key string, body string, label string, `rank` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", "b", "l", 1) for i, t in rows], SCHEMA).repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(text):
    """(n_words, n_base, first, last, base labels, labels, score) by looking at every line and template."""
    words = WORD.findall(lower(text))
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        places += found
        base |= {label} if found else set()
    best, met = 0.0, set()
    for line in lower(text).split("\n"):
        own = set(WORD.findall(line))
        for label, template in licenses.TEMPLATES:
            wanted = set(WORD.findall(lower(template)))
            share = len(own & wanted) / len(wanted)
            if share >= licenses.CONTAINMENT - 1e-9:
                best, met = max(best, share), met | {label}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | met)), 1.0 if base else best)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rows_that_share_a_key_keep_apart(spark):
    nc = "Licensed under CC BY NC 4.0"
    rows = [(1, nc), (1, "plain words"), (1, nc), (None, nc), (None, "other words"), (2, None), (2, "")]
    found = got(licenses.scan(frame(spark, rows)))
    assert found == sorted(((i, *plain(t)) for i, t in rows), key=str)
    assert [r[6] for r in found if r[0] == 1] .count("cc-by-nc") == 2


def test_whole_table(spark, folder):
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    texts = [(1000 + i, t) for i, (_, t) in enumerate(licenses.TEMPLATES)]
    some = [(2000 + i, " ".join(t.split()[: int(len(t.split()) * 0.85)])) for i, (_, t) in enumerate(licenses.TEMPLATES)]
    rows += texts + some + [(3000, "\n".join(t for _, t in licenses.TEMPLATES)), (3001, "x " * 50_000 + licenses.TEMPLATES[1][1])]
    found = got(licenses.scan(frame(spark, rows)))
    want = sorted(((i, *plain(t)) for i, t in rows), key=str)
    assert [r[:7] for r in found] == [r[:7] for r in want]
    assert [r[7] for r in found] == pytest.approx([r[7] for r in want])


def test_empty(spark):
    assert licenses.scan(frame(spark, [])).count() == 0
    assert got(licenses.scan(frame(spark, [(None, None)]))) == [(None, *plain(None))]
