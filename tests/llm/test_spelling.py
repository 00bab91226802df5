"""Spelling variants against all pairs of words, and the awkward tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

from millrace.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, reduced long, `at` int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 7, 7, 7) for i, t in rows], SCHEMA).repartition(3)


def near(a, b):
    """Whether one insertion, deletion or replacement of a code point makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def plain(rows, least=7):
    counts = Counter()
    for i, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in lower)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    forms, found = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * n:
            forms[w] = best
        found[w] = len(others)
    rows = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        rows.append((w, form, root, n, found[w], words.get(form)))
    return sorted(rows)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_all_pairs(spark):
    chance = random.Random(5)
    bases = ["chaîneur", "mississippi", "aaaaaaaa", "ÀÖØßéêþÿ", "lanterns", "balloon" * 4]
    words = []
    for base in bases:
        words += [base] * 400
        for _ in range(12):
            w, at = base, chance.randrange(len(base))
            w = chance.choice([w[:at] + w[at + 1 :], w[:at] + "é" + w[at + 1 :], w[:at] + w[at] + w[at:], w[:at] + "ah"[at % 2] + w[at + 1 :]])
            words += [w] * chance.choice([1, 2, 3, 30])
            v = w[:-1] + "q"
            words += [v] * 2 + [v.upper()]
    chance.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    rows += [(None, "lanterns lanternz,lanternz"), (3, None), (3, ""), (3, " \n7 "), (4, rows[4][1]), (4, rows[4][1])]
    rows += [(90, "漢字lanterns\U0001f600lanterns×÷×÷×÷×÷ ×÷×÷×÷×÷")]
    want = plain(rows)
    assert any(r[2] not in (r[0], r[1]) for r in want), "a chain of two forms is wanted"
    assert got(spelling.variants(table(spark, rows))) == want


def test_whole_table(spark, folder):
    """The registered query against all pairs of words that share a letter count of their own."""
    import __spark_entry__ as contract

    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert got(contract.queries()["op13_spelling"](spark, folder)) == plain(rows)


def test_long_runs(spark):
    """A run of 50,000 letters is a word like any other."""
    long = "abcdefghij" * 5_000
    rows = [(i, f"{long} {long[:20_000]}x{long[20_001:]} {long}") for i in range(1, 4)]
    lengths = sorted((len(w), n, near) for w, _, _, n, near, _ in got(spelling.variants(table(spark, rows))))
    assert [x for x in lengths if x[1] > 1][-1][0] == 50_000
    assert any(near for _, _, near in lengths)


def test_empty(spark):
    assert got(spelling.variants(table(spark, []))) == []
    assert got(spelling.variants(table(spark, [(1, None), (None, "short words only")]))) == []


def test_neighbourhood_is_full():
    """Every edit of a reduced word is found from one of its two ends."""
    chance = np.random.default_rng(3)
    for _ in range(40):
        one = chance.integers(0, 8, size=(1, 9)).astype(np.uint64)
        made = {int(k) for _, _, keys in spelling._neighbours(one, 7) for k in keys}
        for at in range(9):
            for symbol in range(8):
                other = one.copy()
                other[0, at] = symbol
                back = {int(k) for _, _, keys in spelling._neighbours(other, 7) for k in keys}
                met = int(spelling._keys(other)[0]) in made or int(spelling._keys(one)[0]) in back
                assert met == bool((other != one).any())
            shorter = np.delete(one, at, axis=1)
            assert int(spelling._keys(shorter)[0]) in made
