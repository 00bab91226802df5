"""Conversation repair against a search through all edits, and the awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from millrace.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, `chunk` long, pos string, `key` long, audit long"
SPACE = " \t\n\x0b\f\r"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def damage(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        found[conv] += [((turn is not None, turn or 0), role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {conv: sorted(turns) for conv, turns in found.items()}


def flags(turns):
    faults, seen = [], set()
    for _, role, text in turns:
        ended = text.rstrip(SPACE)
        faults.append(1 if not ended else 2 if (role, text) in seen else 3 if ended[-1] not in ".!?" else 0)
        seen.add((role, text))
    return faults


def walk(rows, faults, audit):
    """Cost and turns of an audit, or None where it is not allowed or ends in no conversation."""
    cost, out, at = 0, [], 0
    for edit in audit:
        turn = "user" if not out or out[-1][0][:1] in "sa" else "assistant"
        if edit == "I":
            cost += 5
            out.append((turn, ""))
            continue
        (_, role, text), fault = rows[at], faults[at]
        at += 1
        if edit == "D":
            cost += 2
            continue
        if fault in (1, 2):
            return None
        cost += (5 if fault == 3 else 0) + (1 if edit == "R" else 0)
        out.append((role if edit == "K" else turn, text))
    initials = "".join(r[:1] or "-" for r, _ in out)
    return (cost, out) if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials) else None


def all_edits(rows, faults):
    """The least (cost, audit) among all audits with at most four inserts, one by one."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for inserts in range(4):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
                audit = "".join("I" * places.count(i) + e for i, e in enumerate([*edits, ""]))
                if (found := walk(rows, faults, audit)) and (best is None or (found[0], audit) < best[:2]):
                    best = (found[0], audit, found[1])
    return best


def plain_search(rows, faults):
    """The same by whole strings for each state: for conversations too long for all edits."""
    best = {0: (0, "")}
    def insert():
        for s in (0, 1, 3):
            if s in best:
                c, a = best[s]
                best[2] = min(best.get(2, (10**9, "")), (c + 5, a + "I"))
        if 2 in best:
            c, a = best[2]
            best[3] = min(best.get(3, (10**9, "")), (c + 5, a + "I"))
    for (_, role, _), fault in zip(rows, faults):
        insert()
        new = defaultdict(list)
        for s, (c, a) in best.items():
            new[s].append((c + 2, a + "D"))
            if fault in (0, 3):
                left = 5 if fault == 3 else 0
                if role[:1] == "s" and s == 0:
                    new[1].append((c + left, a + "K"))
                to, want = (3, "a") if s == 2 else (2, "u")
                new[to].append((c + left, a + "K") if role[:1] == want else (c + left + 1, a + "R"))
        best = {s: min(v) for s, v in new.items()}
    insert()
    return min(best.get(0, (10**9, "")), best.get(3, (10**9, "")))


def want(rows, search=all_edits):
    found = damage(rows)
    out = []
    for conv in {r[0] for r in rows}:
        turns = found.get(conv, [])
        faults = flags(turns)
        if search is all_edits:
            cost, audit, left = all_edits(turns, faults)
        else:
            cost, audit = plain_search(turns, faults)
            left = walk(turns, faults, audit)[1]
        numbers = [t for (known, t), _, _ in turns if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out.append((conv, gaps, *[faults.count(k) for k in (1, 2, 3)], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(4)
    found = []
    for conv in range(120):
        for turn in range(chance.choice([1, 2, 3, 4, 5])):
            role = chance.choice(["system", "user", "user", "assistant", "assistant", "tool", "uncle", "", None])
            text = chance.choice(["Fine.", "Fine.", "What? \n", "cut off", " \t", "", None, f"Turn {turn}!"])
            found.append((conv, chance.choice([turn, turn + 2, None, -3]), role, text))
    return found + [(None, 1, "user", "Hm."), (None, None, None, None), (None, 2, "assistant", "Yes."), (7, 0, "user", "Fine."), (7, 0, "user", "Fine.")]


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3])
def test_all_edits(spark, rows, modulus):
    """With three hash values nearly all prefixes collide; verification keeps the result."""
    assert got(repair.report(table(spark, rows), modulus=modulus)) == want(rows)


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 2])
def test_long_conversations(spark, modulus):
    """Chunks of seven rows put together give what one walk gives."""
    chance = random.Random(8)
    rows = []
    for conv in range(12):
        for turn in range(chance.choice([20, 90, 300])):
            role = chance.choice(["user", "assistant", "user", "assistant", "system"])
            rows.append((conv, turn, role, chance.choice([f"Turn {turn}.", "cut", "", "Same.", "Yes! ", f"open {turn}"])))
    expected = want(rows, plain_search)
    frame = table(spark, rows)
    assert got(repair.report(frame, modulus=modulus)) == expected
    assert got(repair.report(frame, chunk=7, rows_per_group=200, modulus=modulus)) == expected


def test_plain_search(rows):
    for turns in damage(rows).values():
        assert plain_search(turns, flags(turns)) == all_edits(turns, flags(turns))[:2]


def test_whole_table(spark, folder):
    import __spark_entry__ as contract

    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(contract.queries()["op11_repair"](spark, folder)) == want(rows, plain_search)


def test_empty(spark):
    assert got(repair.report(table(spark, []))) == []
    dropped = next(c for c in range(100) if zlib.crc32(f"{c}:5".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert got(repair.report(table(spark, [(dropped, 5, "user", "Gone.")]))) == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_tree():
    """Comparisons of shared strings, also where all hashes are equal."""
    chance = random.Random(1)
    for modulus in ((1 << 61) - 1, 1):
        tree, texts = repair.AuditTree(modulus), {0: ""}
        for _ in range(400):
            node, symbol = chance.choice(list(texts)[-30:]), chance.choice(["D", "K", "I", "KI"])
            texts[tree.extend(node, symbol)] = texts[node] + symbol
        for _ in range(3000):
            a, b = chance.choice(list(texts)), chance.choice(list(texts))
            x, y = chance.choice("DK"), chance.choice("DKI")
            assert tree.text(a) == texts[a]
            assert tree.less(a, x, b, y) == (texts[a] + x < texts[b] + y)
