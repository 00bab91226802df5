"""Chat windows against a walk along each conversation, and the awkward tables."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from millrace.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, `window` long, start string, key long, sums long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def conversations(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {conv: [(r, t) for _, r, t in sorted(turns)] for conv, turns in found.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<\\/s>", "[\\\\INST]", "<s", "[/INST", "</s>\\", "\\", "<", "[", "INST]", "/s>"]


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(9)
    found = []
    for conv in range(60):
        for turn in range(chance.choice([1, 2, 3, 8, 40])):
            role = chance.choice(["user", "assistant", "assistant", "system", "tool"]) if turn else chance.choice(["system", "user"])
            size = chance.choice([0, 1, 5, 60, 400, 1500, 9000 if conv % 9 == 0 else 90])
            text = "".join(chance.choice([*CONTROL, "word ", "é", "\U0001f600", "\n"]) for _ in range(size // 3))
            found.append((conv, turn, role, text))
    found += [(None, None, None, None), (None, 1, "assistant", "said"), (None, None, "assistant", None), (None, 1, "assistant", "said")]
    found += [(100, 0, "system", "only this")] + [(101, 0, "system", "long " * 2000), (101, 1, "assistant", "a"), (101, 2, "assistant", "b")]
    found += [(102, 0, "assistant", "z" * 30_000), (102, 1, "assistant", "tail"), (103, 0, "[/INST]</s>", "[/INST]</s>\\")]
    return found


@pytest.mark.parametrize("group", [None, 50])
def test_read_back(spark, rows, group):
    formatted = chat.windows(table(spark, rows), budget=128, history=40, rows_per_group=group)
    want = []
    for conv, turns in conversations(rows).items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        want.append((conv, len(turns), sha(said), len(loss), sha(loss)))
    got = [tuple(r)[:5] for r in chat.digests(formatted).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_windows(spark, rows):
    """Budget, system turn, history and mask of every window."""
    budget, history = 128, 40
    def tokens(text):
        return -(-len(text) // 4) + 4

    by_conv = defaultdict(list)
    for r in chat.windows(table(spark, rows), budget, history).collect():
        by_conv[r["conv_id"]].append(r)
    repeats = 0
    for conv, turns in conversations(rows).items():
        lead = turns[0] if turns[0][0] == "system" else None
        rest = turns[1:] if lead else turns
        done = 0
        room = max(budget - history - (tokens(lead[1]) if lead else 0), budget // 4)
        for w in sorted(by_conv[conv], key=lambda w: w["window"]):
            pieces = w["text"].split("</s>")
            assert pieces.pop() == "" and len(pieces) == w["n_turns"]
            read = [tuple(map(unescape, p.removeprefix("<s>[INST]").split("[/INST]"))) for p in pieces]
            assert all(p.startswith("<s>[INST]") and p.count("[INST]") == 1 for p in pieces)
            if lead:
                assert read[0] == lead
            past, new = read[: w["n_repeated"]], read[w["n_repeated"] :]
            if lead and w["window"] > 1:
                past = past[1:]
            elif lead:
                new = new[1:]
            assert new == rest[done : done + len(new)]
            # The longest run of turns before the window that starts within the history.
            keep = 0
            while done - keep > 0 and sum(tokens(t) for _, t in rest[done - keep - 1 : done]) <= history:
                keep += 1
            assert past == (rest[done - keep : done] if new else [])
            repeats += len(past)
            if len(new) > 1:
                assert sum(tokens(t) for _, t in new) <= room
            spans = [unescape(w["text"][s:e]) for s, e in w["loss"]]
            assert spans == [t for r, t in new if r == "assistant"]
            assert w["n_tokens"] == sum(tokens(t) for _, t in read)
            done += len(new)
        assert done == len(rest)
    assert repeats > 20


def unescape(text):
    """One backslash less between the first character and the rest of a control string."""
    out, i = "", 0
    while i < len(text):
        k = i + 1
        while k < len(text) and text[k] == "\\":
            k += 1
        control = text[i] in "<[" and k > i + 1 and any(text.startswith(c, k) for c in ("s>", "/s>", "INST]", "/INST]"))
        out += text[i] + ("\\" * (k - i - 2) if control else text[i + 1 : k])
        i = k
    return out


def test_hot_conversation(spark):
    """One conversation holds nearly all rows and is cut into chunks; the result is that of one walk."""
    rows = [(7, n, ["user", "assistant"][n % 2], f"turn {n} " * (n % 30)) for n in range(3000)] + [(8, 0, "user", "hi")]
    frame = table(spark, rows)
    cut, walk = chat.windows(frame, 256, 64, rows_per_group=200), chat.windows(frame, 256, 64)
    assert sorted(map(str, cut.collect())) == sorted(map(str, walk.collect()))
    turns = conversations(rows)[7]
    got = {r["conv_id"]: r for r in chat.digests(cut).collect()}
    assert got[7]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))


def test_empty(spark):
    assert chat.digests(chat.windows(table(spark, []))).collect() == []
    assert [tuple(r)[:2] for r in chat.digests(chat.windows(table(spark, [(None, None, None, None)]))).collect()] == [(None, 1)]
    with pytest.raises(ValueError):
        chat.windows(table(spark, []), budget=100, history=90)


def test_native(spark, folder):
    import __spark_entry__ as contract

    plan = contract.queries()["op12_chat_windows"](spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapInPandas" not in plan
