"""Jumps along a key's rows against plain loops, and alarms on long keys."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import alarms
from millrace.plans.chains import first_later, visited

ROWS = "key LONG, pos LONG, us LONG, x DOUBLE"


def random_rows(keys=3, n=200, seed=1):
    rng, rows = random.Random(seed), []
    for key in [None, *range(keys)]:
        us = 0
        for pos in range(1, rng.choice([1, 5, n]) + 1):
            us += rng.choice([0, 1, 1, 3])
            rows.append((key, pos, us, float(rng.randint(-3, 12))))
    return rows


@pytest.mark.parametrize("limit", [4, 40, 10_000])
def test_first_later(spark, limit):
    rows = random_rows() + [(9, p, p, float(p)) for p in range(1, 150)]
    frame = spark.createDataFrame(rows, ROWS).withColumn("key", F.struct("key"))
    got = {(r.key.key, r.pos): r.found and r.found["at"] for r in first_later(frame, limit, fan=4).collect()}
    assert len(got) == len(rows)
    for key, pos, us, x in rows:
        later = [p for k, p, t, y in rows if k == key and p > pos and (y <= x or t > us + limit)]
        assert got[key, pos] == min(later, default=None)


def test_visited(spark):
    rng = random.Random(2)
    links, want, heads = [], set(), []
    for key in range(4):
        n = [1, 30, 300, 300][key]
        step = {p: (q if (q := p + rng.randint(1, 40)) <= n else None) for p in range(1, n + 1)}
        links += [(key, p, q) for p, q in step.items()]
        at = 1 + key
        if at <= n:
            heads.append((key, at))
        while at is not None and at <= n:
            want.add((key, at))
            at = step[at]
    links = [(*link, link[:2] in heads) for link in links]
    frame = spark.createDataFrame(links, "key LONG, pos LONG, next LONG, head BOOLEAN").withColumn("key", F.struct("key"))
    way, _ = visited(frame, span=8)
    got = [(r.key.key, r.pos) for r in way.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def plain_alarms(readings, horizon):
    temp, timer, out = 0.0, None, []
    for us, x in readings:
        if timer is not None and timer < us:
            out.append(timer)
            temp, timer = 0.0, None
        if x <= temp:
            temp, timer = x, None
        elif timer is None:
            temp, timer = x, us + horizon
    return out + ([timer] if timer is not None else [])


@pytest.mark.parametrize("seed", [1, 2])
def test_long_keys_alarm_as_in_a_plain_walk(spark, seed):
    rng, rows, want = random.Random(seed), [], []
    for key in range(4):
        us, x, seq = 0, 0.0, 0
        for seq in range([1, 40, 400, 400][key]):
            us += rng.choice([0, 1, 2, 2, 9])
            x = rng.choice([x + 1, x + 1, x, float(rng.randint(-4, 9))])
            rows.append((key, us, seq, x))
    for key in range(4):
        want += [(key, t) for t in plain_alarms([(r[1], r[3]) for r in rows if r[0] == key], 6)]
    frame = spark.createDataFrame(rows, "k LONG, t LONG, seq LONG, x DOUBLE")
    got = alarms.rising_alarms(frame, "k", "t", "x", horizon="6 seconds", span_rows=10, rows_per_group=100)
    assert len(want) > 10 and sorted((r.k, r.alarm_ts) for r in got.collect()) == sorted(want)


def test_rounds_grow_as_the_logarithm(spark):
    """A key that rises all the time: every span hands the walk on to the next."""
    for spans in (5, 20, 80):
        rows = spark.range(1, spans * 32 + 1, 1, 4).select(
            F.struct(F.lit(1).alias("key")).alias("key"), F.col("id").alias("pos"), (F.col("id") * 1_000_000).alias("us"),
            F.col("id").cast("double").alias("x"), F.lit("row").alias("kind"))
        walk, rounds = alarms.alarm_walk(rows, 2_000_000, fan=16, span=32)
        assert walk.count() == math.ceil(spans * 32 / 3)
        assert rounds <= math.ceil(math.log2(spans)) + 1
