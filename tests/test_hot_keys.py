"""Cutting hot keys must not change any result."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import alarms, lateness, patterns, words
from millrace.plans import ordered
from millrace.sources.lines import table


@pytest.fixture(scope="module")
def skewed(spark, folder):
    """A third of all rows for user -1, another part without a user."""
    events = table(spark, folder, "events")
    user = F.when(F.col("event_id") % 3 == 0, -1).when(F.col("event_id") % 10 == 1, None).otherwise(F.col("user_id"))
    return events.withColumn("user_id", user).cache()


@pytest.mark.parametrize("limit", [3, 40, 200])
@pytest.mark.parametrize("keys", [["user_id"], []])
def test_previous_row(skewed, rows_of, keys, limit):
    plain = ordered.previous_row(skewed, keys, ["ts", "event_id"], ["event_id"], "before")
    cut = ordered.previous_row(skewed, keys, ["ts", "event_id"], ["event_id"], "before", limit)
    columns = ["event_id", "before.event_id"]
    assert rows_of(cut.select(*columns)) == rows_of(plain.select(*columns))


@pytest.mark.parametrize("limit", [3, 40])
def test_next_match_and_row_numbers(skewed, rows_of, limit):
    buys = F.col("event_type") == "purchase"
    for make in (
        lambda n: ordered.next_match(skewed, ["user_id"], ["ts", "event_id"], buys, ["event_id"], "x", n)
        .select("event_id", "x.event_id"),
        lambda n: ordered.row_numbers(skewed, ["user_id"], ["ts", "event_id"], "x", n).select("event_id", "x"),
        lambda n: ordered.max_so_far(skewed, [], ["event_id"], F.col("value"), "x", n).select("event_id", "x"),
    ):
        assert rows_of(make(limit)) == rows_of(make(None))


def sizes(rows, keys, order, limit):
    cut = ordered.chunked(rows, keys, order, limit)
    return [r["count"] for r in cut.groupBy(ordered.KEY, ordered.CHUNK).count().collect()]


def test_equal_times_are_cut_along_later_columns(make, rows_of):
    rows = make([(1, 7, i) for i in range(400)] + [(1, i, i) for i in range(5)] + [(2, i, i) for i in range(5)],
                "k LONG, t LONG, v LONG")
    for order in (["t", "seq"], ["t", "k", "seq"]):  # in the second, ties on two columns
        found = sizes(rows, ["k"], order, 20)
        assert sum(found) == 410 and max(found) < 60
    cut = ordered.row_numbers(rows, ["k"], ["t", "seq"], "n", 20)
    assert rows_of(cut) == rows_of(ordered.row_numbers(rows, ["k"], ["t", "seq"], "n"))
    back = ordered.previous_row(rows, ["k"], ["t", "seq"], ["v"], "before", 20)
    assert rows_of(back) == rows_of(ordered.previous_row(rows, ["k"], ["t", "seq"], ["v"], "before"))


def test_many_hot_keys_are_all_cut(make, rows_of):
    rows = make([(i % 12 or None, i) for i in range(1200)], "k LONG, t LONG")
    assert max(sizes(rows, ["k"], ["t"], 20)) < 60
    cut = ordered.max_so_far(rows, ["k"], ["t"], F.col("t"), "m", 20)
    assert rows_of(cut) == rows_of(ordered.max_so_far(rows, ["k"], ["t"], F.col("t"), "m"))


def test_huge_numbers_that_share_a_double(make, rows_of):
    rows = make([(1, 2**60 + i % 3, i) for i in range(100)], "k LONG, t LONG, v LONG")
    cut = ordered.row_numbers(rows, ["k"], ["t", "seq"], "n", 10)
    assert rows_of(cut) == rows_of(ordered.row_numbers(rows, ["k"], ["t", "seq"], "n"))


@pytest.mark.parametrize("kind", ["STRING", "DATE", "BINARY", "DECIMAL(30,3)", "BOOLEAN"])
def test_any_type_that_sorts_can_order(make, rows_of, kind):
    rows = make([(i % 2, f"{i * 37 % 90:04d}") for i in range(90)], "k LONG, s STRING")
    at = {
        "DATE": F.date_add(F.lit("2024-01-01").cast("date"), F.col("s").cast("int")),
        "BOOLEAN": F.col("s").cast("int") % 2 == 0,
    }.get(kind, F.col("s").cast(kind))
    rows = rows.withColumn("t", at)
    cut = ordered.row_numbers(rows, ["k"], ["t", "seq"], "n", 7).select("k", "seq", "n")
    assert rows_of(cut) == rows_of(ordered.row_numbers(rows, ["k"], ["t", "seq"], "n").select("k", "seq", "n"))


def test_null_times_come_first(make):
    rows = make([(1, None if i == 59 else i) for i in range(60)], "k LONG, t LONG")
    cut = ordered.row_numbers(rows, ["k"], ["t", "seq"], "n", 10)
    assert cut.filter("t IS NULL").first().n == 1


def test_patterns(skewed, rows_of):
    users = skewed.filter("user_id IS NOT NULL")
    for keys in (["user_id"], []):
        make = lambda n: patterns.fail_streaks(
            users, "ts", "event_id", fail="error", within="12 hours", keys=keys, rows_per_group=n)
        assert rows_of(make(20)) == rows_of(make(None))
    orders = lambda n: patterns.order_results(
        users, "ts", "event_id", "user_id", create="signup", pay="purchase", within="1 day", rows_per_group=n)
    assert rows_of(orders(20)) == rows_of(orders(None))


def test_running_word_count(make, rows_of):
    rows = make([("a a b",)] * 40 + [("c",)], "value STRING")
    assert rows_of(words.running_word_count(rows, ["seq"], rows_per_group=7)) == rows_of(
        words.running_word_count(rows, ["seq"]))


def test_watermark(skewed, rows_of):
    make = lambda n: lateness.bounded_watermark(skewed, ["event_id"], "ts", "1 hour", rows_per_group=n)
    assert rows_of(make(9).select("event_id", "watermark_us")) == rows_of(make(None).select("event_id", "watermark_us"))


def alarm_model(rows: list[tuple[int, float]], horizon: int) -> list[int]:
    fired, temp, timer = [], 0.0, None
    for t, x in rows:
        if timer is not None and timer < t:
            fired.append(timer)
            temp, timer = 0.0, None
        if x > temp and timer is None:
            temp, timer = x, t + horizon
        elif x <= temp:
            temp, timer = x, None
    return fired + ([timer] if timer is not None else [])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60), st.integers(-3, 9)), min_size=1, max_size=120),
       st.integers(1, 9))
def test_alarms_follow_the_model_in_spans(make, readings, horizon):
    rows = make([(k, t, float(x)) for k, t, x in readings], "k LONG, t LONG, x DOUBLE")
    want = []
    for key in {k for k, _, _ in readings}:
        walk = sorted((t, i, x) for i, (k, t, x) in enumerate(readings) if k == key)
        want += [(key, at) for at in alarm_model([(t, x) for t, _, x in walk], horizon)]
    for span_rows in (20_000, 4):
        found = alarms.rising_alarms(rows, "k", "t", "x", horizon=f"{horizon} seconds", span_rows=span_rows)
        assert sorted((r.k, r.alarm_ts) for r in found.collect()) == sorted(want), span_rows


def test_alarm_spans_that_never_forget(make):
    """Rising without end: every span depends on the one before."""
    rows = make([(1, i, float(i + 1)) for i in range(40)], "k LONG, t LONG, x DOUBLE")
    found = alarms.rising_alarms(rows, "k", "t", "x", horizon="6 seconds", span_rows=5)
    assert sorted(r.alarm_ts for r in found.collect()) == alarm_model([(i, i + 1.0) for i in range(40)], 6)
