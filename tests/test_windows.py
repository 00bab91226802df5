"""Panes against Spark's own windows and against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import lateness, ranking, sliding
from millrace.operators.lateness import WATERMARK
from millrace.sources.lines import table


@pytest.mark.parametrize("size,slide", [("6 hours", "1 hour"), ("1 hour", "1 hour"), ("7 hours", "2 hours"), ("90 minutes", "1 hour")])
def test_counts_equal_spark_windows(spark, folder, rows_of, size, slide):
    events = table(spark, folder, "events")
    mine = sliding.with_window_start(sliding.sliding_count(events, ["user_id"], "ts", size, slide), size)
    theirs = events.groupBy("user_id", F.window("ts", size, slide)).count()
    theirs = theirs.select("user_id", "window.end", "count", "window.start")
    assert rows_of(mine) == rows_of(theirs)


def test_gaps_between_windows(make, rows_of):
    """A slide beyond the size: some rows lie in no window."""
    rows = make([("a", t) for t in range(30)], "k STRING, t LONG")
    got = sliding.sliding_count(rows, ["k"], "t", "4 seconds", "10 seconds")
    assert rows_of(got) == [("a", 14, 4), ("a", 24, 4), ("a", 4, 4)]


def test_times_before_1970(make, rows_of):
    rows = make([("a", -1), ("a", -7), ("a", 3)], "k STRING, t LONG")
    got = sliding.sliding_count(rows, ["k"], "t", "10 seconds", "5 seconds")
    assert rows_of(got) == sorted([("a", -5, 1), ("a", 0, 2), ("a", 5, 2), ("a", 10, 1)],
                                  key=lambda r: tuple((True, str(v)) for v in r))


def test_merge_form_equals_totals(spark, folder, rows_of):
    events = table(spark, folder, "events")
    totals = sliding.sliding_sum(events, ["user_id"], "ts", "5 hours", "1 hour", {"ids": "event_id"})
    merged = sliding.sliding_reduce(
        events, ["user_id"], "ts", "5 hours", "1 hour",
        {"cnt": F.count(F.lit(1)), "ids": F.sum("event_id")}, {"cnt": F.sum("cnt"), "ids": F.sum("ids")},
    )
    assert rows_of(totals) == rows_of(merged)


def test_sums_need_exact_numbers(spark, folder):
    with pytest.raises(TypeError):
        sliding.sliding_sum(table(spark, folder, "events"), ["user_id"], "ts", "5 hours", "1 hour", {"v": "value"})


def test_two_keys_and_no_key(make, rows_of):
    rows = make([("a", 1, 0), ("a", 2, 1), ("b", 1, 2)], "k STRING, l LONG, t LONG")
    two = sliding.sliding_count(rows, ["k", "l"], "t", "5 seconds", "5 seconds").select("k", "l", "cnt")
    assert rows_of(two) == [("a", 1, 1), ("a", 2, 1), ("b", 1, 1)]
    none = sliding.sliding_count(rows, [], "t", "5 seconds", "5 seconds")
    assert rows_of(none) == [(5, 3)]


@pytest.mark.parametrize("rows_per_group", [None, 5])
def test_late_rows_by_brute_force(make, rows_per_group):
    times = [(i * 7919) % 97 for i in range(120)]
    rows = make([("k", t) for t in times], "k STRING, t LONG")
    marked = lateness.bounded_watermark(rows, ["seq"], "t", "5 seconds", rows_per_group=rows_per_group)
    got = {r.window_end: r.cnt for r in sliding.sliding_count(marked, ["k"], "t", "20 seconds", "10 seconds", WATERMARK).collect()}
    want, late, seen = Counter(), [], None
    for i, t in enumerate(times):
        ends = [e for e in range(0, 130, 10) if e - 20 <= t < e]
        open_ends = [e for e in ends if seen is None or e * 1000 - 1 > (seen - 5) * 1000]
        want.update(open_ends)
        if not open_ends:
            late.append(i)
        seen = t if seen is None else max(seen, t)
    assert got == dict(want)
    dropped = lateness.late_rows(marked, "t", "20 seconds", "10 seconds")
    assert sorted(r.seq for r in dropped.collect()) == late


def test_only_control_rows_move_the_punctuated_watermark(make):
    rows = make([("x", 50), ("c", 20), ("x", 3), ("c", 10), ("x", 21)], "id STRING, t LONG")
    marked = lateness.punctuated_watermark(rows, ["seq"], "t", F.col("id") == "c")
    seen = [r[WATERMARK] for r in marked.orderBy("seq").collect()]
    assert seen == [None, None, 20_000_000, 20_000_000, 20_000_000]


def test_ascending_watermark_is_a_millisecond_behind(make):
    rows = make([("x", 5), ("x", 4), ("x", 9)], "id STRING, t LONG")
    marked = lateness.ascending_watermark(rows, ["seq"], "t")
    assert [r[WATERMARK] for r in marked.orderBy("seq").collect()] == [None, 4_999_000, 4_999_000]


def test_zone_free_times_do_not_depend_on_the_session_zone(spark, rows_of):
    """02:30 does not exist on that day in that zone, yet it is a time like any other."""
    sql = "SELECT 'a' AS k, TIMESTAMP_NTZ'2024-03-10 02:30:00.5' AS ts UNION ALL SELECT 'a', TIMESTAMP_NTZ'1960-07-01 00:00:00.000001'"
    want = [("a", 1710037805), ("a", -299894395)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        counts = sliding.sliding_count(spark.sql(sql), ["k"], "ts", "5 seconds", "5 seconds")
        ends = counts.select("k", F.expr("window_end - TIMESTAMP_NTZ'1970-01-01 00:00:00'").alias("since"))
        assert sorted((r.k, int(r.since.total_seconds())) for r in ends.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_counts_for_a_ranking_leave_out_what_cannot_rank(make, rows_of):
    """500 keys of one visit each make 12 windows: only the best three are written out, not 6,000 rows."""
    rows = make([(k, 7) for k in range(500)], "k LONG, t LONG")
    plain = sliding.sliding_count(rows, ["k"], "t", "60 minutes", "5 minutes")
    few = sliding.sliding_count(rows, ["k"], "t", "60 minutes", "5 minutes", best=(3, ["k"]))
    assert plain.count() == 6000 and few.count() == 36
    assert rows_of(ranking.top_n(few, 3, tie=["k"])) == rows_of(ranking.top_n(plain, 3, tie=["k"]))


@pytest.mark.parametrize("n", [1, 3, 1001])
def test_rankings_of_few_counts_equal_those_of_all(make, rows_of, n):
    rows = make([(i * 31 % 23, i * i * 7 % 9000) for i in range(400)] + [(None, 5), (None, 8000), (4, None)], "k LONG, t LONG")
    plain = sliding.sliding_count(rows, ["k"], "t", "20 minutes", "5 minutes")
    few = sliding.sliding_count(rows, ["k"], "t", "20 minutes", "5 minutes", best=(n, ["k"]))
    assert rows_of(ranking.top_n(few, n, tie=["k"])) == rows_of(ranking.top_n(plain, n, tie=["k"]))


def test_steps_at_one_start_make_one_run(make, rows_of):
    """A pane that ends where others begin, in sums of decimals too, whose type stays."""
    rows = make([(1, 0, 5), (1, 10, 5), (1, 10, -5), (1, 20, 7), (1, 30, 7)], "k LONG, t LONG, v LONG")
    rows = rows.withColumn("v", F.col("v").cast("decimal(10,2)"))
    got = sliding.sliding_sum(rows, ["k"], "t", "10 seconds", "10 seconds", {"s": "v"})
    assert [(r["window_end"], r["cnt"], int(r["s"])) for r in got.orderBy("window_end").collect()] == [
        (10, 1, 5), (20, 2, 0), (30, 1, 7), (40, 1, 7)]
    assert got.schema["s"].dataType.simpleString() == "decimal(38,2)"
