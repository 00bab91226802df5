"""Small inputs with results worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import START as BASE
from millrace.functions import parsing, rendering
from millrace.operators import alarms, patterns, ranking, routing, sliding, words
from millrace.sources import lines



@pytest.fixture(scope="module")
def sensors(sensor_lines):
    return parsing.parse_sensor(sensor_lines)


def test_fail_streaks_chain_and_exclude_two_seconds(logins_1, rows_of):
    found = patterns.fail_streaks(logins_1).collect()
    assert {r.warning_msg for r in found} == {"login fail in 2 seconds"}
    assert sorted((r.user_id, r.first_time - BASE, r.last_fail_time - BASE) for r in found) == [
        (31, 5, 6), (31, 6, 7), (32, 21, 21),
    ]


@pytest.mark.parametrize("keys", [[], ["user_id"]])
def test_strict_pattern(logins_2, rows_of, keys):
    found = patterns.fail_streaks(logins_2, keys=keys, message=patterns.FAIL_PATTERN_MESSAGE)
    assert rows_of(found) == [(42, BASE + 50, BASE + 51, patterns.FAIL_PATTERN_MESSAGE)]


def test_unkeyed_pattern_spans_users(make, rows_of):
    rows = make([(1, "", "fail", 100), (2, "", "fail", 101)], "user_id LONG, ip STRING, event_type STRING, event_time LONG")
    assert rows_of(patterns.fail_streaks(rows, keys=[]).drop("warning_msg")) == [(1, 100, 101)]
    assert patterns.fail_streaks(rows).count() == 0


def test_orders_paid_and_timed_out(orders, rows_of):
    found = patterns.order_results(orders)
    paid = found.filter("status = 'matched'").drop("deadline")
    assert rows_of(paid) == [(72, "matched", "order pay successfully", BASE + 110, BASE + 400)]
    late = found.filter("status = 'timeout'")
    assert rows_of(late) == [
        (71, "timeout", f"超时：{BASE + 1000}", BASE + 100, None, BASE + 1000),
        (73, "timeout", f"超时：{BASE + 1020}", BASE + 120, None, BASE + 1020),
    ]


def test_one_payment_completes_all_open_orders(make, rows_of):
    rows = make([(1, "create", 0), (1, "create", 5), (1, "pay", 9), (1, "pay", 10), (2, "pay", 3)],
                "order_id LONG, event_type STRING, event_time LONG")
    assert rows_of(patterns.order_results(rows).select("create_ts", "pay_ts")) == [(0, 9), (5, 9)]


def test_within_is_strict(make):
    rows = make([(1, "create", 0), (1, "pay", 900)], "order_id LONG, event_type STRING, event_time LONG")
    assert patterns.order_results(rows).first().status == "timeout"


def test_pattern_stages_by_name(logins_2):
    failed = F.col("event_type") == "fail"
    pattern = patterns.Pattern.begin("begin", failed).next("next", failed).within("2 seconds")
    row = patterns.match(logins_2, pattern, ["user_id"], "event_time", "seq").first()
    assert (row.begin.event_time, row.next.event_time, row.begin.ip) == (BASE + 50, BASE + 51, "10.4.0.3")


def test_sliding_min_record(sensors, rows_of):
    found = sliding.sliding_min_record(
        sensors, ["id"], "event_time", "15 seconds", "5 seconds", "temperature", ["seq"], ["event_time"]
    )
    got = sorted((r.id, r.window_end - BASE, r.event_time - BASE) for r in found.collect())
    assert got == sorted(
        [("probe_a", e, 12) for e in (15, 20, 25)] + [("probe_b", e, 13) for e in (15, 20, 25)]
        + [("probe_c", e, 17) for e in (20, 25, 30)] + [("probe_c", e, 26) for e in (35, 40)]
    )


def test_min_record_tie_keeps_the_first(make):
    rows = make([("a", 1, 5.0), ("a", 2, 5.0)], "id STRING, event_time LONG, temperature DOUBLE")
    found = sliding.sliding_min_record(
        rows, ["id"], "event_time", "15 seconds", "5 seconds", "temperature", ["seq"], ["event_time"]
    )
    assert {r.event_time for r in found.collect()} == {1}


def test_rising_alarms(sensors):
    found = alarms.rising_alarms(sensors, "id", "event_time", "temperature")
    assert sorted((r.id, r.alarm_ts) for r in found.collect()) == sorted(
        [("probe_a", BASE + 14), ("probe_b", BASE + 15), ("probe_c", BASE + 28)]
    )
    assert found.filter("id = 'probe_a'").first().alarm_msg == "连续升温报警probe_a"


def test_freeze_route(sensors, rows_of):
    routed = routing.freeze_route(sensors)
    cold = routing.side_output(routed, routing.FREEZE_TAG).select("id", F.col("event_time") - BASE)
    assert rows_of(cold) == [("probe_b", 13), ("probe_c", 17)]
    assert routing.side_output(routed, routing.MAIN).count() == 3


def test_word_counts(make, rows_of):
    source = make([("rain wind",)] * 9, "value STRING")
    assert rows_of(words.word_count(source)) == [("rain", 9), ("wind", 9)]
    log = words.running_word_count(source, ["seq"])
    assert rows_of(log.select("word", "cnt")) == sorted((w, n) for w in ("rain", "wind") for n in range(1, 10))


def test_split_connect_union(spark, rows_of):
    tagged = routing.split(lines.integers(spark, 1, 8), routing.parity_tags(F.col("x")))
    odd, even = routing.select(tagged, "奇数"), routing.select(tagged, "偶数")
    assert rows_of(odd) == [(1,), (3,), (5,), (7,)]
    assert rows_of(even) == [(2,), (4,), (6,), (8,)]
    assert routing.select(tagged, "奇数", "偶数").count() == 8
    assert routing.union(odd, even).count() == 8
    text = routing.connect_map(
        odd, even,
        lambda df: df.select(F.concat(F.lit("奇数"), F.col("x").cast("string")).alias("text")),
        lambda df: df.select(F.concat(F.lit("偶数："), F.col("x").cast("string")).alias("text")),
    )
    assert {r.text for r in text.collect()} == {
        "奇数1", "奇数3", "奇数5", "奇数7", "偶数：2", "偶数：4", "偶数：6", "偶数：8"
    }


def test_negative_odd_numbers_are_odd(make):
    tagged = routing.split(make([(-3,), (-2,)], "x INT"), routing.parity_tags(F.col("x")))
    assert [r.x for r in routing.select(tagged, "奇数").collect()] == [-3]


def test_behavior_line(make):
    row = parsing.parse_behavior(make([("901,22,3333,pv,1700000123",)], "value STRING")).first()
    assert (row.user_id, row.item_id, row.category_id, row.behavior, row.event_time) == (
        901, 22, 3333, "pv", 1700000123
    )


def test_visit_line_keeps_blanks(make):
    row = parsing.parse_visit(make([(" 2020-02-03 04:05:06 , m1,7, http://x",)], "value STRING")).first()
    assert (str(row.ts), row.mid, row.uid, row.url) == ("2020-02-03 04:05:06", " m1", "7", " http://x")


def test_strict_parsing_fails_on_bad_lines(make):
    for bad in ("a,1", "a,1,2,3", "a,x,2.0", "   ", ""):
        with pytest.raises(Exception, match="cannot parse line"):
            parsing.parse_sensor(make([(bad,)], "value STRING")).collect()


def test_permissive_parsing_keeps_bad_lines(make):
    table = make([("a,1,2.0",), ("a,1",), ("a,1,2.0,,",), ("",), (None,)], "value STRING")
    good, bad = parsing.quarantine(parsing.parse_sensor(table, mode="permissive"))
    assert sorted(r.seq for r in good.collect()) == [0, 2]
    assert sorted((r.seq, r._corrupt) for r in bad.collect()) == [(1, "a,1"), (3, ""), (4, "")]


def test_seconds_beyond_int(make):
    assert parsing.parse_sensor(make([("a,4000000000,1",)], "value STRING")).first().event_time == 4_000_000_000


def test_texts(make):
    raw = parsing.parse_sensor(make([(" s1,10,3.5",)], "value STRING"), trim_id=False)
    fields = (F.col("id"), F.col("event_time"), F.col("temperature"))
    row = raw.select(
        rendering.sensor_text(*fields), rendering.describe_sensor(*fields), rendering.sensor_document(*fields)
    ).first()
    assert tuple(row) == (
        "Sensor( s1,10,3.5)", "转换成字符串： Sensor( s1,10,3.5)", '{"id":" s1","timeStamp":"10","temprature":"3.5"}'
    )


def test_reports(make):
    views = make([(7, 10), (7, 11), (8, 12)], "item_id LONG, at LONG").withColumn("ts", F.timestamp_seconds("at"))
    counts = sliding.sliding_count(views, ["item_id"], "ts", "15 seconds", "15 seconds")
    top = ranking.top_n(counts, 3)
    assert rendering.item_report(top).first().report == (
        "==================================\n时间： 1970-01-01 00:00:15.0\n"
        "No.1:  商品ID= 7 浏览量= 2\nNo.2:  商品ID= 8 浏览量= 1\n==================================\n"
    )
    assert rendering.visit_report(top, key="item_id").first().report == (
        "==================================\nNo.1WindowKeyTime(15000,7,2)\nNo.2WindowKeyTime(15000,8,1)\n"
        "==================================\n"
    )


def test_hot_items_of_the_sample_shape(make):
    rows = make([(i, i % 5, BASE + 3 * i) for i in range(200)], "user_id LONG, item_id LONG, event_time LONG")
    top = ranking.top_n(sliding.sliding_count(rows, ["item_id"], "event_time", "60 seconds", "5 seconds"), 3)
    assert top.select("window_end").distinct().count() == 131
    assert top.groupBy("window_end").count().filter("count > 3").count() == 0


def test_top_n_with_a_large_n(make, rows_of):
    rows = make([(i % 3, i % 50, i) for i in range(4000)], "window_end LONG, cnt LONG, item_id LONG")
    want = ranking.top_n(rows.filter("item_id >= 0"), 1000)
    more = ranking.top_n(rows, 1001)
    assert rows_of(more.filter("rank <= 1000")) == rows_of(want)
    assert more.count() == 3 * 1001
