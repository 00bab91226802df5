"""Streams in several micro-batches against the batch forms."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import LOGIN, LOGINS_1, LOGINS_2, ORDER, ORDERS
from millrace.functions.parsing import parse_sensor
from millrace.operators import alarms, lateness, patterns, ranking, routing, sliding, words
from millrace.sinks import documents, files
from millrace.sinks.fanout import fan_out, read_tag, tagged_batches
from millrace.sources import kafka
from millrace.sources.lines import stream_text_lines
from millrace.plans.folds import Machine, machine_outputs, run_machine
from millrace.streaming import machines, watermarks
from millrace.streaming import patterns as stream_patterns
from millrace.streaming.arrivals import Lateness, start_marked
from millrace.streaming.patterns import PatternStream
from millrace.streaming.store import BatchTable
from millrace.streaming.windows import Accumulator, LeastRecord, WindowStream, ranked, row_count
from millrace.streaming.words import RunningCount

END = dt.datetime(2900, 1, 1)


class Feed:
    """A folder of Parquet files read as a stream, one micro-batch per run."""

    def __init__(self, spark, base, schema):
        self.spark, self.schema, self.base = spark, schema, base
        self.source, self.out, self.state = str(base / "in"), str(base / "out"), str(base / "state")
        (base / "in").mkdir()
        self.count = 0

    def stream(self):
        # One file is one micro-batch, the oldest first.
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.source)

    def add(self, rows):
        known = set((self.base / "in").glob("*.parquet"))
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.source)
        for new in set((self.base / "in").glob("*.parquet")) - known:
            self.count += 1
            os.utime(new, (1_700_000_000 + self.count,) * 2)

    def run(self, stream, write=None, mode="append"):
        files.start_batches(stream, write or files.parquet_batches(self.out), self.state, mode).awaitTermination()

    def results(self, schema):
        return files.read_batches(self.spark, self.out, schema)


@pytest.fixture
def feed(spark, tmp_path):
    def make(schema, name="feed"):
        base = tmp_path / name
        base.mkdir()
        return Feed(spark, base, schema)

    return make


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


EVENTS = "k LONG, kind STRING, ts TIMESTAMP, seq LONG, x DOUBLE"


def random_events(n=100):
    """In time order, so no split into micro-batches makes a row late."""
    rng, now, rows = random.Random(11), 0, []
    for i in range(n):
        now += rng.randint(1, 4)
        kind = rng.choice(["fail", "fail", "ok", "create", "pay"])
        rows.append((rng.randint(0, 2), kind, at(now), i, float(rng.randint(-2, 20))))
    return rows


def marker():
    return [(None, None, END, None, None)]


def split_runs(feed, build, rows, parts):
    """Runs ``build`` over ``rows`` in ``parts`` micro-batches and a final marker.

    The query is stopped before the marker comes and takes up its state again.
    """
    stream = build(feed.stream())
    step = -(-len(rows) // parts)
    query = files.start_batches(stream, files.parquet_batches(feed.out), feed.state, available_now=False)
    for i in range(0, len(rows), step):
        feed.add(rows[i:i + step])
        query.processAllAvailable()
    query.stop()
    feed.add(marker())
    feed.run(stream)
    return feed.results(stream.schema)


class Held:
    """An operator that keeps its own tables, fed in parts; each part is a micro-batch."""

    def __init__(self, feed, operator):
        self.feed, self.operator = feed, operator(f"{feed.base}/held")

    def run(self, *parts):
        for rows in parts:
            self.feed.add(rows)
        self.operator.start(self.feed.stream(), files.parquet_batches(self.feed.out), self.feed.state).awaitTermination()
        return self

    def results(self):
        rest = self.operator.rest(self.feed.stream())
        return self.feed.results(rest.schema).unionByName(rest)

    def emitted(self):
        return self.feed.results(self.operator.rest(self.feed.stream()).schema)

    def table(self, name):
        store = BatchTable(f"{self.feed.base}/held/{name}", None)
        spark, ids = self.feed.spark, store.batches(self.feed.spark)
        return ids, spark.read.parquet(files.batch_folder(store.path, ids[-1]))


def cut(rows, parts):
    step = -(-len(rows) // parts)
    return [rows[i : i + step] for i in range(0, len(rows), step)]


def strict():
    return patterns.Pattern.begin("a", F.col("kind") == "fail").next("b", F.col("kind").isin("fail", "ok")).within("7 seconds")


def relaxed(within="20 seconds"):
    # A row may be of both stages.
    pattern = patterns.Pattern.begin("a", F.col("kind").isin("create", "ok")).followed_by("b", F.col("kind").isin("pay", "ok"))
    return pattern if within is None else pattern.within(within)


COLUMNS = ["kind", "ts", "seq"]


@pytest.mark.parametrize("parts,keys", [(1, ["k"]), (3, []), (3, ["k"]), (7, ["k"])])
def test_strict_patterns(spark, feed, rows_of, parts, keys):
    rows = random_events()
    want = patterns.match(spark.createDataFrame(rows, EVENTS), strict(), keys, "ts", "seq", COLUMNS)
    held = Held(feed(EVENTS), lambda path: PatternStream(strict(), keys, "ts", "seq", COLUMNS, path, rows_per_group=15 if parts == 3 else None))
    # The query ends and takes up its tables again.
    half = -(-parts // 2)
    got = held.run(*cut(rows, parts)[:half]).run(*cut(rows, parts)[half:]).results()
    assert got.schema.simpleString() == want.schema.simpleString()
    assert want.count() > 5 and rows_of(got) == rows_of(want)


@pytest.mark.parametrize("parts", [1, 7])
def test_relaxed_patterns_and_timeouts(spark, feed, rows_of, parts):
    rows = random_events()
    want = patterns.match_or_timeout(spark.createDataFrame(rows, EVENTS), relaxed(), ["k"], "ts", "seq", COLUMNS)
    held = Held(feed(EVENTS), lambda path: PatternStream(relaxed(), ["k"], "ts", "seq", COLUMNS, path, outcomes=True))
    assert want.select("status").distinct().count() == 2 and rows_of(held.run(*cut(rows, parts)).results()) == rows_of(want)


def test_pattern_without_limit_or_keys(spark, feed, rows_of):
    rows = random_events()
    want = patterns.match(spark.createDataFrame(rows, EVENTS), relaxed("900 days"), [], "ts", "seq", COLUMNS)
    held = Held(feed(EVENTS), lambda path: PatternStream(relaxed(None), [], "ts", "seq", COLUMNS, path))
    assert rows_of(held.run(*cut(rows, 4)).results()) == rows_of(want)


def test_patterns_within_the_lateness(spark, feed, rows_of):
    """Rows in any order within the lateness; later ones, and rows without a time, are left out."""
    rows = random_events()
    shuffled = [row for part in cut(rows, 10) for row in reversed(part)]
    lost = [(0, "fail", at(1), 1000, 0.0), (1, "ok", None, 1001, 0.0)]
    want = patterns.match(spark.createDataFrame(rows, EVENTS), strict(), ["k"], "ts", "seq", COLUMNS)
    held = Held(feed(EVENTS), lambda path: PatternStream(strict(), ["k"], "ts", "seq", COLUMNS, path, lateness=Lateness("50 seconds")))
    assert rows_of(held.run(*cut(shuffled, 5), lost).results()) == rows_of(want)


def test_settled_matches_come_at_once_and_what_is_held_is_bounded(spark, feed):
    rows = [(i % 3, "fail", at(i), i, 0.0) for i in range(300)]
    held = Held(feed(EVENTS), lambda path: PatternStream(strict(), ["k"], "ts", "seq", COLUMNS, path))
    held.run(*cut(rows, 4))
    ids, kept = held.table("held")
    # Two batches back there is nothing left; the rows of the last second and one per key are.
    assert ids == [2, 3] and kept.count() <= 1 + 3
    assert held.emitted().count() == 300 - 3 - 1
    waiting = Held(feed(EVENTS, "other"), lambda path: PatternStream(
        relaxed("10 seconds"), ["k"], "ts", "seq", COLUMNS, path, outcomes=True))
    waiting.run(*cut([(i, "create", at(i), i, 0.0) for i in range(300)], 4))
    assert waiting.table("held")[1].count() <= 11


def test_a_repeated_batch_gives_the_same(spark, feed, rows_of):
    """A writer that fails after its batch was written: the batch is run again."""
    rows = random_events()
    want = patterns.match(spark.createDataFrame(rows, EVENTS), strict(), ["k"], "ts", "seq", COLUMNS)
    held = Held(feed(EVENTS), lambda path: PatternStream(strict(), ["k"], "ts", "seq", COLUMNS, path))
    parts = cut(rows, 4)
    held.run(*parts[:2])
    write = files.parquet_batches(held.feed.out)

    def failing(found, batch):
        write(found, batch)
        raise RuntimeError("lost")

    held.feed.add(parts[2])
    with pytest.raises(Exception, match="lost"):
        held.operator.start(held.feed.stream(), failing, held.feed.state).awaitTermination()
    assert rows_of(held.run(parts[3]).results()) == rows_of(want)


def test_patterns_run_without_python(spark, feed):
    operator = PatternStream(relaxed(), ["k"], "ts", "seq", COLUMNS, "/nowhere", outcomes=True)
    rows = spark.createDataFrame(spark.range(3).selectExpr(
        "id AS k", "'ok' AS kind", "timestamp_seconds(id) AS ts", "id AS seq", "0D AS x", "id AS __us", "id AS watermark_us").rdd,
        EVENTS + ", __us LONG, watermark_us LONG").cache()
    plan = operator._results(operator._matched(operator._fresh(rows)), 5, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("rows,keys,users", [(LOGINS_1, None, [31, 31, 32]), (LOGINS_2, [], [42])])
def test_login_fixtures(feed, rows, keys, users):
    held = Held(feed(LOGIN + ", seq LONG"), lambda path: stream_patterns.fail_streaks(path, keys=keys))
    held.run([(*row, i) for i, row in enumerate(rows)])
    assert sorted(r.begin.user_id for r in held.results().collect()) == users


def test_order_fixture(feed):
    held = Held(feed(ORDER + ", seq LONG"), stream_patterns.order_results)
    held.run(*cut([(*row, i) for i, row in enumerate(ORDERS)], 3))
    found = patterns.order_texts(held.results(), "order_id", "event_time").collect()
    assert sorted((r.order_id, r.status) for r in found) == [(71, "timeout"), (72, "matched"), (73, "timeout")]


# --- machines ---------------------------------------------------------------------


def alarm_stream(path, **options):
    return machines.rising_alarms(path, "k", "ts", "x", horizon="9 seconds", **options)


@pytest.mark.parametrize("parts,sizes", [(4, {}), (2, {"span_rows": 5, "rows_per_group": 30})])
def test_rising_alarms(spark, feed, rows_of, parts, sizes):
    rows = random_events()
    want = alarms.rising_alarms(spark.createDataFrame(rows, EVENTS), "k", "ts", "x", horizon="9 seconds")
    held = Held(feed(EVENTS), lambda path: alarm_stream(path, **sizes)).run(*cut(rows, parts))
    got = machines.alarm_rows(held.results(), held.feed.stream(), "k", "ts")
    assert want.count() > 5 and rows_of(got) == rows_of(want)


def test_machines_order_rows_within_the_lateness(spark, feed, rows_of):
    rows = random_events(60)
    shuffled = [row for i in range(0, 60, 6) for row in reversed(rows[i:i + 6])]
    want = alarms.rising_alarms(spark.createDataFrame(rows, EVENTS), "k", "ts", "x", horizon="9 seconds")
    held = Held(feed(EVENTS), lambda path: alarm_stream(path, lateness=Lateness("30 seconds"))).run(*cut(shuffled, 4))
    assert rows_of(machines.alarm_rows(held.results(), held.feed.stream(), "k", "ts")) == rows_of(want)


def streak_machine(limit):
    """Two failures in a row, told as a machine: the state is the failure before."""
    none = F.lit(None).cast("long")
    nothing = F.array().cast("array<struct<first: bigint, last: bigint>>")

    def step(acc, row):
        state, out = acc["state"], acc["out"]
        near = row["hit"] & state["us"].isNotNull() & (row["us"] - state["us"] < F.lit(limit))
        pair = F.array(F.struct(state["us"].alias("first"), row["us"].alias("last")))
        return F.struct(
            F.struct(F.when(row["hit"], row["us"]).otherwise(none).alias("us")).alias("state"),
            F.when(near, F.concat(out, pair)).otherwise(out).alias("out"),
        )

    def expire(state, us):
        gone = F.struct(F.when(state["us"] + F.lit(limit) > us, state["us"]).alias("us"))
        return F.struct(gone.alias("state"), nothing.alias("out"))

    return Machine(F.struct(none.alias("us")), nothing, step, expire, ("hit",))


def test_one_machine_in_a_table_and_on_a_stream(spark, feed, rows_of):
    rows, limit = random_events(), 7_000_000

    def read(df):
        return df.select(
            F.struct("k").alias("key"), F.unix_micros("ts").alias("us"), "seq", (F.col("kind") == "fail").alias("hit"))

    machine, table = streak_machine(limit), read(spark.createDataFrame(rows, EVENTS))
    pairs = patterns.fail_streaks(spark.createDataFrame(rows, EVENTS), "ts", "seq", "k", "kind", within="7 seconds")
    want = rows_of(pairs.select("user_id", F.unix_micros("first_time"), F.unix_micros("last_fail_time")))
    flat = lambda found: rows_of(found.select("key.k", "out.first", "out.last"))
    for sizes in ({}, {"span_rows": 5, "rows_per_group": 20}):
        runs = run_machine(table, ["key"], ["us", "seq"], machine, **sizes)
        assert len(want) > 5 and flat(machine_outputs(runs, ["key"], machine)) == want
    held = Held(feed(EVENTS), lambda path: machines.MachineStream(machine, read, ["seq"], "ts", path, span_rows=6))
    assert flat(held.run(*cut(rows, 3)).results()) == want
    # Failures older than the limit are forgotten.
    assert held.table("states")[1].count() <= 3


def alarms_of_saw_teeth(n):
    """Alarms of 0, 1, ... 49, 0, 1, ... a second apart, by a plain walk."""
    temp, timer, count = 0.0, None, 0
    for second in range(n):
        x = second % 50
        if timer is not None and timer < second:
            count, temp, timer = count + 1, 0.0, None
        if x <= temp:
            temp, timer = x, None
        elif timer is None:
            temp, timer = x, second + 9
    return count + (timer is not None)


def test_one_key_in_linear_time(spark, feed):
    """100,000 rows of one key, five times what is folded in one go, take about four times as long as 25,000, or less."""
    import time

    took = {}
    for n in (25_000, 100_000):
        f = feed(EVENTS, f"n{n}")
        rows = spark.range(0, n, 1, 1).select(
            F.lit(1).cast("long").alias("k"), F.lit("r").alias("kind"), F.timestamp_seconds(F.col("id")).alias("ts"),
            F.col("id").alias("seq"), (F.col("id") % 50).cast("double").alias("x"))
        rows.write.mode("append").parquet(f.source)
        held = Held(f, alarm_stream)
        began = time.time()
        held.run()
        took[n] = time.time() - began
        assert held.results().count() == alarms_of_saw_teeth(n)
    assert took[100_000] < 5 * took[25_000]


# --- windows ------------------------------------------------------------------------


def counts(path, size="60 seconds", slide="5 seconds", where=None, **options):
    return WindowStream(row_count(), ["k"], "ts", size, slide, path, where=where, **options)


@pytest.mark.parametrize("parts", [1, 3])
def test_sliding_counts_and_ranking(spark, feed, rows_of, parts):
    rows = random_events()
    table = spark.createDataFrame(rows, EVENTS)
    want = ranking.top_n(
        sliding.sliding_count(table.filter("kind = 'ok'"), ["k"], "ts", "60 seconds", "5 seconds"), 2, tie=["k"])
    f = feed(EVENTS)
    operator = counts(f"{f.base}/held", where=F.col("kind") == "ok")
    for part in cut(rows, parts):
        f.add(part)
    operator.start(f.stream(), ranked(files.parquet_batches(f.out), 2, tie=["k"]), f.state).awaitTermination()
    rest = ranking.top_n(operator.rest(f.stream()), 2, tie=["k"])
    got = f.results(rest.schema).unionByName(rest).select(*want.columns)
    assert rows_of(got) == rows_of(want)


def least():
    return LeastRecord("x", ["seq"], ["seq", "ts"])


def total():
    """Sum of x by rows and by accumulators, and the kinds in order of arrival."""
    start = F.struct(F.lit(0.0).alias("x"), F.lit("").alias("kinds"))
    both = lambda x, kinds: F.struct(x.alias("x"), kinds.alias("kinds"))
    return Accumulator(
        start, lambda a, row: both(a["x"] + row["x"], F.concat(a["kinds"], F.substring(row["kind"], 1, 1))),
        lambda a, b: both(a["x"] + b["x"], F.concat(a["kinds"], b["kinds"])), lambda a: a, ["seq", "kind", "x"],
    )


@pytest.mark.parametrize("aggregate", [least, total])
@pytest.mark.parametrize("parts", [3])
def test_aggregates_in_batches(spark, feed, rows_of, aggregate, parts):
    rows = random_events(90)
    want = sliding.sliding_windows(
        spark.createDataFrame(rows, EVENTS).coalesce(1), aggregate(), ["k"], "ts", "15 seconds", "5 seconds")
    held = Held(feed(EVENTS), lambda path: WindowStream(aggregate(), ["k"], "ts", "15 seconds", "5 seconds", path))
    assert rows_of(held.run(*cut(rows, parts)).results()) == rows_of(want)


def test_accumulators_against_plain_windows(spark):
    rows = random_events(60)
    found = sliding.sliding_accumulated(
        spark.createDataFrame(rows, EVENTS).repartition(4), total(), ["k"], "ts", "15 seconds", "5 seconds")
    for r in found.collect():
        inside = [e for e in rows if e[0] == r["k"] and r["window_end"] - dt.timedelta(seconds=15) <= e[2] < r["window_end"]]
        assert r["result"]["x"] == sum(e[4] for e in inside) and sorted(r["result"]["kinds"]) == sorted(e[1][0] for e in inside)


def test_open_panes_are_bounded_and_windows_come_once(spark, feed):
    rows = [(i % 3, "ok", at(i), i, 1.0) for i in range(600)]
    held = Held(feed(EVENTS), counts)
    held.run(*cut(rows, 4))
    ids, panes = held.table("panes")
    # A window of a minute has twelve panes of five seconds; the last batch brings thirty more.
    assert ids == [2, 3] and panes.count() <= 3 * (12 + 30 + 1)
    assert panes.groupBy("k", "__pane").count().filter("count > 1").isEmpty()
    emitted = held.emitted()
    assert emitted.count() == emitted.select("k", "window_end").distinct().count() > 300


@pytest.mark.parametrize("lateness,counted", [(0, 1), ("30 seconds", 2)])
def test_late_rows_are_dropped_unless_allowed(feed, lateness, counted):
    held = Held(feed(EVENTS), lambda path: counts(path, "10 seconds", "10 seconds", lateness=Lateness(lateness)))
    held.run([(1, "a", at(5), 0, 0.0)], [(1, "a", at(25), 1, 0.0)], [(1, "a", at(6), 2, 0.0)], [(1, "a", None, 3, 0.0)])
    assert held.results().filter(F.col("window_end") == F.lit(at(10))).first().cnt == counted


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_which_rows_are_late_does_not_hang_on_the_batches(spark, feed, rows_of, tmp_path, parts):
    rng = random.Random(3)
    rows = [(k, kind, ts - dt.timedelta(seconds=rng.choice([0, 0, 5, 40])), seq, x) for k, kind, ts, seq, x in random_events()]
    marked = lateness.bounded_watermark(spark.createDataFrame(rows, EVENTS), ["seq"], "ts", "10 seconds")
    want = sliding.sliding_count(marked, ["k"], "ts", "20 seconds", "5 seconds", lateness.WATERMARK)
    late = lateness.late_rows(marked, "ts", "20 seconds", "5 seconds").select("seq")
    allowed = Lateness("10 seconds", ("seq",))
    held = Held(feed(EVENTS), lambda path: counts(path, "20 seconds", lateness=allowed))
    assert rows_of(held.run(*cut(rows, parts)).results()) == rows_of(want) and late.count() > 5
    f = feed(EVENTS, "late")
    for part in cut(rows, parts):
        f.add(part)
    start_marked(
        f.stream(), lambda found, batch: files.parquet_batches(f.out)(
            lateness.late_rows(found, "ts", "20 seconds", "5 seconds").select("seq"), batch),
        f"{f.base}/held", f.state, "ts", allowed).awaitTermination()
    assert rows_of(f.results(late.schema)) == rows_of(late)


def test_rows_between_windows_do_not_count(spark, feed, rows_of):
    rows = [(1, "a", at(1), 0, 1.0), (1, "a", at(8), 1, 1.0), (1, "a", at(21), 2, 1.0)]
    held = Held(feed(EVENTS), lambda path: counts(path, "5 seconds", "10 seconds")).run(rows)
    want = sliding.sliding_count(spark.createDataFrame(rows, EVENTS), ["k"], "ts", "5 seconds", "10 seconds")
    assert rows_of(held.results()) == rows_of(want)


def test_null_values_are_no_least_record(spark, feed, rows_of):
    rows = [(1, "a", at(1), 0, None), (1, "a", at(2), 1, 5.0), (2, "a", at(3), 2, None)]
    record = LeastRecord("x", ["seq"], ["seq"])
    held = Held(feed(EVENTS), lambda path: WindowStream(record, ["k"], "ts", "10 seconds", "5 seconds", path)).run(rows)
    want = rows_of(sliding.sliding_min_record(
        spark.createDataFrame(rows, EVENTS), ["k"], "ts", "10 seconds", "5 seconds", "x", ["seq"], ["seq"]))
    assert rows_of(held.results()) == want and {r[2] for r in want} == {5.0}


CONTROLLED = [("s", t, i, float(t)) for i, t in enumerate([1, 3, 2, 30, 4, 31])] + [
    ("c", 20, 6, 0.0), ("s", 5, 7, -1.0), ("s", 22, 8, -2.0)]


@pytest.mark.parametrize("cuts", [[], [4], [7], [2, 7, 8]])
def test_punctuated_watermark(feed, cuts):
    held = Held(feed("id STRING, t LONG, seq LONG, x DOUBLE"), lambda path: WindowStream(
        LeastRecord("x", ["seq"], ["t"]), ["id"], "t", "10 seconds", "10 seconds", path,
        lateness=Lateness(arrival=("seq",), control=F.col("id") == "c")))
    held.run(*[CONTROLLED[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, len(CONTROLLED)])])
    read = lambda found: {(r.id, r.window_end): r.x for r in found.collect()}
    # The row at 5 comes after the control row at 20 and is late, the one at 22 is not.
    assert read(held.results()) == {("s", 10): 1.0, ("s", 40): 30.0, ("c", 30): 0.0, ("s", 30): -2.0}
    # Each closed window came once, and its panes are gone.
    assert read(held.emitted()) == {("s", 10): 1.0} and held.emitted().count() == 1


def test_punctuated_work_does_not_grow_with_history(feed):
    held = Held(feed("id STRING, t LONG, seq LONG, x DOUBLE"), lambda path: WindowStream(
        LeastRecord("x", ["seq"], ["t"]), ["id"], "t", "10 seconds", "10 seconds", path,
        lateness=Lateness(arrival=("seq",), control=F.col("id") == "c")))
    sizes = []
    for batch in range(4):
        held.run([("c" if i % 20 == 19 else "s", 100 * batch + i, 100 * batch + i, float(i)) for i in range(100)])
        sizes.append(held.table("panes")[1].count())
    assert max(sizes[1:]) <= 2 * 11 and len(held.table("panes")[0]) == 2


# --- running counts -------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 4])
def test_running_counts_go_on_from_batch_to_batch(spark, feed, rows_of, parts):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["rain", "wind", "sun", ""], k=6))) for i in range(40)]
    want = words.running_word_count(spark.createDataFrame(rows, "n LONG, value STRING"), ["n"])
    f = feed("n LONG, value STRING")
    running = RunningCount(["n"], "value", " ", f"{f.base}/held", rows_per_group=25)
    for part in cut(rows, parts):
        f.add(part)
    running.start(f.stream(), files.parquet_batches(f.out), f.state).awaitTermination()
    got = f.results(running.schema(f.stream()))
    assert rows_of(got.select(*want.columns)) == rows_of(want)


def test_watermark_helpers(feed):
    plan = watermarks.bounded(feed(EVENTS).stream(), "ts", "2 seconds")
    assert plan.isStreaming and watermarks.ascending(plan.select("ts"), "ts").isStreaming


def test_running_word_count_to_text(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    out = str(tmp_path / "out")
    counts = words.word_count(stream_text_lines(spark, str(folder)))
    for i, text in enumerate(["hello world\nhello\n", "hello\n"]):
        (folder / f"{i}.txt").write_text(text)
        files.start_batches(counts, files.pair_batches(out), str(tmp_path / "state"), "update").awaitTermination()
    first = {r.value for r in spark.read.text(files.batch_folder(out, 0)).collect()}
    second = {r.value for r in spark.read.text(files.batch_folder(out, 1)).collect()}
    assert first == {"(hello,2)", "(world,1)"} and second == {"(hello,3)"}


def test_kafka_rows_are_decoded_and_parsed(spark, feed):
    f = feed(kafka.RECORD_SCHEMA)
    f.add([(None, bytearray(b"s1, 10, 3.5"), "t", 0, 0, at(0), 0)])
    stream = parse_sensor(kafka.decode_values(f.stream()))
    f.run(stream)
    assert tuple(f.results(stream.schema).first()) == ("s1", 10, 3.5)


def test_routed_stream_fans_out(spark, feed, tmp_path):
    f = feed("id STRING, temperature DOUBLE")
    f.add([("a", 31.9), ("b", 32.0)])
    cold, main = str(tmp_path / "cold"), str(tmp_path / "main")
    writers = {routing.FREEZE_TAG: files.parquet_batches(cold), routing.MAIN: files.parquet_batches(main)}
    f.run(routing.freeze_route(f.stream()), fan_out(writers))
    assert [r.id for r in spark.read.parquet(cold).collect()] == ["a"]
    assert [r.id for r in spark.read.parquet(main).collect()] == ["b"]


def test_any_number_of_tags_in_one_job(spark, feed):
    f = feed("x INT")
    f.add([(i,) for i in range(60)])
    routed = routing.route(f.stream(), {f"rest {r}": F.col("x") % 7 == r for r in range(6)})
    jobs = []
    write = tagged_batches(f.out)

    def counted(rows, batch):
        spark.sparkContext.setJobGroup("tags", "tags")
        write(rows, batch)
        jobs.extend(spark.sparkContext.statusTracker().getJobIdsForGroup("tags"))

    f.run(routed, counted)
    schema = f.stream().schema
    for r in range(6):
        assert sorted(row.x for row in read_tag(spark, f.out, f"rest {r}", schema).collect()) == list(range(r, 60, 7))
    assert sorted(row.x for row in read_tag(spark, f.out, routing.MAIN, schema).collect()) == list(range(6, 60, 7))
    assert len(jobs) == 1 and read_tag(spark, f.out, "no such tag", schema).isEmpty()


def test_document_batches(feed, tmp_path):
    f = feed("id STRING, t LONG, x DOUBLE")
    f.add([(str(i), i, 0.5) for i in range(250)])
    target = tmp_path / "requests"
    target.mkdir()
    folder = str(target)

    def writer(batch):
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
            out.write(documents.bulk_body(batch, "readings"))

    payload = F.to_json(F.struct("id"))
    f.run(f.stream(), documents.document_batches(payload, writer))
    sizes = [len(p.read_text().splitlines()) // 2 for p in target.iterdir()]
    assert sum(sizes) == 250 and max(sizes) <= 100
