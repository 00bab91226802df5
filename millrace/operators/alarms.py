"""Alarm on a reading that does not fall back for a while."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.times import duration_us, from_us, to_us
from millrace.plans.chains import FAN, SPAN, first_later, visited
from millrace.plans.folds import SPAN_ROWS, Machine, longest, run_machine
from millrace.plans.ordered import next_match, previous_row, row_numbers
from millrace.session import reliable_checkpoint

# Fixed value: the text in front of the key.
ALARM_PREFIX = "连续升温报警"


def alarm_machine(horizon: int) -> Machine:
    """The alarm of readings ``x``: fire what is due, then compare the reading with the armed one.

    A reading above the remembered one arms a timer ``horizon`` ahead if none
    runs; a reading not above it disarms and is remembered. Rising further while
    armed changes nothing. A row exactly at the deadline still comes first.
    """

    def machine_state(temp: Column, timer: Column) -> Column:
        return F.struct(temp.alias("temp"), timer.alias("timer"))

    none = F.lit(None).cast("long")

    def step(acc: Column, row: Column) -> Column:
        state, out, us, x = acc["state"], acc["out"], row["us"], row["x"]
        due = state["timer"].isNotNull() & (state["timer"] < us)
        temp = F.when(due, F.lit(0.0)).otherwise(state["temp"])
        idle = due | state["timer"].isNull()
        timer = F.when((x > temp) & idle, us + F.lit(horizon)).when(x <= temp, none).otherwise(state["timer"])
        seen = F.when(((x > temp) & idle) | (x <= temp), x).otherwise(temp)
        return F.struct(
            machine_state(seen, timer).alias("state"),
            F.when(due, F.concat(out, F.array(state["timer"]))).otherwise(out).alias("out"),
        )

    def expire(state: Column, us: Column) -> Column:
        due = state["timer"].isNotNull() & (state["timer"] <= us)
        return F.struct(
            F.when(due, machine_state(F.lit(0.0), none)).otherwise(state).alias("state"),
            F.when(due, F.array(state["timer"])).otherwise(F.array().cast("array<bigint>")).alias("out"),
        )

    return Machine(machine_state(F.lit(0.0), none), F.array().cast("array<bigint>"), step, expire, ("x",))


def alarm_walk(rows: DataFrame, horizon: int, fan: int = FAN, span: int = SPAN) -> tuple[DataFrame, int]:
    """(key, pos, us, x, alarm_us, over) of every row that arms a timer, and the rounds it took.

    ``rows`` are (key, pos, us, x, kind), numbered within their key. A timer runs out unless a
    reading not above the arming one comes in time, so what ends it is the first later row of
    either sort; what arms the next is that row itself, if it comes after the timer and is
    above zero, or else the next row above the one before it. Each row thus points to one later
    row, and the rows that do arm are those on the way from the first. ``alarm_us`` is NULL
    where the timer was stopped; ``over`` is false where no row has ended it yet. A row of
    ``kind`` 'armed' or 'idle' is the state a walk begins with, of kind 'row' a reading.
    """
    rows = reliable_checkpoint(rows.select("key", "pos", "us", "x", "kind"))
    ended = first_later(rows, horizon, fan)
    before = previous_row(rows, ["key"], ["pos"], ["x"], "__before")
    # A row above the one before it arms a timer if none runs.
    rise = F.col("x") > F.col("__before.x")
    rising = reliable_checkpoint(next_match(before, ["key"], ["pos"], rise, ["pos"], "__rise").select(
        "key", "pos", "x", "kind", F.col("__rise.pos").alias("rise")))
    fired = F.col("found.us") > F.col("us") + F.lit(horizon)
    at_once = fired & (F.col("found.x") > 0)
    after = rising.select("key", F.col("pos").alias("end"), F.col("rise").alias("after"))
    linked = ended.withColumn("end", F.col("found.at")).join(after, ["key", "end"], "left")
    links = reliable_checkpoint(linked.select(
        "key", "pos", "us", "x", F.when(at_once, F.col("end")).otherwise(F.col("after")).alias("next"),
        F.col("end").isNotNull().alias("over"),
        F.when(fired | F.col("end").isNull(), F.col("us") + F.lit(horizon)).alias("alarm_us"),
    ))
    starts = (F.col("kind") == "armed") | ((F.col("kind") == "row") & (F.col("x") > 0))
    heads = rising.filter("pos = 1").select(
        "key", F.when(starts, F.col("pos")).otherwise(F.col("rise")).alias("pos"), F.lit(True).alias("head"))
    headed = links.join(heads, ["key", "pos"], "left").select("key", "pos", "next", F.coalesce("head", F.lit(False)).alias("head"))
    way, rounds = visited(headed, span)
    return links.join(way, ["key", "pos"]).select("key", "pos", "us", "x", "alarm_us", "over"), rounds


def run_alarms(
    rows: DataFrame, order: Sequence[str], horizon: int, entry: DataFrame | None = None, span_rows: int = SPAN_ROWS,
    rows_per_group: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(key, alarm_us) of timers that a later row finds run out, and (key, state) after each key's last row.

    ``rows`` are (key, us, x) and ``order``, without NULL values; ``entry`` (key, state) has the
    states of keys that do not begin anew. Keys of at most ``span_rows`` rows are folded in one
    go, longer ones by :func:`alarm_walk`.
    """
    machine = alarm_machine(horizon)
    if longest(rows, ["key"]) <= span_rows:
        runs = run_machine(rows, ["key"], ["us", *order], machine, entry, span_rows, rows_per_group)
        return runs.select("key", F.explode("out").alias("alarm_us")), runs.select("key", "state")
    read = rows.select("key", "us", *order, "x", F.lit("row").alias("kind"))
    if entry is not None:
        # A state is a row ahead of all others: the arming one, or one just as high as what is remembered.
        armed = F.col("state.timer").isNotNull()
        known = entry.join(rows.select("key").distinct(), "key", "left_semi")
        read = read.unionByName(known.select(
            "key", F.when(armed, F.col("state.timer") - F.lit(horizon)).otherwise(F.lit(-(1 << 62))).alias("us"),
            *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order], F.col("state.temp").alias("x"),
            F.when(armed, "armed").otherwise("idle").alias("kind"),
        ))
    read = read.withColumn("later", F.col("kind") == "row")
    numbered = reliable_checkpoint(
        row_numbers(read, ["key"], ["later", "us", *order], "pos", rows_per_group).select("key", "pos", "us", "x", "kind")
    )
    walk, _ = alarm_walk(numbered, horizon)
    walk = reliable_checkpoint(walk)
    last = numbered.groupBy("key").agg(F.max_by("x", "pos").alias("temp"))
    running = walk.filter("NOT over").select("key", F.col("x").alias("armed"), F.col("alarm_us").alias("timer"))
    state = F.struct(F.coalesce("armed", "temp").alias("temp"), "timer").alias("state")
    return walk.filter("over AND alarm_us IS NOT NULL").select("key", "alarm_us"), last.join(running, "key", "left").select("key", state)


def readings(df: DataFrame, key: str, ts: str, value: str, order: Sequence[str], unit: str = "s") -> DataFrame:
    """(key, us, x) and ``order``, as the alarms read them; rows without a value or a time go."""
    rows = df.select(
        F.struct(F.col(key).alias("key")).alias("key"), to_us(df, ts, unit).alias("us"), *order, F.col(value).cast("double").alias("x")
    )
    return rows.filter(F.col("x").isNotNull() & F.col("us").isNotNull())


def rising_alarms(
    df: DataFrame, key: str, ts: str, value: str, order: Sequence[str] = ("seq",), horizon: str = "2 seconds",
    unit: str = "s", span_rows: int = SPAN_ROWS, rows_per_group: int | None = None,
) -> DataFrame:
    """``key, alarm_ts, alarm_msg`` of every timer that ran out.

    Rows of one key are walked by (``ts``, ``order``). A timer still running
    after the last row runs out as well: the input has ended.
    """
    rows = readings(df, key, ts, value, order, unit)
    fired, states = run_alarms(rows, list(order), duration_us(horizon), None, span_rows, rows_per_group)
    left = states.select("key", F.col("state.timer").alias("alarm_us")).filter("alarm_us IS NOT NULL")
    return alarm_texts(fired.unionByName(left), key, df.schema[ts].dataType, unit)


def alarm_texts(alarms: DataFrame, name: str, kind: T.DataType, unit: str = "s") -> DataFrame:
    """(key, alarm_us) as ``name, alarm_ts, alarm_msg``."""
    return alarms.select(
        F.col("key.key").alias(name),
        from_us(F.col("alarm_us"), kind, unit).alias("alarm_ts"),
        F.concat(F.lit(ALARM_PREFIX), F.col("key.key").cast("string")).alias("alarm_msg"),
    )
