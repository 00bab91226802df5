"""State machines and timers on streams, by the folds for tables.

Each micro-batch puts its rows to those held from before, runs the machine over the ones the
watermark has settled, from the states kept, and lets time run on to the watermark. What is
kept is one state per key that is not in its first state, and the rows not settled yet. One
description (:class:`Machine`) serves tables and streams; no row passes through Python.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.times import duration_us
from millrace.operators.alarms import alarm_machine, alarm_texts, readings, run_alarms
from millrace.operators.lateness import WATERMARK
from millrace.plans.folds import SPAN_ROWS, Machine, run_machine
from millrace.sinks.files import start_batches
from millrace.streaming.arrivals import US, Lateness
from millrace.streaming.store import BatchMark, BatchTable

Writer = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class MachineStream:
    """``machine`` over a stream; ``path`` is the folder of what it keeps.

    ``rows(stream)`` gives (key struct, ``us``, ``order``, the machine's columns) of the rows it is
    to read. Results are (key, out), one row per thing emitted, in any order.
    """

    machine: Machine
    rows: Callable[[DataFrame], DataFrame]
    order: Sequence[str]
    ts: str
    path: str
    lateness: Lateness = field(default_factory=Lateness)
    unit: str = "s"
    span_rows: int = SPAN_ROWS
    rows_per_group: int | None = None

    def start(self, stream: DataFrame, write: Writer, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Runs ``write(results, batch id)`` for every micro-batch."""
        held, states, mark = self._tables(stream)

        def step(rows: DataFrame, batch_id: int) -> None:
            spark = rows.sparkSession
            before = mark.before(spark, batch_id)
            marked = self.lateness.marked(rows, self.ts, before, self.unit).persist()
            reached = self.lateness.reached(marked, before)
            in_time = F.col(WATERMARK).isNull() | (F.col(US) > F.col(WATERMARK))
            both = held.before(spark, batch_id).unionByName(self.rows(marked.filter(in_time))).persist()
            settled = F.lit(False) if reached is None else F.col("us") <= F.lit(reached)
            emitted, left = self._run(both.filter(settled), states.before(spark, batch_id))
            found, after = self._expired(emitted, left.persist(), F.lit(reached).cast("long"))
            try:
                write(found, batch_id)
                states.put(after, batch_id)
                held.put(both.filter(~settled), batch_id)
                mark.put(spark, reached, batch_id)
            finally:
                for frame in (left, both, marked):
                    frame.unpersist()

        return start_batches(stream, step, checkpoint, available_now=available_now)

    def rest(self, stream: DataFrame) -> DataFrame:
        """What the end of the stream brings: rows not settled before, and all timers left."""
        spark, (held, states, _) = stream.sparkSession, self._tables(stream)
        last = held.last(spark)
        rows, begun = (t.before(spark, 0) if last is None else t.of(spark, last) for t in (held, states))
        return self._expired(*self._run(rows, begun), F.lit(1 << 62))[0]

    def _tables(self, stream: DataFrame) -> tuple[BatchTable, BatchTable, BatchMark]:
        rows = self.rows(stream)
        kept = rows.select("key", self.machine.state.alias("state")).schema
        # Fields of a literal state are never NULL; those of a later one may be.
        kept = type(kept).fromDDL(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept))
        return (
            BatchTable(f"{self.path}/held", rows.schema), BatchTable(f"{self.path}/states", kept), BatchMark(f"{self.path}/reached")
        )

    def _run(self, rows: DataFrame, begun: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(key, out) emitted by rows, and (key, state) of all keys after them."""
        runs = run_machine(rows, ["key"], ["us", *self.order], self.machine, begun, self.span_rows, self.rows_per_group)
        return runs.select("key", F.explode("out").alias("out")), _ends(runs.filter("last").select("key", "state"), begun)

    def _expired(self, emitted: DataFrame, left: DataFrame, us: Column) -> tuple[DataFrame, DataFrame]:
        """The same after time has come to ``us``."""
        over = left.select("key", self.machine.expire(F.col("state"), us).alias("e"))
        found = emitted.unionByName(over.select("key", F.explode("e.out").alias("out")))
        return found, over.select("key", "e.state").filter(~F.col("state").eqNullSafe(self.machine.state))


def _ends(ran: DataFrame, begun: DataFrame) -> DataFrame:
    """The states after a batch: those of keys with rows, and those of all others as they were."""
    return ran.unionByName(begun.join(ran, "key", "left_anti"))


@dataclass(frozen=True)
class AlarmStream(MachineStream):
    """The rising alarm: the same machine, with long keys walked by jumps."""

    horizon: int = 0

    def _run(self, rows: DataFrame, begun: DataFrame) -> tuple[DataFrame, DataFrame]:
        fired, ends = run_alarms(rows, list(self.order), self.horizon, begun, self.span_rows, self.rows_per_group)
        return fired.select("key", F.col("alarm_us").alias("out")), _ends(ends, begun)


def rising_alarms(
    path: str, key: str, ts: str, value: str, seq: str = "seq", horizon: str = "2 seconds",
    lateness: Lateness = Lateness(), unit: str = "s", **sizes: int,
) -> AlarmStream:
    """Alarms on a stream; write its results through :func:`alarm_rows`."""
    limit = duration_us(horizon)
    return AlarmStream(
        alarm_machine(limit), lambda df: readings(df, key, ts, value, [seq], unit), [seq], ts, path, lateness, unit,
        horizon=limit, **sizes,
    )


def alarm_rows(found: DataFrame, stream: DataFrame, key: str, ts: str, unit: str = "s") -> DataFrame:
    """Results of :func:`rising_alarms` as ``key, alarm_ts, alarm_msg``."""
    return alarm_texts(found.select("key", F.col("out").alias("alarm_us")), key, stream.schema[ts].dataType, unit)
