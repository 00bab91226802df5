"""Sliding windows on streams, from a table of open panes.

60 minutes by 5 seconds is 720 windows per row; no row is ever given its windows here. Each
micro-batch condenses its rows to panes and adds them to the panes held, one row per key and
pane. When the watermark passes windows, they are made from the panes once, all keys of a
window in the same batch, and panes that reach into no open window are left behind. So the
work of a batch follows from its rows and the open panes, not from the length of the stream.

The watermark is carried from batch to batch (:class:`Lateness`): rows in order, rows that
lag, or a watermark moved by control rows only, each by batch or by order of arrival.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.times import duration_us
from millrace.operators.lateness import WATERMARK
from millrace.operators.ranking import top_n
from millrace.plans.aggregates import WINDOW_END, Accumulator, LeastRecord, Merged, Sums, WindowAggregate
from millrace.plans.panes import FIRST_START, PANE, Panes
from millrace.sinks.files import start_batches
from millrace.streaming.arrivals import US, Lateness
from millrace.streaming.store import BatchMark, BatchTable

__all__ = ["Accumulator", "LeastRecord", "Lateness", "Merged", "Sums", "WindowStream", "ranked", "row_count"]

Writer = Callable[[DataFrame, int], None]


def row_count() -> Sums:
    """``cnt``, the number of rows."""
    return Sums({"cnt": F.count(F.lit(1))})


@dataclass(frozen=True)
class WindowStream:
    """``aggregate`` over windows of ``size`` by ``slide`` per ``keys``; ``path`` is the folder of the panes.

    Results are ``keys, window_end`` and the columns of the aggregate, of windows with rows.
    Rows that do not meet ``where`` move the watermark and do not count. Rows too late for a
    window are left out of it; rows without a time are none.
    """

    aggregate: WindowAggregate
    keys: Sequence[str]
    ts: str
    size: str
    slide: str
    path: str
    where: Column | None = None
    lateness: Lateness = field(default_factory=Lateness)
    unit: str = "s"

    def start(self, stream: DataFrame, write: Writer, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Runs ``write(windows, batch id)`` with the windows each micro-batch closes."""
        table, mark = self._tables(stream)

        def step(rows: DataFrame, batch_id: int) -> None:
            spark = rows.sparkSession
            before = mark.before(spark, batch_id)
            marked = self.lateness.marked(rows, self.ts, before, self.unit).persist()
            try:
                reached = self.lateness.reached(marked, before)
                held = self._open(table.before(spark, batch_id), before)
                parts = held.unionByName(self._partial(marked))
                table.put(self.aggregate.combine(parts, self._by), batch_id)
            finally:
                marked.unpersist()
            mark.put(spark, reached, batch_id)
            write(self._closed(table.of(spark, batch_id), stream, reached), batch_id)

        return start_batches(stream, step, checkpoint, available_now=available_now)

    def rest(self, stream: DataFrame) -> DataFrame:
        """The windows that the end of the stream closes: those still open after the last batch."""
        spark, (table, mark) = stream.sparkSession, self._tables(stream)
        last = table.last(spark)
        panes = table.before(spark, 0) if last is None else table.of(spark, last)
        return self._windows(self._open(panes, mark.last(spark)), stream, None)

    @property
    def _panes(self) -> Panes:
        return Panes(duration_us(self.size), duration_us(self.slide))

    @property
    def _by(self) -> list[str]:
        return [*self.keys, PANE, FIRST_START]

    def _partial(self, marked: DataFrame) -> DataFrame:
        counted = marked if self.where is None else marked.filter(self.where)
        return self.aggregate.partial(self._panes.tag(counted, F.col(US), F.col(WATERMARK)), self._by)

    def _tables(self, stream: DataFrame) -> tuple[BatchTable, BatchMark]:
        # The schema of the panes follows from the stream's, without reading it.
        none = F.lit(None).cast("long")
        marked = stream.withColumns({US: none, WATERMARK: none})
        parts = self.aggregate.combine(self._partial(marked), self._by)
        return BatchTable(f"{self.path}/panes", parts.schema), BatchMark(f"{self.path}/reached")

    def _open(self, panes: DataFrame, reached: int | None) -> DataFrame:
        """Panes cut to the windows that are still open."""
        if reached is None:
            return panes
        first = F.greatest(F.col(FIRST_START), F.lit(self._panes.first_open(reached)))
        return panes.withColumn(FIRST_START, first).filter(F.col(FIRST_START) <= self._panes.last_start(F.col(PANE)))

    def _closed(self, panes: DataFrame, stream: DataFrame, reached: int | None) -> DataFrame:
        if reached is None:
            return self._windows(panes, stream, None).limit(0)
        return self._windows(panes, stream, self._panes.first_open(reached))

    def _windows(self, panes: DataFrame, stream: DataFrame, until: int | None) -> DataFrame:
        kind: T.DataType = stream.schema[self.ts].dataType
        return self.aggregate.windows(self._panes, panes, list(self.keys), kind, self.unit, until)


def ranked(write: Writer, n: int, by: str = "cnt", tie: Sequence[str] = ("item_id",)) -> Writer:
    """A writer that hands on the ``n`` best rows of every window: all rows of a window close in one batch."""

    def rank(rows: DataFrame, batch_id: int) -> None:
        write(top_n(rows, n, by, tie, (WINDOW_END,)), batch_id)

    return rank
