"""Which rows of a micro-batch are late, by a watermark carried from batch to batch.

With ``arrival`` columns the watermark a row meets is made of all rows that arrived before
it, in this batch or an earlier one, so which rows are late does not hang on how the stream
was cut into batches. Without, all rows of a batch meet the watermark of the batches before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.times import MILLI_US, duration_us, to_us
from millrace.operators.lateness import WATERMARK
from millrace.plans.ordered import max_so_far
from millrace.sinks.files import start_batches
from millrace.streaming.store import BatchMark

US = "__us"


@dataclass(frozen=True)
class Lateness:
    """How far rows may lag, and what moves the watermark.

    ``delay`` 0 is a source in order: the watermark stands one millisecond behind the greatest
    time, so rows of that time are still welcome. Where ``control`` is given, only rows that
    meet it move the watermark, to their own time less ``delay``.
    """

    delay: str | float = 0
    arrival: tuple[str, ...] = ()
    control: Column | None = None

    def _moves(self, us: Column) -> Column:
        if self.control is not None:
            return F.when(self.control, us - F.lit(duration_us(self.delay)))
        return us - F.lit(max(duration_us(self.delay), MILLI_US))

    def marked(self, rows: DataFrame, ts: str, before: int | None, unit: str = "s") -> DataFrame:
        """Adds ``__us``, the row's time, and ``watermark_us``, what it meets. Rows without a time go."""
        timed = rows.withColumn(US, to_us(rows, ts, unit)).filter(F.col(US).isNotNull())
        start = F.lit(before).cast("long")
        if not self.arrival:
            return timed.withColumn(WATERMARK, start)
        marked = max_so_far(timed, [], list(self.arrival), self._moves(F.col(US)), WATERMARK)
        return marked.withColumn(WATERMARK, F.greatest(WATERMARK, start))

    def reached(self, marked: DataFrame, before: int | None) -> int | None:
        """The watermark after all rows of the batch."""
        found = marked.agg(F.max(self._moves(F.col(US)))).first()[0]
        return before if found is None else found if before is None else max(found, before)


def start_marked(
    stream: DataFrame, write: Callable[[DataFrame, int], None], path: str, checkpoint: str, ts: str,
    lateness: Lateness, unit: str = "s", available_now: bool = True,
) -> StreamingQuery:
    """Hands every micro-batch to ``write`` with the ``watermark_us`` each row meets; state lies below ``path``."""
    mark = BatchMark(f"{path}/reached")

    def step(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = mark.before(spark, batch_id)
        marked = lateness.marked(rows, ts, before, unit).persist()
        try:
            mark.put(spark, lateness.reached(marked, before), batch_id)
            write(marked.drop(US), batch_id)
        finally:
            marked.unpersist()

    return start_batches(stream, step, checkpoint, available_now=available_now)
