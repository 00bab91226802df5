"""Running counts on a stream, as the log of every single update."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.words import running_word_count, words
from millrace.sinks.files import start_batches
from millrace.streaming.store import BatchTable

_COUNTS = T.StructType([T.StructField("word", T.StringType()), T.StructField("base", T.LongType())])


@dataclass(frozen=True)
class RunningCount:
    """Every word of every line with its number so far, on from micro-batch to micro-batch.

    A word's count is its row number inside the batch (a frequent word is cut into chunks, as
    in a table) plus its count in all batches before, which lies in one table per batch below
    ``path``. ``order`` names the columns that order the lines of a batch.
    """

    order: Sequence[str]
    text: str
    separator: str
    path: str
    rows_per_group: int | None = None

    def _numbered(self, lines: DataFrame) -> DataFrame:
        return running_word_count(lines, self.order, self.text, self.separator, self.rows_per_group)

    def schema(self, lines: DataFrame) -> T.StructType:
        """That of the log: the ``order`` columns, ``pos``, ``word``, ``cnt``."""
        pos = T.StructField("pos", T.IntegerType())
        rest = [pos, T.StructField("word", T.StringType()), T.StructField("cnt", T.LongType())]
        return T.StructType([*[lines.schema[c] for c in self.order], *rest])

    def start(
        self, lines: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True
    ) -> StreamingQuery:
        """Runs ``write(log, batch id)`` for every micro-batch."""
        table = BatchTable(f"{self.path}/counts", _COUNTS)

        def step(rows: DataFrame, batch_id: int) -> None:
            base = table.before(rows.sparkSession, batch_id)
            rows = rows.persist()
            try:
                log = self._numbered(rows).join(base, "word", "left")
                total = (F.col("cnt") + F.coalesce("base", F.lit(0))).alias("cnt")
                write(log.select(*self.order, "pos", "word", total), batch_id)
                here = words(rows, self.text, self.separator).groupBy("word").agg(F.count(F.lit(1)).alias("base"))
                table.put(base.unionByName(here).groupBy("word").agg(F.sum("base").alias("base")), batch_id)
            finally:
                rows.unpersist()

        return start_batches(lines, step, checkpoint, available_now=available_now)
