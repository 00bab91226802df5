"""What a stream keeps from micro-batch to micro-batch, as tables in the shared storage.

Every micro-batch reads the tables of the batch before and writes its own, in a folder named
by its id. A batch that is repeated after a failure reads the same and overwrites what it
had written, so results do not depend on failures. A batch runs only when the one before is
done for good, so older folders can go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import folders, remove_folder
from millrace.sinks.files import batch_folder

_PREFIX = "batch="


class BatchTable:
    """One such table. ``schema`` is that of all its rows."""

    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path, schema

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows kept by the batch before; none before the first."""
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return self.of(spark, batch_id - 1)

    def of(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(batch_folder(self.path, batch_id))

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Keeps ``rows`` for the next batch and drops what no batch can ask for any more."""
        spark = rows.sparkSession
        rows.select(*self.schema.names).write.mode("overwrite").parquet(batch_folder(self.path, batch_id))
        for old in self.batches(spark):
            if old < batch_id - 1:
                remove_folder(spark, batch_folder(self.path, old))

    def batches(self, spark: SparkSession) -> list[int]:
        """The ids of the batches whose rows are still there."""
        return sorted(int(name.removeprefix(_PREFIX)) for name in folders(spark, self.path) if name.startswith(_PREFIX))

    def last(self, spark: SparkSession) -> int | None:
        """The last batch that kept rows; None if there was none."""
        return max(self.batches(spark), default=None)


class BatchMark:
    """One number kept from batch to batch, such as the watermark reached."""

    def __init__(self, path: str):
        self._table = BatchTable(path, T.StructType([T.StructField("reached", T.LongType())]))
        # What this process wrote itself need not be read again.
        self._known: dict[int, int | None] = {}

    def before(self, spark: SparkSession, batch_id: int) -> int | None:
        return None if batch_id == 0 else self.of(spark, batch_id - 1)

    def of(self, spark: SparkSession, batch_id: int) -> int | None:
        if batch_id not in self._known:
            self._known = {batch_id: self._table.of(spark, batch_id).first()["reached"]}
        return self._known[batch_id]

    def put(self, spark: SparkSession, value: int | None, batch_id: int) -> None:
        self._table.put(spark.range(0, 1, 1, 1).select(F.lit(value).cast("long").alias("reached")), batch_id)
        self._known[batch_id] = value

    def last(self, spark: SparkSession) -> int | None:
        """The number of the last batch."""
        batch_id = self._table.last(spark)
        return None if batch_id is None else self.of(spark, batch_id)
