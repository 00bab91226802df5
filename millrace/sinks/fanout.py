"""One micro-batch, several outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.routing import TAG, side_output
from millrace.sinks.files import batch_folder

BatchWriter = Callable[[DataFrame, int], None]


def tagged_batches(path: str) -> BatchWriter:
    """A batch writer of Parquet files, one folder per batch and tag, in a single pass for any number of tags."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").partitionBy(TAG).parquet(batch_folder(path, batch_id))

    return write


def read_tag(spark: SparkSession, path: str, tag: str, schema: T.StructType) -> DataFrame:
    """All rows of one tag written by :func:`tagged_batches`; only that tag's folders are read."""
    whole = T.StructType([*schema.fields, T.StructField(TAG, T.StringType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).parquet(path).filter(F.col(TAG) == tag).select(*schema.names)


def fan_out(writers: dict[str, BatchWriter]) -> BatchWriter:
    """Sends the rows of each tag of a routed stream to its own writer: for outputs of different kinds.

    Every writer reads the batch; where all write tables, :func:`tagged_batches` does in one pass.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            for tag, writer in writers.items():
                writer(side_output(rows, tag), batch_id)
        finally:
            rows.unpersist()

    return write
