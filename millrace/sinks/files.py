"""Console, table and text sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.rendering import pair_text


def print_rows(df: DataFrame, prefix: str | None = None, output_mode: str = "append") -> StreamingQuery | None:
    """Prints a batch result or every micro-batch of a stream, each row behind ``prefix``."""
    if prefix is not None:
        df = df.select(F.lit(prefix).alias("prefix"), "*")
    if not df.isStreaming:
        df.show(truncate=False)
        return None
    return df.writeStream.format("console").outputMode(output_mode).option("truncate", "false").start()


def write_text(df: DataFrame, line: Column, path: str, mode: str = "errorifexists") -> None:
    """One text line per row, in as many files as there are partitions."""
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_pairs(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``(word,n)`` lines."""
    write_text(counts, pair_text(F.col("word"), F.col("cnt")), path, mode)


def start_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
    output_mode: str = "append", available_now: bool = True,
) -> StreamingQuery:
    """Runs ``write(rows, batch id)`` for every micro-batch."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def batch_folder(path: str, batch_id: int) -> str:
    """The folder of one micro-batch. A repeated batch overwrites its own folder only."""
    return f"{path.rstrip('/')}/batch={batch_id}"


def parquet_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer of Parquet files, one folder per batch."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows written by :func:`parquet_batches`."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def pair_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer of ``(word,n)`` lines: the update log of a running count as text.

    Spark's own file sink takes append mode only; this one takes updates.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        write_pairs(rows, batch_folder(path, batch_id), mode="overwrite")

    return write
