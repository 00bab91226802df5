"""Line and row sources. Every line source gives one column, ``value STRING``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the text files at ``path``."""
    return spark.read.text(path)


def stream_text_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of the text files that appear in ``folder``."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """The lines an existing server sends. Spark keeps no offsets here: for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def collection(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small inline table with ``seq``, the arrival order from 0.

    ``schema`` is a DDL string. Meant for fixtures; tables belong in files.
    """
    fields = T._parse_datatype_string(schema)
    numbered = T.StructType([*fields.fields, T.StructField("seq", T.LongType(), False)])
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], numbered)


def integers(spark: SparkSession, first: int, last: int) -> DataFrame:
    """``x`` from ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("x"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` in ``folder``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same table as a stream of files, with the schema of its batch form.

    The table may be one file or a folder of part files; a pattern finds both.
    """
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parque[t]")
