"""Small helpers that several operators share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import reliable_checkpoint
from millrace.sources.lines import table

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
_BLANK = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def word_array(text: Column) -> Column:
    """The words between white space as an array; empty for NULL and for blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANK))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def word_count(text: Column) -> Column:
    """The number of words of ``word_array``, as a long, without building the array."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` with results given as dicts of columns (lists or arrays)."""
    fields = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(fields)
        for columns in function(batches):
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    return df.mapInArrow(run, fields)


def bounded_sample(df: DataFrame, text: str, named_by: list[str], size: int, seed: int) -> list[str]:
    """The texts of the ``size`` rows that come first by a hash of ``named_by`` and the text.

    Neither order nor partitions matter, and rows that repeat one another count once. Hashes
    alone are ranked, so a task sends ``size`` numbers to the driver, and only the texts chosen
    follow.
    """
    name = F.xxhash64(*[F.col(c).cast("string") for c in named_by], F.lit(seed), F.col(text)).alias("name")
    named = df.filter(F.col(text).isNotNull()).select(name, F.col(text).alias("text"))
    first = [r["name"] for r in named.select("name").distinct().orderBy("name").limit(size).collect()]
    if not first:
        return []
    found = named.filter(F.col("name").isin(first)).groupBy("name").agg(F.min("text").alias("text"))
    return [r["text"] for r in sorted(found.collect(), key=lambda r: r["name"])]


def bounded_samples(df: DataFrame, text: str, kind: Column, named_by: list[str], size: int, seed: int) -> list[str]:
    """``bounded_sample`` of the rows for which ``kind`` holds, then of the others.

    ``kind`` may be dear: it is told once per row, and a table of hashes remembers it.
    """
    name = F.xxhash64(*[F.col(c).cast("string") for c in named_by], F.lit(seed), F.col(text)).alias("name")
    given = df.filter(F.col(text).isNotNull())
    marks = reliable_checkpoint(given.select(name, kind.alias("kind")).distinct())
    chosen = {
        which: [r["name"] for r in marks.filter(F.col("kind") == which).orderBy("name").limit(size).collect()]
        for which in (True, False)
    }
    if not any(chosen.values()):
        return []
    # Only the rows chosen are looked at for their kind again, in case hashes collide.
    named = given.select(name, F.col(text), kind.alias("kind")).filter(F.col("name").isin(chosen[True] + chosen[False]))
    found = {(r["kind"], r["name"]): r["text"] for r in named.groupBy("kind", "name").agg(F.min(text).alias("text")).collect()}
    return [found[which, n] for which in (True, False) for n in chosen[which]]


def in_a_task(spark: SparkSession, function: Callable[[Any], Any], argument: Any) -> Any:
    """``function(argument)``, run by one task: for training on a bounded sample.

    The task is run again if its executor is lost, and keeps to the one core it has, where
    numpy on the driver would have many threads wait for each other's small products.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {"blob": [pickle.dumps(function(pickle.loads(v.as_py()))) for v in batch.column(0)]}

    given = spark.createDataFrame([(bytearray(pickle.dumps(argument)),)], "blob binary").coalesce(1)
    return pickle.loads(map_batches(given, run, "blob binary").first()["blob"])
