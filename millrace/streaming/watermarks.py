"""Event time, watermarks and the end of a finite stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import duration_us, interval_text, to_us
from millrace.session import scratch_path

# Later than any event, yet far from overflow when a window size is added.
END_OF_TIME = dt.datetime(2900, 1, 1)


def with_event_time(df: DataFrame, ts: str, name: str = "event_ts", unit: str = "s") -> DataFrame:
    """Adds ``name TIMESTAMP``, the type watermarks need; zone-free times count as UTC."""
    return df.withColumn(name, F.timestamp_micros(to_us(df, ts, unit)))


def ascending(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """A source in order: nothing may come later than the greatest time seen."""
    return df.withWatermark(ts, interval_text(0))


def bounded(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows may lag behind the greatest time seen by up to ``delay``."""
    return df.withWatermark(ts, interval_text(duration_us(delay)))


def with_end_marker(stream: DataFrame, ts: str) -> tuple[DataFrame, Callable[[], None]]:
    """``stream`` joined by an empty source, and a function that puts a far-future row there.

    A finite stream keeps its last windows and timers open. Run the query until it has
    read all files, in as many micro-batches as it takes, call the function, and run it
    again on the same checkpoint: the row then closes all windows. Sooner it would make
    all rows after it late. The marker has NULLs in all columns but ``ts``. It has to
    reach the watermark: count by condition instead of filtering in between.
    """
    spark = stream.sparkSession
    folder = scratch_path(spark, "end-marker")
    zone_free = F.lit(END_OF_TIME).cast("timestamp_ntz").cast(stream.schema[ts].dataType)
    row = spark.range(1).select(
        *[(zone_free if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name) for f in stream.schema]
    )
    row.limit(0).write.parquet(folder)
    marker = spark.readStream.schema(stream.schema).parquet(folder)

    def close() -> None:
        row.coalesce(1).write.mode("append").parquet(folder)

    return stream.unionByName(marker), close
