"""Kafka topics as lines of text.

The connector itself comes with the cluster (``spark-sql-kafka``); here are its
options and the decoding of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The row type the connector delivers.
RECORD_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset LONG, timestamp TIMESTAMP, timestampType INT"
)


def consumer_options(
    servers: str, topic: str, group_id: str | None = None, offset_reset: str = "latest",
    max_offsets_per_batch: int | None = None,
) -> dict[str, str]:
    """Reader options; offsets of a running query live in its checkpoint, not in the group."""
    if offset_reset not in ("latest", "earliest"):
        raise ValueError(f"unknown offset policy {offset_reset!r}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offset_reset}
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if max_offsets_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_batch)
    return options


def stream_kafka_lines(spark: SparkSession, **options) -> DataFrame:
    """A topic as ``value STRING``; arguments as for :func:`consumer_options`."""
    records = spark.readStream.format("kafka").options(**consumer_options(**options)).load()
    return decode_values(records)


def decode_values(records: DataFrame) -> DataFrame:
    """The values of Kafka records as text."""
    return records.select(F.col("value").cast("string").alias("value"))
