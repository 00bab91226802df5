"""Kafka sink: text values to one topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def producer_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def encode_values(df: DataFrame, text: Column) -> DataFrame:
    """Rows as the sink takes them: one ``value STRING`` column."""
    return df.select(text.cast("string").alias("value"))


def write_kafka(df: DataFrame, text: Column, servers: str, topic: str) -> None:
    encode_values(df, text).write.format("kafka").options(**producer_options(servers, topic)).save()


def start_kafka(df: DataFrame, text: Column, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    writer = encode_values(df, text).writeStream.format("kafka").options(**producer_options(servers, topic))
    return writer.option("checkpointLocation", checkpoint).start()
