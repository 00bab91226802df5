"""Rows as text: record strings, JSON documents, ranking reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import java_trim
from millrace.functions.times import from_us, to_us

# Texts that consumers of the reports and records match on.
RULE = "==================================\n"
TIME_LABEL = "时间： "
ITEM_LABEL = " 商品ID= "
VIEWS_LABEL = " 浏览量= "
DESCRIBE_PREFIX = "转换成字符串： "
SENSOR_NAME = "Sensor("
VISIT_NAME = "WindowKeyTime("
PLACE_LABEL = "No."


def sensor_text(id: Column, event_time: Column, temperature: Column) -> Column:
    """``Sensor(id,time,temperature)``."""
    return F.concat(
        F.lit(SENSOR_NAME), id, F.lit(","), event_time.cast("string"),
        F.lit(","), temperature.cast("string"), F.lit(")"),
    )


def describe_sensor(id: Column, event_time: Column, temperature: Column) -> Column:
    """The sensor text behind a fixed prefix."""
    return F.concat(F.lit(DESCRIBE_PREFIX), sensor_text(id, event_time, temperature))


def pair_text(word: Column, n: Column) -> Column:
    """``(word,n)``."""
    return F.concat(F.lit("("), word, F.lit(","), n.cast("string"), F.lit(")"))


def document(fields: dict[str, Column]) -> Column:
    """A JSON object whose values are all strings."""
    return F.to_json(F.struct(*[v.cast("string").alias(k) for k, v in fields.items()]))


def sensor_document(id: Column, event_time: Column, temperature: Column) -> Column:
    """The document form of a sensor reading."""
    # The field names of the index.
    return document({"id": id, "timeStamp": event_time, "temprature": temperature})


def clock_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f``: milliseconds without trailing zeros, one digit at least."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), "0{1,2}$", "")


def _ranked_lines(top: DataFrame, window_end: str, rank: str, line: Column) -> DataFrame:
    """One row per window with its lines in rank order; a top-n has few per window."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("rank"), line.alias("line"))))
    return top.groupBy(window_end).agg(F.array_join(F.transform(entries, lambda e: e["line"]), "").alias("__body"))


def item_report(
    top: DataFrame, window_end: str = "window_end", key: str = "item_id",
    cnt: str = "cnt", rank: str = "rank",
) -> DataFrame:
    """The ranking of each window as a text block with the window end on top."""
    if not isinstance(top.schema[window_end].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{window_end} must be a timestamp")
    line = F.concat(
        F.lit(PLACE_LABEL), F.col(rank).cast("string"), F.lit(": "), F.lit(ITEM_LABEL), F.col(key).cast("string"),
        F.lit(VIEWS_LABEL), F.col(cnt).cast("string"), F.lit("\n"),
    )
    text = F.concat(
        F.lit(RULE), F.lit(TIME_LABEL), clock_text(F.col(window_end)), F.lit("\n"), F.col("__body"), F.lit(RULE)
    )
    return _ranked_lines(top, window_end, rank, line).select(window_end, text.alias("report"))


def visit_report(
    top: DataFrame, window_end: str = "window_end", key: str = "mid",
    cnt: str = "cnt", rank: str = "rank", unit: str = "ms",
) -> DataFrame:
    """The ranking of each window as a text block of records."""
    millis = from_us(to_us(top, window_end, unit), T.LongType(), "ms").cast("string")
    line = F.concat(
        F.lit(PLACE_LABEL), F.col(rank).cast("string"), F.lit(VISIT_NAME), millis, F.lit(","),
        java_trim(F.col(key).cast("string")), F.lit(","), F.col(cnt).cast("string"), F.lit(")\n"),
    )
    text = F.concat(F.lit(RULE), F.col("__body"), F.lit(RULE))
    return _ranked_lines(top, window_end, rank, line).select(window_end, text.alias("report"))
