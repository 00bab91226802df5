"""Typed rows from delimited text lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import java_split, java_trim

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Field:
    """One field of a line: ``kind`` is a Spark type name or a date pattern."""

    name: str
    kind: str = "string"
    trim: bool = True
    pattern: str | None = None

    def value(self, raw: Column) -> Column:
        text = java_trim(raw) if self.trim else raw
        if self.pattern is not None:
            return F.try_to_timestamp(text, F.lit(self.pattern))
        if self.kind == "string":
            return text
        return text.try_cast(self.kind)


# The four line formats. Seconds are LONG, so times beyond 2038 parse as well.
BEHAVIOR = (
    Field("user_id", "long"),
    Field("item_id", "long"),
    Field("category_id", "int"),
    Field("behavior"),
    Field("event_time", "long"),
)
SENSOR = (
    Field("id"),
    Field("event_time", "long"),
    Field("temperature", "double"),
)
SENSOR_RAW_ID = (Field("id", trim=False),) + SENSOR[1:]
VISIT = (
    Field("ts", "timestamp", pattern="yyyy-MM-dd HH:mm:ss"),
    Field("mid", trim=False),
    Field("uid", trim=False),
    Field("url", trim=False),
)


def parse_lines(
    df: DataFrame,
    fields: tuple[Field, ...],
    column: str = "value",
    mode: str = "strict",
    separator: str = ",",
) -> DataFrame:
    """Replaces ``column`` by the parsed ``fields``; other columns stay.

    A line is good when it has exactly ``len(fields)`` fields and each of them
    reads as its type. ``strict`` fails the job on the first bad line;
    ``permissive`` keeps it with NULL fields and its text in ``_corrupt``.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode {mode!r}")
    parts, row = "__parts", "__row"
    others = [c for c in df.columns if c != column]
    values = [f.value(F.get(F.col(parts), F.lit(i))) for i, f in enumerate(fields)]
    good = (F.size(parts) == len(fields))
    for value in values:
        good = good & value.isNotNull()
    parsed = F.struct(*[v.alias(f.name) for v, f in zip(values, fields)])
    split = df.withColumn(parts, java_split(F.col(column), separator))
    if mode == "strict":
        bad = F.raise_error(F.concat(F.lit("cannot parse line: "), F.coalesce(column, F.lit("NULL"))))
        rows = split.withColumn(row, F.when(good, parsed).otherwise(bad))
        corrupt = []
    else:
        rows = split.withColumn(row, F.when(good, parsed))
        corrupt = [F.when(F.col(row).isNull(), F.coalesce(column, F.lit(""))).alias(CORRUPT)]
    return rows.select(*others, *[F.col(row)[f.name].alias(f.name) for f in fields], *corrupt)


def parse_behavior(df: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """user, item, category, behaviour, epoch seconds."""
    return parse_lines(df, BEHAVIOR, column, mode)


def parse_sensor(
    df: DataFrame, column: str = "value", mode: str = "strict", trim_id: bool = True
) -> DataFrame:
    """sensor id, epoch seconds, temperature."""
    return parse_lines(df, SENSOR if trim_id else SENSOR_RAW_ID, column, mode)


def parse_visit(df: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """visit time (session time zone), machine, user, URL; only the time is trimmed."""
    return parse_lines(df, VISIT, column, mode)


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and corrupt rows of a permissive parse."""
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), parsed.filter(F.col(CORRUPT).isNotNull())
