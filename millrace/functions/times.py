"""Durations and event-time columns as whole microseconds.

Arithmetic on times runs on BIGINT microseconds, so windows, limits and
deadlines are exact and do not depend on the session time zone for
``TIMESTAMP_NTZ`` columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND_US = 1_000_000
MILLI_US = 1_000

_UNIT_US = {
    "millisecond": MILLI_US,
    "second": SECOND_US,
    "minute": 60 * SECOND_US,
    "hour": 3_600 * SECOND_US,
    "day": 86_400 * SECOND_US,
}
_NUMBER_US = {"s": SECOND_US, "ms": MILLI_US, "us": 1}
_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def duration_us(duration: str | int | float | dt.timedelta) -> int:
    """``'15 minutes'``, a timedelta, or a number of seconds, in microseconds."""
    if isinstance(duration, dt.timedelta):
        return duration // dt.timedelta(microseconds=1)
    if isinstance(duration, (int, float)):
        return round(duration * SECOND_US)
    amount, unit = duration.split()
    return round(float(amount) * _UNIT_US[unit.rstrip("s")])


def interval_text(us: int) -> str:
    """Microseconds as the text ``withWatermark`` takes."""
    return f"{us} microseconds"


def to_us(df: DataFrame, column: str, unit: str = "s") -> Column:
    """``column`` of ``df`` as microseconds since 1970; numbers count in ``unit``."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        # Differences of zone-free times are exact in every session time zone,
        # which conversions by way of TIMESTAMP are not.
        since = F.col(column) - F.expr(_NTZ_EPOCH)
        parts = {"DAY": 86_400 * SECOND_US, "HOUR": 3_600 * SECOND_US, "MINUTE": 60 * SECOND_US}
        whole = sum((F.extract(F.lit(p), since).cast("long") * F.lit(us) for p, us in parts.items()), F.lit(0))
        return whole + (F.extract(F.lit("SECOND"), since) * F.lit(SECOND_US)).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long") * F.lit(_NUMBER_US[unit])
    raise TypeError(f"{column}: {kind.simpleString()} is not a time")


def from_us(us: Column, kind: T.DataType, unit: str = "s") -> Column:
    """The inverse of :func:`to_us` for a column of type ``kind``."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(us)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", us, F.expr(_NTZ_EPOCH))
    width = _NUMBER_US[unit]
    return us if width == 1 else F.call_function("div", floor_to(us, width), F.lit(width))


def series(first: Column, last: Column, step: int, kind: T.DataType, unit: str = "s") -> Column:
    """Times from ``first`` to ``last`` (microseconds) by ``step``, as an array of ``kind``.

    Timestamps are converted at both ends only, not one by one.
    """
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        by = F.lit(dt.timedelta(microseconds=step))
        return F.sequence(from_us(first, kind), from_us(last, kind), by)
    times = F.sequence(first, last, F.lit(step))
    return times if unit == "us" else F.transform(times, lambda us: from_us(us, kind, unit))


def floor_to(us: Column, step: int) -> Column:
    """The greatest multiple of ``step`` that is not above ``us``."""
    return us - F.pmod(us, F.lit(step))


def event_time(seconds: Column | str) -> Column:
    """Epoch seconds as a ``TIMESTAMP``."""
    return F.timestamp_seconds(seconds)


def event_time_ms(millis: Column | str) -> Column:
    """Epoch milliseconds as a ``TIMESTAMP``."""
    return F.timestamp_millis(millis)
