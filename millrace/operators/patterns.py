"""Two-stage event patterns with a time limit.

``next`` is strict: the second stage must be the very next row. ``followed_by``
is relaxed: rows in between are skipped. A match needs
``second - first < within``; every first-stage row starts a match of its own.
Rows are taken in event-time order, ties in arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import duration_us, from_us, to_us
from millrace.plans.ordered import next_match, previous_row

MATCHED, TIMEOUT = "matched", "timeout"

# The texts of warnings and order results.
FAIL_STREAK_MESSAGE = "login fail in 2 seconds"
FAIL_PATTERN_MESSAGE = "fail login Warining "
PAID_MESSAGE = "order pay successfully"
TIMEOUT_PREFIX = "超时："

_US = "__us"
_OTHER = "__other"


@dataclass(frozen=True)
class Pattern:
    """``Pattern.begin("a", p).next("b", q).within("2 seconds")``."""

    first: str
    first_where: Column
    second: str | None = None
    second_where: Column | None = None
    strict: bool = True
    limit: int | None = None

    @staticmethod
    def begin(name: str, where: Column) -> Pattern:
        return Pattern(name, where)

    def next(self, name: str, where: Column) -> Pattern:
        return replace(self, second=name, second_where=where, strict=True)

    def followed_by(self, name: str, where: Column) -> Pattern:
        return replace(self, second=name, second_where=where, strict=False)

    def within(self, duration: str) -> Pattern:
        return replace(self, limit=duration_us(duration))


def match(
    df: DataFrame, pattern: Pattern, keys: Sequence[str], ts: str, seq: str,
    columns: Sequence[str] | None = None, unit: str = "s", rows_per_group: int | None = None,
) -> DataFrame:
    """Completed matches: ``keys`` and one struct per stage, named as in the pattern.

    Without ``keys`` all rows form one sequence, so a match may span users.
    """
    if pattern.strict:
        return _strict(df, pattern, keys, ts, seq, columns, unit, rows_per_group)
    found = match_or_timeout(df, pattern, keys, ts, seq, columns, unit, rows_per_group)
    return found.filter(F.col("status") == MATCHED).select(*keys, pattern.first, pattern.second)


def _strict(df, pattern, keys, ts, seq, columns, unit, rows_per_group) -> DataFrame:
    columns = list(columns or df.columns)
    timed = df.withColumn(_US, to_us(df, ts, unit))
    # The stage test is carried as a flag, so the condition may use any column.
    flagged = timed.withColumn("__first", F.coalesce(pattern.first_where, F.lit(False)))
    paired = previous_row(
        flagged, keys, [_US, seq], _unique([*columns, _US, "__first"]), _OTHER, rows_per_group
    )
    hit = F.col(f"{_OTHER}.__first") & pattern.second_where
    if pattern.limit is not None:
        hit = hit & (F.col(_US) - F.col(f"{_OTHER}.{_US}") < F.lit(pattern.limit))
    return paired.filter(hit).select(
        *keys,
        F.struct(*[F.col(f"{_OTHER}.{c}").alias(c) for c in columns]).alias(pattern.first),
        F.struct(*columns).alias(pattern.second),
    )


def match_or_timeout(
    df: DataFrame, pattern: Pattern, keys: Sequence[str], ts: str, seq: str,
    columns: Sequence[str] | None = None, unit: str = "s", rows_per_group: int | None = None,
) -> DataFrame:
    """One row per first-stage row of a relaxed pattern, finished or not.

    ``status`` is ``matched`` or ``timeout``; the second stage is NULL on a
    timeout and ``deadline`` is the first instant at which a match is too late.
    """
    if pattern.strict or pattern.limit is None:
        raise ValueError("timeouts need followed_by and within")
    columns = list(columns or df.columns)
    kind = df.schema[ts].dataType
    # Rows of neither stage cannot change the outcome and stay out of the shuffle.
    relevant = df.filter(pattern.first_where | pattern.second_where).withColumn(_US, to_us(df, ts, unit))
    paired = next_match(
        relevant, keys, [_US, seq], pattern.second_where, _unique([*columns, _US]), _OTHER, rows_per_group
    )
    in_time = F.coalesce(F.col(f"{_OTHER}.{_US}") - F.col(_US) < F.lit(pattern.limit), F.lit(False))
    second = F.struct(*[F.col(f"{_OTHER}.{c}").alias(c) for c in columns])
    return paired.filter(pattern.first_where).select(
        *keys,
        F.struct(*columns).alias(pattern.first),
        F.when(in_time, second).alias(pattern.second),
        F.when(in_time, MATCHED).otherwise(TIMEOUT).alias("status"),
        from_us(F.col(_US) + F.lit(pattern.limit), kind, unit).alias("deadline"),
    )


def _unique(names: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(names))


def fail_streaks(
    df: DataFrame, ts: str = "event_time", seq: str = "seq", user: str = "user_id", event: str = "event_type",
    fail: str = "fail", within: str = "2 seconds", message: str = FAIL_STREAK_MESSAGE,
    keys: Sequence[str] | None = None, unit: str = "s", rows_per_group: int | None = None,
) -> DataFrame:
    """Two failures in a row, less than ``within`` apart, per user.

    ``user_id, first_time, last_fail_time, warning_msg``. Warnings chain: the
    second failure of one may be the first of the next. ``keys=[]`` reads all
    users as one sequence; the warning then names the first row's user.
    """
    keys = [user] if keys is None else list(keys)
    pattern = fail_pattern(event, fail, within)
    pairs = match(df, pattern, keys, ts, seq, _unique([user, ts]), unit, rows_per_group)
    return fail_warnings(pairs, user, ts, message)


def fail_pattern(event: str, fail: str, within: str) -> Pattern:
    failed = F.col(event) == fail
    return Pattern.begin("begin", failed).next("next", failed).within(within)


def fail_warnings(pairs: DataFrame, user: str, ts: str, message: str) -> DataFrame:
    """Matches of :func:`fail_pattern` as warnings."""
    return pairs.select(
        F.col(f"begin.{user}").alias("user_id"),
        F.col(f"begin.{ts}").alias("first_time"),
        F.col(f"next.{ts}").alias("last_fail_time"),
        F.lit(message).alias("warning_msg"),
    )


def order_results(
    df: DataFrame, ts: str = "event_time", seq: str = "seq", order_id: str = "order_id", event: str = "event_type",
    create: str = "create", pay: str = "pay", within: str = "15 minutes", unit: str = "s",
    rows_per_group: int | None = None,
) -> DataFrame:
    """Every created order as paid in time or timed out.

    ``order_id, status, result_msg, create_ts, pay_ts, deadline``; filter on
    ``status`` for the main output and the timeout output.
    """
    pattern = order_pattern(event, create, pay, within)
    return order_texts(match_or_timeout(df, pattern, [order_id], ts, seq, [ts], unit, rows_per_group), order_id, ts)


def order_pattern(event: str, create: str, pay: str, within: str) -> Pattern:
    return Pattern.begin("begin", F.col(event) == create).followed_by("follow", F.col(event) == pay).within(within)


def order_texts(found: DataFrame, order_id: str, ts: str) -> DataFrame:
    """Outcomes of :func:`order_pattern` with their texts."""
    late_text = F.concat(F.lit(TIMEOUT_PREFIX), F.col("deadline").cast("string"))
    return found.select(
        F.col(order_id).alias("order_id"),
        "status",
        F.when(F.col("status") == MATCHED, PAID_MESSAGE).otherwise(late_text).alias("result_msg"),
        F.col(f"begin.{ts}").alias("create_ts"),
        F.col(f"follow.{ts}").alias("pay_ts"),
        "deadline",
    )
