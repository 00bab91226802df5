"""Sliding-window aggregates per key, in event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.times import duration_us, from_us, to_us
from millrace.plans.aggregates import WINDOW_END, Accumulator, LeastRecord, Merged, Sums, WindowAggregate
from millrace.plans.panes import FIRST_START, PANE, Panes


def sliding_windows(
    df: DataFrame, aggregate: WindowAggregate, keys: Sequence[str], ts: str, size: str, slide: str,
    watermark: str | None = None, unit: str = "s",
) -> DataFrame:
    """``keys, window_end`` and the columns of ``aggregate``, of every window with rows."""
    keys, panes = list(keys), Panes(duration_us(size), duration_us(slide))
    tagged = panes.tag(df, to_us(df, ts, unit), None if watermark is None else F.col(watermark))
    parts = aggregate.partial(tagged, [*keys, PANE, FIRST_START])
    return aggregate.windows(panes, parts, keys, df.schema[ts].dataType, unit)


def with_window_start(windows: DataFrame, size: str, unit: str = "s") -> DataFrame:
    """Adds ``window_start``, the first instant of a window of ``size``."""
    start = to_us(windows, WINDOW_END, unit) - F.lit(duration_us(size))
    return windows.withColumn("window_start", from_us(start, windows.schema[WINDOW_END].dataType, unit))


def sliding_count(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
    watermark: str | None = None, unit: str = "s", best: tuple[int, Sequence[str]] | None = None,
) -> DataFrame:
    """``keys, window_end, cnt`` of every window with rows; the end is not part of the window.

    ``watermark`` names a column of microseconds (see
    :mod:`millrace.operators.lateness`); a row then counts only in windows its
    watermark has not closed. ``best`` is for counts that only go into
    ``top_n(counts, n, tie=tie)``: with ``(n, tie)`` rows may be missing that are surely
    not among the n of their window, so far fewer are made and sorted.
    """
    return sliding_windows(df, Sums({"cnt": F.count(F.lit(1))}, best), keys, ts, size, slide, watermark, unit)


def sliding_sum(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, sums: dict[str, str],
    watermark: str | None = None, unit: str = "s",
) -> DataFrame:
    """Row count ``cnt`` and sums of whole-number columns, ``{result name: column}``."""
    for column in sums.values():
        if not isinstance(df.schema[column].dataType, (T.IntegralType, T.DecimalType)):
            raise TypeError(f"{column}: running totals need exact numbers")
    totals = {n: F.coalesce(F.sum(c), F.lit(0)) for n, c in sums.items()}
    return sliding_windows(df, Sums({"cnt": F.count(F.lit(1)), **totals}), keys, ts, size, slide, watermark, unit)


def sliding_reduce(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
    partial: dict[str, Column], merge: dict[str, Column], watermark: str | None = None, unit: str = "s",
) -> DataFrame:
    """Any aggregate with a partial and a merge form.

    ``partial`` are aggregates over rows, ``merge`` aggregates over the partial
    columns of the same names.
    """
    return sliding_windows(df, Merged(partial, merge), keys, ts, size, slide, watermark, unit)


def sliding_accumulated(
    df: DataFrame, accumulator: Accumulator, keys: Sequence[str], ts: str, size: str, slide: str,
    watermark: str | None = None, unit: str = "s",
) -> DataFrame:
    """An aggregate of one's own, declared once: ``keys, window_end`` and its result."""
    return sliding_windows(df, accumulator, keys, ts, size, slide, watermark, unit)


def sliding_min_record(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, value: str,
    tie: Sequence[str], columns: Sequence[str], watermark: str | None = None, unit: str = "s",
) -> DataFrame:
    """The record with the least ``value`` of every window.

    NULL values are no record, windows without one give no row.
    Of equal values the first by ``tie`` (arrival order) wins; ``columns`` are
    what to return of the record besides ``value``.
    """
    return sliding_windows(df, LeastRecord(value, tie, columns), keys, ts, size, slide, watermark, unit)
