"""Watermarks and late rows over a recorded arrival order.

A stream's late rows depend on when its watermark happens to advance. Over a
table with an arrival order the rule can be exact: the watermark a row meets is
built from the rows before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import MILLI_US, duration_us, to_us
from millrace.plans.ordered import max_so_far
from millrace.plans.panes import Panes

WATERMARK = "watermark_us"


def bounded_watermark(
    df: DataFrame, arrival: Sequence[str], ts: str, delay: str, unit: str = "s", rows_per_group: int | None = None
) -> DataFrame:
    """Adds ``watermark_us``: the greatest time seen before the row, less ``delay``."""
    seen = to_us(df, ts, unit) - F.lit(duration_us(delay))
    return max_so_far(df, [], arrival, seen, WATERMARK, rows_per_group)


def ascending_watermark(
    df: DataFrame, arrival: Sequence[str], ts: str, unit: str = "s", rows_per_group: int | None = None
) -> DataFrame:
    """The watermark of a source taken to be in order: one millisecond behind the greatest time."""
    seen = to_us(df, ts, unit) - F.lit(MILLI_US)
    return max_so_far(df, [], arrival, seen, WATERMARK, rows_per_group)


def punctuated_watermark(
    df: DataFrame, arrival: Sequence[str], ts: str, control: Column, unit: str = "s",
    rows_per_group: int | None = None,
) -> DataFrame:
    """The watermark moved by rows that meet ``control`` only, to their own time."""
    seen = F.when(control, to_us(df, ts, unit))
    return max_so_far(df, [], arrival, seen, WATERMARK, rows_per_group)


def late_rows(df: DataFrame, ts: str, size: str, slide: str, unit: str = "s") -> DataFrame:
    """Rows of a watermarked table that came too late for all of their windows."""
    panes = Panes(duration_us(size), duration_us(slide))
    pane = panes.pane(to_us(df, ts, unit))
    first_open = panes.first_open_start(F.col(WATERMARK))
    return df.filter(first_open > panes.last_start(pane))
