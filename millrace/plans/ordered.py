"""Ordered scans per key that stay balanced when one key holds most rows.

``Window.partitionBy(key)`` puts all rows of a key in one task. A table of more
rows than a task should sort is cut by ranges of (keys, order) instead, so a
frequent key and a burst in time are cut as well. Every scan then has three steps:

1. a window inside each (key, chunk);
2. one summary row per (key, chunk), and what precedes each chunk computed
   from these few rows;
3. both merged.

Borders only decide where the work is cut, never the result. A chunk is a range
partition; its number is fixed by one reliable copy, as borders found a second time
need not be the same. The number of chunks has no cap, nothing is collected, and any
type that Spark can sort will do. Tables that fit one task take the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.session import reliable_checkpoint

KEY = "__key"
CHUNK = "__chunk"
_CARRY = "__carry"
_SUMMARY = "__summary"

ROWS_PER_GROUP = 2_000_000


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_group: int | None) -> DataFrame | None:
    """``df`` with KEY (the keys as one struct) and CHUNK, or None if its rows fit one chunk.

    CHUNK never falls along ``order`` within a key and has about ``rows_per_group``
    rows per value. Rows alike in all keys and order columns share a chunk.
    """
    rows, limit = df.count(), rows_per_group or ROWS_PER_GROUP
    if rows <= limit:
        return None
    # A field that is never NULL makes a struct of no keys, too.
    whole = F.struct(F.lit(0).alias("all"), *[F.col(k) for k in keys]).alias(KEY)
    ranged = df.repartitionByRange(-(-rows // limit), *keys, *_ordering(order, backward=False))
    return reliable_checkpoint(ranged.select("*", whole, F.spark_partition_id().alias(CHUNK)))


def _ordering(order: Sequence[str], backward: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if backward else F.col(c).asc_nulls_first() for c in order]


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    local: Callable[[WindowSpec], Column],
    summary: Column,
    carry: Callable[[Column, WindowSpec], Column],
    merge: Callable[[Column, Column], Column],
    backward: bool = False,
    rows_per_group: int | None = None,
) -> DataFrame:
    """Adds column ``name``, a scan over each key's rows in ``order``.

    ``local`` computes it within a window, ``summary`` condenses one chunk,
    ``carry`` combines the summaries of the chunks gone before, and ``merge``
    joins local value and carry. ``backward`` walks from last to first row.
    """
    cut = chunked(df, keys, order, rows_per_group)
    if cut is None:
        window = Window.partitionBy(*(list(keys) or [F.lit(0)])).orderBy(*_ordering(order, backward))
        return df.withColumn(name, local(window))
    along = Window.partitionBy(KEY).orderBy(*_ordering([CHUNK], backward))
    summaries = cut.groupBy(KEY, CHUNK).agg(summary.alias(_SUMMARY))
    # Only a key that crosses a border has something to carry: at most one row per border.
    carried = summaries.select(KEY, CHUNK, carry(F.col(_SUMMARY), along).alias(_CARRY)).filter(F.col(_CARRY).isNotNull())
    inside = Window.partitionBy(KEY, CHUNK).orderBy(*_ordering(order, backward))
    scanned = cut.withColumn(name, local(inside)).join(carried, [KEY, CHUNK], "left")
    return scanned.withColumn(name, merge(F.col(name), F.col(_CARRY))).drop(KEY, CHUNK, _CARRY)


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], name: str,
    rows_per_group: int | None = None,
) -> DataFrame:
    """Adds ``name``: the ``columns`` of the row before, as a struct; NULL on the first row."""
    row = F.struct(*columns)
    return ordered_scan(
        df, keys, order, name,
        local=lambda w: F.lag(row).over(w),
        summary=F.max_by(row, F.struct(*order)),
        carry=lambda s, w: F.lag(s).over(w),
        merge=lambda here, before: F.coalesce(here, before),
        rows_per_group=rows_per_group,
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows_per_group: int | None = None
) -> DataFrame:
    """Adds ``name``: 1, 2, 3, ... within each key."""
    return ordered_scan(
        df, keys, order, name,
        local=lambda w: F.row_number().over(w).cast("long"),
        summary=F.count(F.lit(1)),
        carry=lambda s, w: F.sum(s).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        merge=lambda here, before: here + F.coalesce(before, F.lit(0)),
        rows_per_group=rows_per_group,
    )


def max_so_far(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str,
    rows_per_group: int | None = None,
) -> DataFrame:
    """Adds ``name``: the greatest ``value`` of the rows before; NULL where there is none."""
    return ordered_scan(
        df, keys, order, name,
        local=lambda w: F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        summary=F.max(value),
        carry=lambda s, w: F.max(s).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        merge=lambda here, before: F.greatest(here, before),
        rows_per_group=rows_per_group,
    )


def next_match(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], condition: Column, columns: Sequence[str],
    name: str, rows_per_group: int | None = None,
) -> DataFrame:
    """Adds ``name``: the ``columns`` of the nearest later row that meets ``condition``.

    Walks backward: a frame that grows from the far end costs one step per row,
    while one reaching from each row to the end would be recomputed for every row.
    """
    row = F.struct(*columns)
    return ordered_scan(
        df, keys, order, name,
        local=lambda w: F.last(F.when(condition, row), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)
        ),
        summary=F.min_by(row, F.when(condition, F.struct(*order))),
        carry=lambda s, w: F.last(s, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        merge=lambda here, after: F.coalesce(here, after),
        backward=True,
        rows_per_group=rows_per_group,
    )
