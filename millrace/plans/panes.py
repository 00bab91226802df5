"""Sliding windows from panes.

With 60 minutes sliding by 5 seconds a row lies in 720 windows. Rows are first
aggregated into panes of ``gcd(size, slide)`` (map-side combined, so a hot key
costs one row per pane and task), and windows are made from panes only.

All windows are aligned to 1970, closed at the start and open at the end, and
only windows with rows come out.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.times import MILLI_US, floor_to

PANE = "__pane"
FIRST_START = "__first_start"
WINDOW_START = "__window_start"
RUN_FROM, RUN_TO = "__run_from", "__run_to"
_BLOCK = "__block"


class Panes:
    """The geometry of one ``size`` / ``slide`` pair, in microseconds."""

    def __init__(self, size: int, slide: int):
        if size <= 0 or slide <= 0:
            raise ValueError("size and slide must be positive")
        self.size, self.slide = size, slide
        self.width = gcd(size, slide)
        # A block of window starts is the unit of work after the panes: with four
        # sizes' worth a pane is copied about 1.25 times and no task gets more
        # than one key's panes of one block.
        self.block = -(-4 * size // slide) * slide

    def pane(self, us: Column) -> Column:
        return floor_to(us, self.width)

    def first_start(self, pane: Column) -> Column:
        """The earliest start of a window that contains ``pane``."""
        earliest = pane + F.lit(self.width - self.size)
        return earliest + F.pmod(-earliest, F.lit(self.slide))

    def last_start(self, pane: Column) -> Column:
        return floor_to(pane, self.slide)

    def first_open_start(self, watermark: Column) -> Column:
        """The earliest start of a window that ``watermark`` has not closed.

        A window is closed once its last millisecond is not after the watermark.
        """
        return floor_to(watermark + F.lit(MILLI_US - self.size), self.slide) + F.lit(self.slide)

    def first_open(self, watermark: int) -> int:
        """The same of a number."""
        start = watermark + MILLI_US - self.size
        return start - start % self.slide + self.slide

    def tag(self, df: DataFrame, us: Column, watermark: Column | None = None) -> DataFrame:
        """Adds pane and first open window start; rows that are in no open window go."""
        tagged = df.withColumn(PANE, self.pane(us)).filter(F.col(PANE).isNotNull())
        first = self.first_start(F.col(PANE))
        if watermark is not None:
            first = F.greatest(first, self.first_open_start(watermark))
        tagged = tagged.withColumn(FIRST_START, first)
        if watermark is None and self.size >= self.slide:
            return tagged
        return tagged.filter(F.col(FIRST_START) <= self.last_start(F.col(PANE)))

    def _last(self, until: int | None) -> Column:
        """The last window start of a pane, below ``until``."""
        last = self.last_start(F.col(PANE))
        return last if until is None else F.least(last, F.lit(until - self.slide))

    def spread(self, panes: DataFrame, keys: list[str], until: int | None = None) -> DataFrame:
        """Each pane once per block it reaches, blocks of one key apart from each other."""
        first, last = F.col(FIRST_START), self._last(until)
        if until is not None:
            panes = panes.filter(first <= last)
        blocks = F.sequence(floor_to(first, self.block), floor_to(last, self.block), F.lit(self.block))
        return panes.withColumn(_BLOCK, F.explode(blocks)).repartition(*keys, _BLOCK)

    def merged(
        self, panes: DataFrame, keys: list[str], merges: dict[str, Column], until: int | None = None
    ) -> DataFrame:
        """Any mergeable aggregate: every pane goes to each of its windows.

        The panes are already placed by (key, block), so the many window rows
        are aggregated where they arise and are never shuffled. ``until`` leaves out
        windows that start there or later.
        """
        lo = F.greatest(FIRST_START, _BLOCK)
        hi = F.least(self._last(until), F.col(_BLOCK) + F.lit(self.block - self.slide))
        starts = self.spread(panes, keys, until).withColumn(
            WINDOW_START, F.explode(F.sequence(lo, hi, F.lit(self.slide)))
        )
        return starts.groupBy(*keys, _BLOCK, WINDOW_START).agg(
            *[m.alias(name) for name, m in merges.items()]
        ).drop(_BLOCK)

    def totals(self, panes: DataFrame, keys: list[str], columns: list[str], until: int | None = None) -> DataFrame:
        """Sums and counts: a pane adds at its first window and subtracts after its last.

        The running total changes at these steps only. One row comes out per run
        of equal windows, with the starts of its first and last window, so the
        work is that of the result, not of panes times windows. The first of
        ``columns`` must be a row count. Steps at one start share their total, as they
        are peers in the order, and the last of them gives the run.
        """
        end = F.col(_BLOCK) + F.lit(self.block)
        lo = F.greatest(FIRST_START, _BLOCK)
        hi = F.least(self._last(until) + F.lit(self.slide), end)
        at, steps = "__at", "__steps"
        step = F.array(
            F.struct(lo.alias(at), *[F.col(c).alias(c) for c in columns]),
            F.struct(hi.alias(at), *[(-F.col(c)).alias(c) for c in columns]),
        )
        # Wide enough for sums of sums.
        wide = panes.agg(*[F.sum(c).alias(c) for c in columns]).schema
        changes = self.spread(panes, keys, until).select(*keys, _BLOCK, F.explode(step).alias(steps)).select(
            *keys, _BLOCK, F.col(f"{steps}.{at}").alias(at), *[F.col(f"{steps}.{c}").cast(wide[c].dataType).alias(c) for c in columns]
        )
        walk = Window.partitionBy(*keys, _BLOCK).orderBy(at)
        return changes.select(
            *keys, F.col(at).alias(RUN_FROM), (F.lead(at).over(walk) - F.lit(self.slide)).alias(RUN_TO),
            *[F.sum(c).over(walk).alias(c) for c in columns],
        ).filter((F.col(columns[0]) > 0) & (F.col(RUN_TO) >= F.col(RUN_FROM)))
