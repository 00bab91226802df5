"""What can be aggregated over sliding windows: in three steps that meet at the panes.

``partial`` condenses rows, ``combine`` partial results of one pane, ``windows`` puts panes
together to windows. Batch operators and streams use the same steps; a stream keeps what
``combine`` gives. Windows that start at ``until`` (microseconds) or later are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.times import from_us, series
from millrace.operators.ranking import top_n
from millrace.plans.panes import PANE, RUN_FROM, RUN_TO, WINDOW_START, Panes

WINDOW_END = "window_end"


def _end(panes: Panes, kind: T.DataType, unit: str) -> Column:
    return from_us(F.col(WINDOW_START) + F.lit(panes.size), kind, unit).alias(WINDOW_END)


@dataclass(frozen=True)
class Sums:
    """Counts and sums; the first of ``sums`` (aggregates over rows) must be a row count.

    With ``best``, (n, columns that rank equal counts), windows may leave out keys that are
    not among the n with the greatest count: a run of equal windows goes where n others of
    the same windows rank before it, ahead of the many window rows that would be sorted.
    """

    sums: dict[str, Column]
    best: tuple[int, Sequence[str]] | None = None

    def partial(self, rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(*[c.alias(n) for n, c in self.sums.items()])

    def combine(self, parts: DataFrame, by: list[str]) -> DataFrame:
        return parts.groupBy(*by).agg(*[F.sum(n).cast(parts.schema[n].dataType).alias(n) for n in self.sums])

    def windows(
        self, panes: Panes, parts: DataFrame, keys: list[str], kind: T.DataType, unit: str, until: int | None = None
    ) -> DataFrame:
        runs = panes.totals(parts, keys, list(self.sums), until)
        if self.best:
            n, tie = self.best
            runs = top_n(runs, n, next(iter(self.sums)), tie, (RUN_FROM, RUN_TO)).drop("rank")
        ends = series(F.col(RUN_FROM) + F.lit(panes.size), F.col(RUN_TO) + F.lit(panes.size), panes.slide, kind, unit)
        return runs.select(*keys, F.explode(ends).alias(WINDOW_END), *self.sums)


@dataclass(frozen=True)
class Merged:
    """Aggregates over rows, and aggregates over their results of the same names."""

    partials: dict[str, Column]
    merges: dict[str, Column]

    def partial(self, rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(*[c.alias(n) for n, c in self.partials.items()])

    def combine(self, parts: DataFrame, by: list[str]) -> DataFrame:
        return parts.groupBy(*by).agg(*[c.alias(n) for n, c in self.merges.items()])

    def windows(
        self, panes: Panes, parts: DataFrame, keys: list[str], kind: T.DataType, unit: str, until: int | None = None
    ) -> DataFrame:
        return panes.merged(parts, keys, self.merges, until).select(*keys, _end(panes, kind, unit), *self.merges)


@dataclass(frozen=True)
class LeastRecord:
    """The record with the least ``value``, ties by ``tie``; NULL values are no record."""

    value: str
    tie: Sequence[str]
    columns: Sequence[str]

    def _merged(self) -> Merged:
        others = [c for c in self.columns if c != self.value and c not in self.tie]
        ranked = F.struct(self.value, *self.tie, *others)
        return Merged({"record": F.min(F.when(F.col(self.value).isNotNull(), ranked))}, {"record": F.min("record")})

    def partial(self, rows: DataFrame, by: list[str]) -> DataFrame:
        return self._merged().partial(rows, by)

    def combine(self, parts: DataFrame, by: list[str]) -> DataFrame:
        return self._merged().combine(parts, by)

    def windows(
        self, panes: Panes, parts: DataFrame, keys: list[str], kind: T.DataType, unit: str, until: int | None = None
    ) -> DataFrame:
        least = self._merged().windows(panes, parts.filter("record IS NOT NULL"), keys, kind, unit, until)
        names = dict.fromkeys([self.value, *self.columns])
        return least.select(*keys, WINDOW_END, *[F.col(f"record.{c}").alias(c) for c in names])


@dataclass(frozen=True)
class Accumulator:
    """An aggregate of one's own, told once: what it starts from, how a row is added, how two are merged.

    ``add(acc, row)`` and ``merge(acc, acc)`` return the next accumulator, of the type of
    ``create``; ``result(acc)`` is what a window shows. ``row`` is a struct of ``columns``.
    Rows are added in order of ``columns``, so put the order of arrival first if it matters;
    accumulators are merged in order of time, then of their first row. The rows of one pane
    and task are folded together before anything is shuffled but their arrays, so no list
    holds more than one task has read.
    """

    create: Column
    add: Callable[[Column, Column], Column]
    merge: Callable[[Column, Column], Column]
    result: Callable[[Column], Column]
    columns: Sequence[str]
    name: str = "result"

    def partial(self, rows: DataFrame, by: list[str]) -> DataFrame:
        row = F.struct(*self.columns)
        lists = rows.groupBy(*by, F.spark_partition_id().alias("__task")).agg(F.array_sort(F.collect_list(row)).alias("__rows"))
        folded = F.aggregate("__rows", self.create, self.add)
        parts = lists.select(*by, F.struct(F.col("__rows")[0].alias("first"), folded.alias("acc")).alias("__part"))
        return self.combine(parts, by)

    def _merge(self, ordered: Column) -> Column:
        """The accumulators of a list, which has at least one, merged from left to right."""
        tail = F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0)))
        return F.aggregate(tail, ordered[0]["acc"], lambda acc, part: self.merge(acc, part["acc"]))

    def combine(self, parts: DataFrame, by: list[str]) -> DataFrame:
        lists = parts.groupBy(*by).agg(F.sort_array(F.collect_list("__part")).alias("__parts"))
        first = F.col("__parts")[0]["first"].alias("first")
        return lists.select(*by, F.struct(first, self._merge(F.col("__parts")).alias("acc")).alias("__part"))

    def windows(
        self, panes: Panes, parts: DataFrame, keys: list[str], kind: T.DataType, unit: str, until: int | None = None
    ) -> DataFrame:
        placed = F.sort_array(F.collect_list(F.struct(F.col(PANE).alias("pane"), "__part.first", "__part.acc")))
        found = panes.merged(parts, keys, {"__parts": placed}, until)
        return found.select(*keys, _end(panes, kind, unit), self.result(self._merge(F.col("__parts"))).alias(self.name))


WindowAggregate = Sums | Merged | LeastRecord | Accumulator
