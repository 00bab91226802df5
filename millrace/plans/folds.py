"""State machines over each key's rows in order, as native fold expressions.

The rows of a key are cut into spans of at most ``SPAN_ROWS`` by their row
number, so no array grows with the data. A span is folded from a guessed entry
state; spans whose predecessor turns out to end in another state are folded
again, until all agree. The first span's state is known, so the agreed states
are the true ones. Machines that forget (alarms with a time limit do) agree
after one correction.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.ordered import row_numbers
from millrace.session import reliable_checkpoint

SPAN_ROWS = 20_000

_SPAN, _ITEMS, _ENTRY, _BEGIN, _RUN = "__span", "__items", "__entry", "__begin", "__run"


@dataclass(frozen=True)
class Machine:
    """A state machine, told once for tables and streams.

    ``state`` is the state before a key's first row, ``out`` an empty array of what it emits.
    ``step(acc, row)`` gets a struct of the two and a struct of one row, ``us`` among its
    fields, and returns the next such struct. ``expire(state, us)`` tells the same of time having
    passed ``us`` (microseconds) without a row: a timer due by then runs out. ``columns`` are
    what it needs of a row.
    """

    state: Column
    out: Column
    step: Callable[[Column, Column], Column]
    expire: Callable[[Column, Column], Column]
    columns: tuple[str, ...]


def run_machine(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], machine: Machine, entry: DataFrame | None = None,
    span_rows: int = SPAN_ROWS, rows_per_group: int | None = None,
) -> DataFrame:
    """(keys, state, out, last) of every key with rows, see :func:`ordered_fold`; ``rows`` have ``us``."""
    return ordered_fold(
        rows, keys, order, ["us", *machine.columns], machine.state, machine.out, machine.step, span_rows, rows_per_group, entry
    )


def machine_outputs(runs: DataFrame, keys: Sequence[str], machine: Machine) -> DataFrame:
    """(keys, out): one row per thing emitted in a table, timers left at its end included."""
    end = machine.expire(F.col("state"), F.lit(_END))["out"]
    every = F.when(F.col("last"), F.concat("out", end)).otherwise(F.col("out"))
    return runs.select(*keys, F.explode(every).alias("out"))


# Later than any time, yet far from overflow.
_END = (1 << 62)


def ordered_fold(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    state: Column,
    out: Column,
    step: Callable[[Column, Column], Column],
    span_rows: int = SPAN_ROWS,
    rows_per_group: int | None = None,
    entry: DataFrame | None = None,
) -> DataFrame:
    """Folds every key's rows and returns ``keys``, ``state``, ``out``, ``last``.

    ``state`` is the state before a key's first row and ``out`` an empty array of
    what the machine emits. ``step(acc, row)`` gets a struct of the two and one
    row struct, and returns the next such struct. A key longer than
    ``span_rows`` gives several rows; only the one with ``last`` ends the key.
    ``entry`` (keys, state), at most one row per key, has the states of keys that begin in another.
    """
    keys = list(keys)

    def begun(spans: DataFrame) -> DataFrame:
        """``spans`` with the state their key begins in."""
        if entry is None:
            return spans.withColumn(_BEGIN, state)
        states = entry.select(*_others(keys), F.col("state").alias(_BEGIN))
        # Without keys there is one state at most.
        joined = spans.join(states, _same(keys) if keys else F.lit(True), "left")
        return joined.select(*spans.columns, F.coalesce(_BEGIN, state).alias(_BEGIN))

    items = F.array_sort(F.collect_list(F.struct(*order, *[c for c in columns if c not in order]))).alias(_ITEMS)
    if longest(df, keys) <= span_rows:
        start = F.struct(F.col(_BEGIN).alias("state"), out.alias("out"))
        run = begun(df.groupBy(*keys).agg(items)).select(*keys, F.aggregate(_ITEMS, start, step).alias(_RUN))
        return run.select(*keys, f"{_RUN}.state", f"{_RUN}.out", F.lit(True).alias("last"))

    numbered = row_numbers(df, keys, order, "__row", rows_per_group)
    span = F.floor((F.col("__row") - 1) / F.lit(span_rows)).alias(_SPAN)
    spans = reliable_checkpoint(numbered.groupBy(*keys, span).agg(items))
    along = Window.partitionBy(*keys).orderBy(_SPAN)

    def folded(spans_with_entry: DataFrame) -> DataFrame:
        start = F.struct(F.col(_ENTRY).alias("state"), out.alias("out"))
        run = spans_with_entry.select(*keys, _SPAN, _ENTRY, _BEGIN, F.aggregate(_ITEMS, start, step).alias(_RUN))
        return run.select(*keys, _SPAN, _ENTRY, _BEGIN, f"{_RUN}.state", f"{_RUN}.out")

    spans = reliable_checkpoint(begun(spans)) if entry is not None else begun(spans)
    done = reliable_checkpoint(folded(spans.withColumn(_ENTRY, F.col(_BEGIN))))
    place = [*keys, _SPAN]
    while True:
        # Only states, not what was emitted, pass through the window over a key's spans.
        due = F.coalesce(F.lag("state").over(along), F.col(_BEGIN)).alias("__due")
        entries = done.select(*place, _ENTRY, due).filter(~F.col("__due").eqNullSafe(F.col(_ENTRY)))
        stale = reliable_checkpoint(entries.select(*_others(place), "__due"))
        if stale.isEmpty():
            break
        kept = done.join(stale, _same(place), "left_anti")
        again = spans.join(stale, _same(place)).select(*place, F.col("__due").alias(_ENTRY), _BEGIN, _ITEMS)
        done = reliable_checkpoint(kept.unionByName(folded(again)))
    ends = done.groupBy(*keys).agg(F.max(_SPAN).alias(_SPAN)).select(*_others(place))
    return done.join(ends, _same(place), "left_outer").select(
        *keys, "state", "out", F.col(f"__other_{_SPAN}").isNotNull().alias("last")
    )


def _others(columns: list[str]) -> list[Column]:
    return [F.col(c).alias(f"__other_{c}") for c in columns]


def _same(columns: list[str]) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"__other_{c}")) for c in columns])


def longest(df: DataFrame, keys: list[str]) -> int:
    """The row count of the longest key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
