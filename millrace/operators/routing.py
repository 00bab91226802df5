"""Splitting, tagging, selecting and merging streams of rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = "tags"
TAG = "tag"
MAIN = "main"

# Tags and texts of the parity example, the side tag of cold readings.
EVEN, ODD = "偶数", "奇数"
EVEN_TEXT, ODD_TEXT = "偶数：", "奇数"
FREEZE_TAG = "freeze point warning "
FREEZE_POINT = 32.0


def split(df: DataFrame, tags: Column) -> DataFrame:
    """Adds ``tags``, an array of the names under which a row can be selected."""
    return df.withColumn(TAGS, tags)


def parity_tags(x: Column) -> Column:
    """Even and odd numbers, negative ones included."""
    return F.array(F.when(x % 2 == 0, EVEN).otherwise(ODD))


def select(split_df: DataFrame, *names: str) -> DataFrame:
    """Rows with at least one of the tags, without the tags."""
    wanted = F.array(*[F.lit(n) for n in names])
    return split_df.filter(F.arrays_overlap(TAGS, wanted)).drop(TAGS)


def connect_map(
    left: DataFrame, right: DataFrame,
    map_left: Callable[[DataFrame], DataFrame], map_right: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Two streams of different types, each mapped to one common type."""
    return map_left(left).unionByName(map_right(right))


def union(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    return reduce(DataFrame.unionByName, dfs)


def route(df: DataFrame, routes: dict[str, Column], main: str = MAIN) -> DataFrame:
    """Adds ``tag``: the first route whose predicate holds, else ``main``."""
    tag = F.lit(main)
    for name, where in reversed(routes.items()):
        tag = F.when(where, F.lit(name)).otherwise(tag)
    return df.withColumn(TAG, tag)


def freeze_route(df: DataFrame, temperature: str = "temperature", limit: float = FREEZE_POINT) -> DataFrame:
    """Readings below ``limit`` go to the freeze tag."""
    return route(df, {FREEZE_TAG: F.col(temperature) < limit})


def side_output(routed: DataFrame, tag: str) -> DataFrame:
    """The rows of one tag, as a stream of their own."""
    return routed.filter(F.col(TAG) == tag).drop(TAG)
