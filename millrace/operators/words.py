"""Word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.plans.ordered import row_numbers


def words(df: DataFrame, text: str = "value", separator: str = r"\s", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word of ``text``: the ``keep`` columns and ``word``."""
    return df.select(*keep, F.explode(tokens(F.col(text), separator)).alias("word"))


def word_count(df: DataFrame, text: str = "value", separator: str = r"\s") -> DataFrame:
    """``word, cnt``. On a stream this is a running count: write it in update mode."""
    return words(df, text, separator).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def running_word_count(
    df: DataFrame, order: Sequence[str], text: str = "value", separator: str = " ",
    rows_per_group: int | None = None,
) -> DataFrame:
    """Every word with its running count, as the log of updates a stream would print.

    ``order`` names the columns that order the lines, the first of them a number
    or a time; ``pos`` is the place within the line.
    """
    exploded = df.select(*order, F.posexplode(tokens(F.col(text), separator)).alias("pos", "word"))
    return row_numbers(exploded, ["word"], [*order, "pos"], "cnt", rows_per_group)
