"""Top-n per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Up to this n Spark itself cuts each task's groups to n rows before the shuffle.
_SPARK_LIMITS_UP_TO = 1_000


def top_n(
    df: DataFrame, n: int, by: str = "cnt", tie: Sequence[str] = ("item_id",), per: Sequence[str] = ("window_end",),
    salts: int = 64,
) -> DataFrame:
    """The ``n`` rows with the greatest ``by`` of each group, with ``rank`` 1..n.

    Equal values rank by ``tie`` ascending. A group may hold any number of
    rows: only its n best per task reach the ranking task, by Spark's own group
    limit or, for a large n, by a first ranking within ``salts`` parts.
    """
    best = [F.col(by).desc(), *[F.col(t).asc() for t in tie]]
    if n > _SPARK_LIMITS_UP_TO:
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*tie), F.lit(salts)))
        part = Window.partitionBy(*per, "__salt").orderBy(*best)
        df = salted.withColumn("__place", F.row_number().over(part)).filter(F.col("__place") <= n)
        df = df.drop("__salt", "__place")
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*per).orderBy(*best)))
    return ranked.filter(F.col("rank") <= n)
