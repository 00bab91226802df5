"""Mixing sources to target weights by repeating documents.

Per source: size, target (weighted shares of a budget, capped at a multiple of the
source, the excess shared again), repetition rate = target / size. A document is
taken ``floor(rate)`` times and once more with the probability of the rate's
fraction. That draw compares a hash of the document with the fraction. The hash
takes a seed, and each source uses the one of ``SEEDS`` whose draws come nearest
to its target: few long documents would otherwise miss it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import word_count
from millrace.session import reliable_checkpoint

SEEDS = 24
# Rows of the per-source plan that are broadcast at most; beyond, the join shuffles.
BROADCAST_SOURCES = 10_000
_STEPS = 1 << 30


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of (source, size).

    Sources take the ``weights`` in turn, in code point order, NULL last. They share
    ``budget`` times all sizes by weight; no target is above ``most`` times its
    source's size. Sources below that cap get ``level * weight``. The level follows
    from the sources sorted by cap / weight: those before some point are capped, the
    others share the rest. The two windows run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = per_source.select("*", weight.alias("weight")).select(
        "*", (F.col("source_size") * F.lit(float(most))).alias("cap")
    )
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"),
        (F.sum("source_size").over(every) * F.lit(float(budget))).alias("total"),
    )
    # Of the sources that their own level does not lift above their cap, the first has the greatest level.
    own = (F.col("total") - F.col("capped")) / F.col("open")
    level = F.max(F.when(own * F.col("weight") <= F.col("cap"), own)).over(every)
    target = F.least(F.col("cap"), level * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def _extra(key: Column, fraction: Column, seed: Column) -> Column:
    """1 if the hash-seeded draw of a document falls below ``fraction``, else 0."""
    place = F.pmod(F.xxhash64(key, seed), F.lit(_STEPS))
    return (place < fraction * F.lit(float(_STEPS))).cast("long")


def _with_source(df: DataFrame, per_source: DataFrame, few: bool) -> DataFrame:
    right = per_source.withColumnRenamed("source", "__source")
    return df.join(F.broadcast(right) if few else right, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def _sizes(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(key, source, size) of every document, kept in the checkpoint folder between the passes."""
    return reliable_checkpoint(
        df.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    )


def _plan(sizes: DataFrame, weights: Sequence[int], budget: float, most: float) -> tuple[DataFrame, bool]:
    """One row per source with target, ``whole`` copies, ``fraction`` and ``seed``; whether these are few rows."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = reliable_checkpoint(source_targets(sizes, weights, budget, most).select(
        "*", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("fraction")
    ))
    few = targets.count() <= BROADCAST_SOURCES
    seeds = range(SEEDS)
    drawn = _with_source(sizes, targets, few).groupBy("source").agg(
        F.first("target").alias("t"), F.first("whole").alias("w"), F.first("source_size").alias("all"),
        *[F.sum(_extra(F.col("key"), F.col("fraction"), F.lit(s)) * F.col("size")).alias(f"d{s}") for s in seeds],
    )
    missed = [
        F.struct(F.abs(F.col("w") * F.col("all") + F.col(f"d{s}") - F.col("t")).alias("by"), F.lit(s).alias("seed"))
        for s in seeds
    ]
    best = drawn.select("source", F.array_min(F.array(*missed))["seed"].alias("seed"))
    return reliable_checkpoint(_with_source(targets, best, few)), few


def mix(
    df: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, most: float = 2.0,
    key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per document: key, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    The size is the number of words, 0 for NULL and blank texts. NULL is a source like
    any other. Rows with the same key are drawn alike; a NULL key is drawn like any
    value. An empty table gives no rows. Columns beside the three are ignored.
    """
    sizes = _sizes(df, key, text, source)
    plan, few = _plan(sizes, weights, budget, most)
    copies = F.col("whole") + _extra(F.col("key"), F.col("fraction"), F.col("seed"))
    return _with_source(sizes, plan, few).select(
        F.col("key").alias(key), F.col("size"), F.col("source_size"), F.col("target"), copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def emit(
    df: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, most: float = 2.0,
    key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The documents of ``df`` as often as ``mix`` takes them, with all their columns."""
    plan, few = _plan(_sizes(df, key, text, source), weights, budget, most)
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.col(source).alias("source"))
    joined = _with_source(whole, plan, few)
    copies = F.col("whole") + _extra(F.col(f"__row.{key}"), F.col("fraction"), F.col("seed"))
    repeated = joined.select("__row", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
    return repeated.select("__row.*")
