"""Connected components of a distributed graph, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import reliable_checkpoint


def connected_components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another; component is its smallest node.

    Large star: every node links its larger neighbours to the smallest one. Small star:
    it links itself and its smaller neighbours to the smallest. Repeated until nothing
    changes, which takes a number of rounds that is logarithmic in practice. All
    rounds are joins and groupings; each is cut off by a checkpoint. Two numbers per
    round come to the driver. Rows with NULLs and loops are left out.
    """
    high, low = F.greatest(first, second), F.least(first, second)
    clean = edges.filter(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col(first) != F.col(second)))
    pairs = reliable_checkpoint(clean.select(high.alias("u"), low.alias("v")).distinct())
    seen = _state(pairs)
    while seen[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # The checkpoint lets the join deal out anew what a node with very many neighbours has.
        least = reliable_checkpoint(least)
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = reliable_checkpoint(large.distinct())
        smallest = reliable_checkpoint(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = large.join(smallest, "u")
        small = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u != v")
        pairs = reliable_checkpoint(small.distinct())
        now = _state(pairs)
        if now == seen:
            break
        seen = now
    return pairs.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def local_components(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest reachable index of each of ``size`` nodes, given links between two index arrays."""
    labels = np.arange(size)
    while True:
        least = np.minimum(labels[left], labels[right])
        new = labels.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new
