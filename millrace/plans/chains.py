"""Walks along a key's rows that jump: where to jump to, and which rows the walk visits.

Both work on rows numbered 1, 2, 3, ... within their key, take a logarithmic number of rounds,
and never hold more than one node's or one span's rows in one place, however long a key is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import reliable_checkpoint

FAN = 64
SPAN = 1024

_AT = ["key", "pos", "us", "x"]


def _div(column: Column | str, by: int) -> Column:
    return F.call_function("div", F.col(column) if isinstance(column, str) else column, F.lit(by))


def first_later(rows: DataFrame, limit: int, fan: int = FAN) -> DataFrame:
    """Adds ``found`` (at, us, x): the first later row with a value not above, or more than ``limit`` later.

    ``rows`` are (key, pos, us, x), with ``us`` never falling along ``pos``. Rows lie in nodes of
    ``fan``, these in nodes of ``fan`` nodes, and so on, each with its least value and last
    time. A row looks in its own node, then among the later ones of the node above, as far up as
    it takes, and down again into the first node that must hold a row to be found.
    """

    def met(s: Column, us: Column, x: Column) -> Column:
        return (s["x"] <= x) | (s["us"] > us + F.lit(limit))

    def grouped(parts: DataFrame, at: Column) -> DataFrame:
        kid = F.struct(at.alias("at"), "us", "x")
        return parts.groupBy("key", "node").agg(F.array_sort(F.collect_list(kid)).alias("kids"))

    leaves = reliable_checkpoint(grouped(rows.select(*_AT, _div(F.col("pos") - 1, fan).alias("node")), F.col("pos")))

    def own(r: Column) -> Column:
        later = F.filter("kids", lambda s: (s["at"] > r["at"]) & met(s, r["us"], r["x"]))
        return F.struct(r["at"].alias("pos"), r["us"].alias("us"), r["x"].alias("x"), F.get(later, F.lit(0)).alias("found"))

    looked = leaves.select("key", "node", F.explode(F.transform("kids", own)).alias("r")).select("key", "node", "r.*")
    top = leaves.agg(F.max("node")).first()[0] or 0
    if not top:
        return looked.select(*_AT, "found")
    looked = reliable_checkpoint(looked)
    results = [looked.filter("found IS NOT NULL").select(*_AT, "found")]
    waiting, levels = looked.filter("found IS NULL").select(*_AT, "node"), [leaves]
    while top:
        spans = levels[-1].select(
            "key", F.col("node").alias("at"), _div("node", fan).alias("node"),
            F.array_max(F.transform("kids", lambda k: k["us"])).alias("us"),
            F.array_min(F.transform("kids", lambda k: k["x"])).alias("x"),
        )
        levels.append(grouped(spans, F.col("at")))
        above = levels[-1].withColumnRenamed("node", "up")
        asked = waiting.withColumn("up", _div("node", fan)).join(above, ["key", "up"])
        later = F.filter("kids", lambda s: (s["at"] > F.col("node")) & met(s, F.col("us"), F.col("x")))
        asked = reliable_checkpoint(asked.select(*_AT, "up", F.get(later, F.lit(0))["at"].alias("hit")))
        down = asked.filter("hit IS NOT NULL").select(*_AT, F.col("hit").alias("node"))
        for level in reversed(levels[:-1]):
            inside = F.get(F.filter("kids", lambda s: met(s, F.col("us"), F.col("x"))), F.lit(0))
            down = down.join(level, ["key", "node"]).select(*_AT, inside.alias("found"), inside["at"].alias("node"))
        results.append(down.select(*_AT, "found"))
        waiting = asked.filter("hit IS NULL").select(*_AT, F.col("up").alias("node"))
        top //= fan
    nothing = F.lit(None).cast(looked.schema["found"].dataType).alias("found")
    results.append(waiting.select(*_AT, nothing))
    whole = results[0]
    for part in results[1:]:
        whole = whole.unionByName(part)
    return whole


def visited(links: DataFrame, span: int = SPAN) -> tuple[DataFrame, int]:
    """(key, pos) of the rows on the way from each key's head, and the number of doubling rounds.

    ``links`` are (key, pos, next, head), next after pos or NULL; ``head`` is true for at most
    one row per key. Inside a span of rows the way to the first row beyond it is found at once;
    the spans' entries are then marked by doubling of pointers: a round marks where the marked
    ones lead in 1, 2, 4, ... steps. Only rows some way leads to take part.
    """
    spans = reliable_checkpoint(
        links.groupBy("key", _div(F.col("pos") - 1, span).alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "next", "head"))).alias("kids")
        )
    )
    beyond = F.col("kids")[F.size("kids") - 1]["pos"]

    def leave(exits: Column, r: Column) -> Column:
        inside = F.get(exits, (r["next"] - r["pos"] - 1).cast("int"))
        return F.concat(F.array(F.when(r["next"] > beyond, r["next"]).otherwise(inside)), exits)

    exits = F.aggregate(F.reverse("kids"), F.array().cast("array<bigint>"), leave)
    zipped = F.arrays_zip(F.col("kids.pos").alias("pos"), F.col("kids.head").alias("marked"), exits.alias("exit"))
    hops = reliable_checkpoint(spans.select("key", F.explode(zipped).alias("h")).select("key", "h.*"))
    ends = F.explode(F.array("exit", F.when(F.col("marked"), F.col("pos")))).alias("pos")
    targets = hops.select("key", ends).filter("pos IS NOT NULL").distinct()
    jumps, rounds = reliable_checkpoint(hops.join(targets, ["key", "pos"]).select("key", "pos", "exit", "marked")), 0
    while True:
        reached = jumps.filter("marked AND exit IS NOT NULL").select("key", F.col("exit").alias("pos"), F.lit(True).alias("hit"))
        if reached.isEmpty():
            break
        rounds += 1
        ahead = jumps.select("key", F.col("pos").alias("exit"), F.col("exit").alias("farther"))
        both = jumps.join(ahead, ["key", "exit"], "left").join(reached, ["key", "pos"], "left")
        jumps = reliable_checkpoint(both.select(
            "key", "pos", F.col("farther").alias("exit"), (F.col("marked") | F.coalesce("hit", F.lit(False))).alias("marked")))
    entries = jumps.filter("marked").select("key", _div(F.col("pos") - 1, span).alias("node"), F.col("pos").alias("entry"))

    def walk(done: Column, r: Column) -> Column:
        here = F.struct(r["next"].alias("due"), F.concat(done["way"], F.array(r["pos"])).alias("way"))
        return F.when(r["pos"] == done["due"], here).otherwise(done)

    start = F.struct(F.col("entry").alias("due"), F.array().cast("array<bigint>").alias("way"))
    walked = spans.join(entries, ["key", "node"]).select("key", F.aggregate("kids", start, walk)["way"].alias("way"))
    return walked.select("key", F.explode("way").alias("pos")), rounds
