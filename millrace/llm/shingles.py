"""N-gram Jaccard join on prefix trees: which documents have nearly the same shingles.

Each text becomes the set of its word n-grams, as 64-bit hashes. The sets are put in
one global order, rare shingles first: shingles that several sets may meet at are
counted over all texts, and a table of fixed size keeps their frequency classes (any
order gives right results, this one short lists). Two
sets that link share a shingle in their prefixes, the first ``n - ceil(j n) + 1`` in
that order, so only sets that share a prefix shingle meet. Equal sets count as one,
and prefix shingles that stand for the same sets as another are left out.

The first shingle that linked sets share has few before it in either set, as those
before are in one set only; sets for which it lies too deep do not meet there. The
shingles whose sets have the same least member make a family, to which each set
travels once, with the list of its shingles there. A task stores a family in a prefix tree
in global order, paths without branches as one node. Each set walks the tree from the
root, level by level, among those it shares a prefix shingle with: the overlap with a
shared path is counted once for all sets below, and a subtree is left when its sets are
all linked or refuted already, too long, too short, or cannot reach the overlap needed
with what remains. The sets most like the others walk first, as they connect most, and
links between sets already connected are not needed for the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.llm.components import connected_components
from millrace.session import reliable_checkpoint, scratch_path

WORDS, PERCENT = 4, 85
# Slots of the table of frequency classes, and the count from which a shingle is entered.
SLOTS, FREQUENT = 1 << 21, 6
# Shingles in one block of sets that meet in a task; more sets are cut into blocks that meet pairwise.
SHINGLES_PER_BLOCK = 1_500_000
# Sets in one block, as a walk looks at a mask of them.
SETS_PER_BLOCK = 20_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\x0b\f\r")] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_CLASS_SHIFT, _SLOTS = np.uint64(58), np.uint64(SLOTS - 1)
# Bits of a shingle's number that need not travel: to count it, which only shapes the order, and to
# let sets meet at it, as sets that meet for a collision are compared and refuted.
_COUNT_BITS, _MEET_BITS = np.uint64(44), np.uint64(12)
_SLOT_BITS = np.uint64(21)
_COUNTED = (1 << 41) - 1
# Steps of a walk along a path: the first is short, as most walks end early.
_FIRST_STEP = 64


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _weights(places: np.ndarray) -> np.ndarray:
    """A 64-bit factor for each place in a word."""
    return _stirred((places.astype(np.uint64) + np.uint64(1)) * _ODD)


_USUAL_WEIGHTS = _weights(np.arange(1_024))


def _word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: the stirred sum of its bytes, weighed by their places."""
    letters = np.frombuffer(text, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[letters], [True]))))
    starts = edges[::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    spans = np.append(starts[1:], len(letters)) - starts
    letters, starts = letters[starts[0] :], starts - starts[0]
    places = np.arange(len(letters)) - np.repeat(starts, spans)
    weighed = _USUAL_WEIGHTS[places] if spans.max() <= len(_USUAL_WEIGHTS) else _weights(places)
    weighed = weighed * (letters.astype(np.uint64) + np.uint64(1))
    weighed[_SPACE[letters]] = 0
    return _stirred(np.add.reduceat(weighed, starts))


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted; a text of fewer words is one shingle, without words none."""
    hashes = _word_hashes((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    total = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = total * _ODD + hashes[i : len(hashes) - width + 1 + i]
    total = np.sort(_stirred(total))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def set_key(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


class Order:
    """The global order, as one sortable number per shingle: class of frequency, then hash."""

    def __init__(self, classes: np.ndarray) -> None:
        self.classes = classes

    def ranks(self, shingles: np.ndarray) -> np.ndarray:
        classes = self.classes[(shingles & _SLOTS).astype(np.int64)].astype(np.uint64)
        return np.sort(classes << _CLASS_SHIFT | shingles >> np.uint64(6))


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def needed(a: int, b: int, percent: int) -> int:
    """The least overlap of sets of ``a`` and ``b`` elements whose Jaccard similarity is ``percent``."""
    return -(-percent * (a + b) // (100 + percent))


class Tree:
    """A prefix tree of ordered, distinct sets, none empty.

    A node is a path, given by its first set and two depths, and the range of the sets
    below; of these the first ``ended`` end with the path. Its children stand side by side.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        # Big-endian bytes compare as the numbers do, so sorting puts shared prefixes side by side.
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.tokens, self.ids = np.unique(np.concatenate(self.sets), return_inverse=True)
        self._build()

    def _build(self) -> None:
        shared = np.zeros(len(self.sets), dtype=np.int64)
        for i, (x, y) in enumerate(zip(self.sets, self.sets[1:])):
            short = min(len(x), len(y))
            differ = x[:short] != y[:short]
            at = int(differ.argmax())
            shared[i] = at if differ[at] else short
        nodes, waiting = [], [(0, len(self.sets), 0)]
        for lo, hi, depth in waiting:
            end = int(shared[lo : hi - 1].min()) if hi - lo > 1 else int(self.sizes[lo])
            ended = int((self.sizes[lo:hi] == end).sum())
            cuts = lo + 1 + np.flatnonzero(shared[lo : hi - 1] == end)
            below = [b for b in (lo, *cuts.tolist()) if b >= lo + ended] if ended < hi - lo else []
            sizes = self.sizes[lo:hi]
            nodes.append((lo, hi, depth, end, ended, len(waiting), len(below), sizes.min(), sizes.max()))
            waiting.extend((x, y, end) for x, y in zip(below, [*below[1:], hi]))
        columns = np.array(nodes, dtype=np.int64).T
        self.lo, self.hi, self.depth, self.end, self.ended, self.child, self.children, self.least, self.most = columns

    def linked(self, x: np.ndarray, percent: int, wanted: np.ndarray) -> np.ndarray:
        """Places of the sets among ``wanted`` (a mask by place) that link with ``x``, a set that ``tokens`` holds."""
        size = len(x)
        own = np.searchsorted(self.tokens, x)
        mark = np.zeros(len(self.tokens), dtype=bool)
        mark[own] = True
        low, high = -(-percent * size // 100), 100 * size // percent
        before = np.concatenate(([0], np.cumsum(wanted)))
        found = []
        node, shared = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        at, step = self.depth[node], _FIRST_STEP
        while len(node):
            keep = (self.most[node] >= low) & (self.least[node] <= high) & (before[self.hi[node]] > before[self.lo[node]])
            node, shared, at = node[keep], shared[keep], at[keep]
            stop = np.minimum(at + step, self.end[node])
            lengths, begin = stop - at, self.starts[self.lo[node]]
            ends = np.cumsum(lengths)
            path = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin + at - (ends - lengths), lengths)
            hits = np.concatenate(([0], np.cumsum(mark[self.ids[path]])))
            shared = shared + hits[ends] - hits[ends - lengths]
            last = self.ids[begin + np.maximum(stop, 1) - 1]
            behind = np.where(stop > 0, size - np.searchsorted(own, last, "right"), size)
            # No set below can share more than what is left of either side.
            reach = shared + np.minimum(behind, self.most[node] - stop)
            keep = reach >= needed(size, np.maximum(self.least[node], low), percent)
            node, shared, at = node[keep], shared[keep], stop[keep]
            over = at == self.end[node]
            leaving = over & (self.ended[node] > 0)
            count = self.ended[node[leaving]]
            place = np.repeat(self.lo[node[leaving]], count) + _ranges(count)
            enough = np.repeat(shared[leaving], count) >= needed(size, self.sizes[place], percent)
            found.append(place[enough & wanted[place]])
            count = self.children[node[over]]
            below = np.repeat(self.child[node[over]], count) + _ranges(count)
            node = np.concatenate((node[~over], below))
            shared = np.concatenate((shared[~over], np.repeat(shared[over], count)))
            at = np.concatenate((at[~over], self.depth[below]))
            step *= 2
        return np.concatenate(found)


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def tree_edges(
    keys: np.ndarray, sets: list[np.ndarray], percent: int, met: list[np.ndarray], side: np.ndarray
) -> list[tuple[int, int]]:
    """Links that connect what is connected: at most one less than there are sets.

    Only sets whose lists in ``met`` share a shingle are compared; where there are two
    sides, only those of different sides.
    """
    tree = Tree(sets)
    count = len(tree.sets)
    keys, side = keys[tree.order], side[tree.order]
    met = [met[i] for i in tree.order]
    lengths = np.array([len(m) for m in met])
    owner = np.repeat(np.arange(count), lengths)
    shingles, number = np.unique(np.concatenate(met), return_inverse=True)
    members = owner[np.argsort(number, kind="stable")]
    sizes = np.bincount(number, minlength=len(shingles))
    begins, first = np.cumsum(sizes) - sizes, np.cumsum(lengths) - lengths
    likeness = np.add.reduceat(np.bincount(tree.ids)[tree.ids], tree.starts) / tree.sizes
    two, parts = bool(side.any() and not side.all()), np.arange(count)
    waiting = np.ones(count, dtype=bool)
    edges = []
    for i in np.argsort(-likeness, kind="stable").tolist():
        own = number[first[i] : first[i] + lengths[i]]
        wanted = np.zeros(count, dtype=bool)
        wanted[members[np.repeat(begins[own], sizes[own]) + _ranges(sizes[own])]] = True
        waiting[i] = False
        wanted &= waiting & (parts != parts[i])
        if two:
            wanted &= side != side[i]
        if wanted.any():
            links = tree.linked(tree.sets[i], percent, wanted)
            joined, one = np.unique(parts[links], return_index=True)
            if len(joined):
                edges.extend((int(keys[i]), int(keys[j])) for j in links[one])
                parts[np.isin(parts, joined)] = parts[i]
    return edges


def _sets(df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            found = [shingle_set(v.as_py(), words) for v in batch.column(1)]
            yield {"id": batch.column(0), "n": [len(s) for s in found],
                   "set": [set_key(s) if len(s) else None for s in found]}

    return map_batches(df.select(F.col(key).cast("long"), text), run, "id long, n long, set long")


def _frequency_order(df: DataFrame, text: str, words: int, percent: int) -> Order:
    """Classes by the logarithm of a shingle's count among the texts' first shingles by hash, twice the prefix each.

    Shingles that share a slot take the greater class. At most SLOTS rows come to the driver.
    """

    def run(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            found = []
            for value in batch.column(0):
                shingles = shingle_set(value.as_py(), words)
                found.append(shingles[: 2 * prefix_length(len(shingles), percent)] if len(shingles) else shingles)
            if found:
                tokens = np.concatenate(found)
                # The slot, and enough other bits to tell shingles of one slot apart.
                yield {"token": (tokens >> _COUNT_BITS << _SLOT_BITS | tokens & _SLOTS).view(np.int64) & _COUNTED}

    counts = map_batches(df.select(text), run, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    slot = F.col("token").bitwiseAND(F.lit(SLOTS - 1)).cast("int")
    rows = counts.filter(F.col("c") >= FREQUENT).groupBy(slot.alias("slot")).agg(F.max("c").alias("c")).toPandas()
    classes = np.zeros(SLOTS, dtype=np.uint8)
    classes[rows["slot"]] = np.minimum(np.log2(rows["c"].to_numpy(dtype=float)), 31).astype(np.uint8)
    return Order(classes)


def _postings(df: DataFrame, text: str, words: int, percent: int, order: Order) -> DataFrame:
    """(token, set, excess): each set's prefix shingles; a set that comes often in a task is given once.

    ``excess`` is positive where a shingle's place is too deep for a partner at place 0 of
    the same size: linked sets a, b have ``excess_a + excess_b <= 0`` at their first common
    shingle, as |a| + |b| - 2 |a & b| is at least the sum of both places.
    """

    def run(batches: Iterator) -> Iterator[dict]:
        seen = set()
        for batch in batches:
            tokens, keys, excess = [], [], []
            for value in batch.column(0):
                found = shingle_set(value.as_py(), words)
                if not len(found) or (own := set_key(found)) in seen:
                    continue
                seen.add(own)
                prefix = order.ranks(found)[: prefix_length(len(found), percent)]
                # Numbers that collide are one place to meet, the first.
                prefix, first = np.unique(prefix >> _MEET_BITS, return_index=True)
                tokens.append(prefix.view(np.int64))
                keys.append(np.full(len(prefix), own, dtype=np.int64))
                excess.append((100 + percent) * first - (100 - percent) * len(found))
            if tokens:
                yield {"token": np.concatenate(tokens), "set": np.concatenate(keys), "excess": np.concatenate(excess)}

    return map_batches(df.select(text), run, "token long, set long, excess long")


def _packed_texts(df: DataFrame, key: str, text: str, wanted: DataFrame, words: int) -> DataFrame:
    """(set, n, packed) of the sets in ``wanted(set, id)``: the compressed text of document ``id``.

    A compressed text is a fraction of its shingles' hashes, so it travels, and tasks make the set again.
    """

    def pack(batches: Iterator) -> Iterator[dict]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [v.as_py() or "" for v in batch.column(1)]
            yield {"id": batch.column(0), "packed": [tool.compress(t.encode()) for t in texts]}

    def check(batches: Iterator) -> Iterator[dict]:
        tool, seen = zstandard.ZstdDecompressor(), set()
        for batch in batches:
            keys, packed = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            found = [shingle_set(tool.decompress(p).decode(), words) for p in packed]
            # Rows that share the id but not the text are not the document meant; rows that repeat it are needed once.
            right = []
            for i, (f, k) in enumerate(zip(found, keys)):
                if len(f) and set_key(f) == k and k not in seen:
                    seen.add(k)
                    right.append(i)
            yield {"set": [keys[i] for i in right], "n": [len(found[i]) for i in right], "packed": [packed[i] for i in right]}

    texts = map_batches(df.select(F.col(key).cast("long"), text), pack, "id long, packed binary")
    chosen = texts.join(wanted, texts["id"].eqNullSafe(wanted["id"])).select("packed", "set")
    # A set that two tasks give only meets itself.
    return map_batches(chosen, check, "set long, n long, packed binary")


def _places(met: DataFrame, packed: DataFrame) -> DataFrame:
    """(lead, i, j, set, met, side): where the sets of a family meet, of ``met(lead, set, met)``.

    A family is cut into blocks of about SHINGLES_PER_BLOCK and SETS_PER_BLOCK that meet
    pairwise if it is large; ``side`` tells which block of a pair a set is from.
    """
    members = reliable_checkpoint(met.join(packed.select("set", "n"), "set"))
    full = F.greatest(F.sum("n") / SHINGLES_PER_BLOCK, F.count(F.lit(1)) / SETS_PER_BLOCK)
    blocks = members.groupBy("lead").agg(F.ceil(full).cast("int").alias("blocks"))
    placed = members.join(reliable_checkpoint(blocks), "lead").withColumn(
        "b", F.pmod(F.xxhash64("set"), "blocks").cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.select("lead", "set", "met", "b", other.alias("o")).select(
        "lead", "set", "met", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), (F.col("b") > F.col("o")).alias("side")
    )


def _meetings(met: DataFrame, packed: DataFrame, words: int, percent: int, order: Order) -> DataFrame:
    """Links (a, b) among sets that share a prefix shingle, enough to connect what is connected."""

    def meet(family: pa.Table) -> pa.Table:
        tool = zstandard.ZstdDecompressor()
        texts = (tool.decompress(v).decode() for v in family.column("packed").to_pylist())
        found = [order.ranks(shingle_set(t, words)) for t in texts]
        shingles = [np.array(m.values) for m in family.column("met")]
        edges = tree_edges(np.array(family.column("set")), found, percent, shingles, np.array(family.column("side")))
        return pa.table({n: pa.array([e[k] for e in edges], pa.int64()) for k, n in enumerate("ab")})

    meeting = _places(met, packed).join(packed.select("set", "packed"), "set").groupBy("lead", "i", "j")
    return meeting.applyInArrow(meet, "a long, b long")


def jaccard_components(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``df``: key, ``n_shingles``, ``component_id``.

    Documents link if their shingle sets' Jaccard similarity is at least ``percent``
    in a hundred; the component is the smallest key that links lead to, the own one
    included. NULL, empty and blank texts have no shingles and link with nothing.
    Rows with the same key are documents of their own; NULL keys come last. Other
    columns are ignored. Shingles, and sets, are told apart by 64-bit hashes.
    """
    spark = df.sparkSession
    order = _frequency_order(df, text, words, percent)
    sets = reliable_checkpoint(_sets(df, key, text, words))
    place = Window.partitionBy("token")
    posted = _postings(df, text, words, percent, order).repartition("token")
    posted = posted.groupBy("token", "set").agg(F.min("excess").alias("excess"))
    near = posted.select("*", F.min("excess").over(place).alias("least")).filter("excess + least <= 0")
    sizes = near.select("token", "set", F.count(F.lit(1)).over(place).alias("sets"), F.min("set").over(place).alias("lead"))
    # A set has no more shingles in a family than its prefix has.
    met = sizes.filter("sets > 1").groupBy("lead", "set").agg(F.collect_list("token").alias("met"))
    folder = scratch_path(spark, "prefixes")
    met.write.parquet(folder)
    met = spark.read.parquet(folder)
    first = sets.filter("set IS NOT NULL").groupBy("set").agg(F.min("id").alias("id"))
    wanted = met.select("set").distinct().join(first, "set")
    packed = reliable_checkpoint(_packed_texts(df, key, text, wanted, words))
    parts = connected_components(_meetings(met, packed, words, percent, order))
    labels = first.join(parts.withColumnRenamed("node", "set"), "set", "left").select(
        "set", "id", F.coalesce("component", "set").alias("component")
    )
    least = reliable_checkpoint(labels.groupBy("component").agg(F.min("id").alias("least")))
    labels = reliable_checkpoint(labels.join(least, "component").select("set", "least"))
    return sets.join(labels, "set", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id")
    )
