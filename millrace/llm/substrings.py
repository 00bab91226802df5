"""Repeated substrings: every byte that a long string covers which also starts elsewhere.

Sorting all suffixes of a corpus would ship every text many times over. Here each
window of ``LENGTH`` bytes names an anchor: of the byte grams inside it, the one with the
least hash, the leftmost of equals. Equal windows name equal anchors at equal places,
so windows are dealt into buckets by their anchor's gram, and one row stands for the
run of neighbouring windows that name the same place (a *stretch*). Stretches whose
gram comes once are done. Those with equal content are repeated as a whole. Of the
rest, one per content is read back, and the suffixes that start its windows are sorted
within the bucket, deep-shallow: multikey quicksort, eight bytes a step, to a shallow
depth, then blind tries for the groups that are still tied. Windows that end on one
leaf of a trie are repeated.

A bucket of more than ``MOST_IN_BUCKET`` contents is not sorted in one task; its windows
are counted by a 128-bit hash in a grouping instead, which gives the same answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.session import reliable_checkpoint, scratch_path

LENGTH, GRAM = 400, 200
MOST_IN_BUCKET = 4_096
SHALLOW = 24
_SEGMENT = 1 << 22
_PLACE_BITS = np.uint64(24)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:size]


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each run of ``gram`` bytes."""
    size = len(data)
    terms = (data.astype(np.uint64) + np.uint64(1)) * _power(_INVERSE, size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    h = (sums[gram:] - sums[:-gram]) * _power(_BASE, size - gram + 1)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by least values from block starts and to block ends."""
    size = len(values)
    blocks = -(-size // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:size] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: size - width + 1], ahead[width - 1 : size])


def stretches(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, first window, last window, anchor) of each stretch of a text of at least ``length`` bytes."""
    parts = []
    for start in range(0, len(data) - length + 1, _SEGMENT):
        part = np.frombuffer(data, dtype=np.uint8, offset=start, count=min(_SEGMENT + length - 1, len(data) - start))
        hashes = _gram_hashes(part, gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_least((hashes >> _PLACE_BITS) << _PLACE_BITS | places, length - gram + 1)
        anchor = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        turns = np.flatnonzero(np.diff(anchor)) + 1
        first = np.concatenate([[0], turns])
        last = np.concatenate([turns, [len(anchor)]]) - 1
        at = anchor[first]
        parts.append((hashes[at].view(np.int64), first + start, last + start, at + start))
    return tuple(np.concatenate(p) for p in zip(*parts))


class BlindTrie:
    """Strings of ``length`` bytes at places of ``data``; nodes hold only the depth and byte they branch on."""

    def __init__(self, data: bytes, length: int, depth: int) -> None:
        self.data, self.length, self.depth = data, length, depth
        self.root: list | None = None

    def _common(self, p: int, q: int) -> int:
        """How many bytes from the start are equal; the first ``depth`` are known to be."""
        data, low, high = self.data, self.depth, self.length
        if data[p + low : p + high] == data[q + low : q + high]:
            return high
        while high - low > 1:
            middle = (low + high) // 2
            if data[p + low : p + middle] == data[q + low : q + middle]:
                low = middle
            else:
                high = middle
        return low

    def insert(self, p: int) -> None:
        """A leaf is [None, places]; a branch is [depth, {byte: node}]."""
        if self.root is None:
            self.root = [None, [p]]
            return
        data, node, path = self.data, self.root, []
        while node[0] is not None:
            path.append(node)
            # Blind: a missing byte leads down any branch, the comparison below settles it.
            node = node[1].get(data[p + node[0]]) or next(iter(node[1].values()))
        common = self._common(p, node[1][0])
        if common == self.length:
            node[1].append(p)
            return
        above = None
        for step in path:
            if step[0] >= common:
                break
            above = step
        below = self.root if above is None else above[1].get(data[p + above[0]])
        leaf = [None, [p]]
        if below is None:
            above[1][data[p + above[0]]] = leaf
        elif below[0] == common:
            below[1][data[p + common]] = leaf
        else:
            inner = below
            while inner[0] is not None:
                inner = next(iter(inner[1].values()))
            branch = [common, {data[inner[1][0] + common]: below, data[p + common]: leaf}]
            if above is None:
                self.root = branch
            else:
                above[1][data[p + above[0]]] = branch

    def leaves(self) -> Iterator[list[int]]:
        """The places of equal strings together, in the order of the strings."""
        waiting = [self.root] if self.root else []
        while waiting:
            node = waiting.pop()
            if node[0] is None:
                yield node[1]
            else:
                waiting.extend(node[1][b] for b in sorted(node[1], reverse=True))


def repeated_places(data: bytes, places: np.ndarray, length: int) -> np.ndarray:
    """Those of the ``places`` whose strings of ``length`` bytes also start at another of them."""
    whole = np.frombuffer(data + bytes(8), dtype=np.uint8).astype(np.uint64)
    words = np.zeros(len(data) + 1, dtype=np.uint64)
    for i in range(8):
        words = words << np.uint64(8) | whole[i : i + len(words)]
    group = np.zeros(len(places), dtype=np.int64)
    for depth in range(0, min(SHALLOW, length - 7), 8):
        key = words[places + depth]
        order = np.lexsort((key, group))
        places, group, key = places[order], group[order], key[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])[: len(places)]
        group = np.cumsum(new)
        tied = np.bincount(group)[group] > 1
        places, group = places[tied], group[tied]
        if not len(places):
            return places
    found = []
    known = min(SHALLOW, (length // 8) * 8)
    for tied in np.split(places, np.flatnonzero(np.diff(group)) + 1):
        trie = BlindTrie(data, length, known)
        for p in tied.tolist():
            trie.insert(p)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                found.extend(leaf)
    return np.sort(np.array(found, dtype=np.int64))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.flatnonzero(np.diff(values) > 1) + 1
    return values[np.concatenate([[0], cuts])], values[np.concatenate([cuts, [len(values)]]) - 1]


def _bytes(value: pa.Scalar) -> bytes:
    return (value.as_py() or "").encode("utf-8", "surrogatepass")


def _identity(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _described(df: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            data = [_bytes(v) for v in batch.column(1)]
            yield {"id": batch.column(0), "t": [_identity(d) for d in data], "n": [len(d) for d in data],
                   "sha": [hashlib.sha256(d).hexdigest() for d in data]}

    return map_batches(df.select(F.col(key).cast("long"), text), run, "id long, t long, n long, sha string")


def _stretch_rows(df: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    """(h, same, t, at, span): the stretches of each text; a text met again in a task is skipped."""

    def run(batches: Iterator) -> Iterator[dict]:
        seen = set()
        for batch in batches:
            rows, size = [], 0
            for value in batch.column(0):
                data = _bytes(value)
                t = _identity(data)
                if len(data) < length or t in seen:
                    continue
                seen.add(t)
                h, first, last, anchor = stretches(data, length, gram)
                same = [
                    xxhash.xxh3_64_intdigest(data[a : b + length], o) - (1 << 63)
                    for a, b, o in zip(first.tolist(), last.tolist(), (anchor - first).tolist())
                ]
                rows.append((h, np.array(same, dtype=np.int64), np.full(len(h), t), first, last - first))
                size += len(h)
                if size > 200_000:
                    yield dict(zip(("h", "same", "t", "at", "span"), map(np.concatenate, zip(*rows))))
                    rows, size = [], 0
            if rows:
                yield dict(zip(("h", "same", "t", "at", "span"), map(np.concatenate, zip(*rows))))

    return map_batches(df.select(text), run, "h long, same long, t long, at long, span long")


def _with_text(df: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """``wanted(id, t, ...)`` with ``packed``, the compressed text of document ``id``."""

    def pack(batches: Iterator) -> Iterator[dict]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data = [_bytes(v) for v in batch.column(1)]
            yield {"d": batch.column(0), "own": [_identity(d) for d in data], "packed": [tool.compress(d) for d in data]}

    texts = map_batches(df.select(F.col(key).cast("long"), text), pack, "d long, own long, packed binary")
    # The second condition passes over other texts under the same id; equal ones come once.
    joined = texts.join(wanted, texts["d"].eqNullSafe(wanted["id"]) & (texts["own"] == wanted["t"]))
    return joined.drop("d", "own").dropDuplicates(["t"])


def repeated_substrings(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """One row per row of ``df``: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    A byte is removed if a string of ``length`` bytes covers it that starts at two
    places of the input, in one text or in two. NULL texts count as empty. Repeated
    rows are texts of their own, so they remove each other. Other columns are ignored.
    Equal texts, grams and stretches are told by 64-bit hashes.
    """
    spark = df.sparkSession
    described = reliable_checkpoint(_described(df, key, text))
    texts = described.groupBy("t").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")
    )
    texts = reliable_checkpoint(texts)
    rows = _stretch_rows(df, text, length, gram)
    # A table of its own, so the join may deal out anew the rows of a gram that comes very often.
    common = reliable_checkpoint(rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h"))
    folder = scratch_path(spark, "stretches")
    rows.join(common, "h", "left_semi").write.parquet(folder)
    shared = spark.read.parquet(folder)
    contents = reliable_checkpoint(shared.groupBy("h", "same").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("t", "at", "span")).alias("one")
    ))
    buckets = contents.groupBy("h").agg(F.count(F.lit(1)).alias("contents"), F.min("c").alias("rarest"))
    open_ = contents.join(reliable_checkpoint(buckets.filter("contents > 1 AND rarest = 1")), "h")
    open_ = open_.select("h", "same", "c", "one.*", (F.col("contents") > MOST_IN_BUCKET).alias("crowded"))
    per_text = open_.groupBy("t").agg(F.collect_list(F.struct("h", "same", "c", "at", "span", "crowded")).alias("parts"))

    def read(batches: Iterator) -> Iterator[dict]:
        tool = zstandard.ZstdDecompressor()
        names = ("h", "same", "c", "at", "span", "crowded")
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out = {n: [] for n in (*names, "t", "body")}
                part = batch.slice(start, 64)
                for t, packed, parts in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data = tool.decompress(packed)
                    for p in parts:
                        for name in names:
                            out[name].append(p[name])
                        out["t"].append(t)
                        out["body"].append(data[p["at"] : p["at"] + p["span"] + length])
                yield out

    fetched = _with_text(df, key, text, per_text.join(texts.select("t", "id"), "t")).select("t", "packed", "parts")
    bodies = reliable_checkpoint(map_batches(
        fetched, read, "h long, same long, c long, at long, span long, crowded boolean, t long, body binary"
    ))

    def sort(bucket: pa.Table) -> pa.Table:
        body = bucket.column("body").to_pylist()
        span = np.array(bucket.column("span"))
        base = np.cumsum([0, *map(len, body[:-1])])
        places = np.concatenate([b + np.arange(s + 1) for b, s in zip(base, span)])
        found = repeated_places(b"".join(body), places, length)
        owner = np.searchsorted(base, found, "right") - 1
        lone = np.array(bucket.column("c")) == 1
        out: dict[str, list] = {"t": [], "lo": [], "hi": []}
        for i in np.unique(owner):
            if lone[i]:
                lo, hi = _runs(found[owner == i] - base[i] + bucket.column("at")[int(i)].as_py())
                out["t"] += [bucket.column("t")[int(i)].as_py()] * len(lo)
                out["lo"] += lo.tolist()
                out["hi"] += hi.tolist()
        return pa.table(out, schema=pa.schema([(n, pa.int64()) for n in ("t", "lo", "hi")]))

    def windows(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            for t, c, at, span, body in zip(*(batch.column(i).to_pylist() for i in range(5))):
                digests = [xxhash.xxh3_128_digest(body[s : s + length]) for s in range(span + 1)]
                yield {"w": digests, "t": [t] * len(digests), "c": [c] * len(digests),
                       "at": list(range(at, at + span + 1))}

    sorted_ = bodies.filter("NOT crowded").groupBy("h").applyInArrow(sort, "t long, lo long, hi long")
    counted = map_batches(
        bodies.filter("crowded").select("t", "c", "at", "span", "body"), windows, "w binary, t long, c long, at long"
    )
    again = counted.groupBy("w").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("w")
    crowded = counted.filter("c = 1").join(again, "w", "left_semi").select("t", F.col("at").alias("lo"), F.col("at").alias("hi"))
    equal = shared.join(contents.filter("c > 1").select("h", "same"), ["h", "same"], "left_semi").select(
        "t", F.col("at").alias("lo"), (F.col("at") + F.col("span")).alias("hi")
    )
    covered = equal.unionByName(sorted_).unionByName(crowded).groupBy("t").agg(
        F.collect_list(F.struct("lo", "hi")).alias("runs")
    )
    single = texts.filter("copies = 1").select("t", "id")

    def cut(batches: Iterator) -> Iterator[dict]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, spans, kept = [], [], []
            for packed, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = tool.decompress(packed)
                rest, end, total, pieces = [], 0, 0, 0
                for lo, hi in sorted((r["lo"], r["hi"] + length) for r in runs):
                    if lo > end or not pieces:
                        rest.append(data[end:lo])
                        pieces += 1
                        total += hi - lo
                        end = hi
                    elif hi > end:
                        total += hi - end
                        end = hi
                rest.append(data[end:])
                removed.append(total)
                spans.append(pieces)
                kept.append(hashlib.sha256(b"".join(rest)).hexdigest())
            yield {"t": batch.column(0), "removed": removed, "spans": spans, "kept": kept}

    partly = _with_text(df, key, text, covered.join(single, "t")).select("t", "packed", "runs")
    verdicts = map_batches(partly, cut, "t long, removed long, spans long, kept string")
    copied = texts.filter((F.col("copies") > 1) & (F.col("n") >= length)).select(
        "t", F.col("n").alias("removed"), F.lit(1).cast("long").alias("spans"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("kept"),
    )
    verdicts = reliable_checkpoint(verdicts.unionByName(copied))
    zero = F.lit(0).cast("long")
    return described.join(verdicts, "t", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_bytes"), F.coalesce("removed", zero).alias("n_removed"),
        F.coalesce("spans", zero).alias("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"),
    )
