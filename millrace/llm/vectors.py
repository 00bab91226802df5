"""Near-duplicate vectors: exact products, dear ones only where a short sketch leaves room.

Equal vectors are first joined into one with a multiplicity. Unit vectors are dealt
into cells by their nearest of some pivots. A vector also visits every cell before its
own whose pivot is at most 2 r farther than its own, r being the distance of two unit
vectors whose cosine is the threshold: by the triangle inequality two partners meet in
the cell of the one whose cell comes first, and only there.

In a cell, blocks of vectors meet. A sketch of x is its part in a few directions and the
length of the rest; by Cauchy and Schwarz x y is at most the product of the sketches. What
is left is recomputed in double precision. Where much is left, tiles of int8 values go
first: for x = s q + e the product of two vectors differs from that of the q by at most
|e_x| |y| + |x - e_x| |e_y|, so an entry is surely above the threshold, surely below, or
recomputed. Only link counts and, per pair of blocks, a spanning forest leave a task.

Vectors are written twice: shuffled when equal ones are joined, and stored as blocks. The
blocks of a cell that has many, as that of vectors without clusters, meet by a cartesian
product whose tasks read them where they are stored, so no block is written once per
partner. Vectors with clusters are written a third time, to their cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.common import map_batches
from millrace.llm.components import connected_components, local_components
from millrace.session import reliable_checkpoint

THRESHOLD = 0.95
SAMPLE, MOST_PIVOTS = 4_000, 256
# Cells that a sample vector may visit on average, with those after its own; with more, fewer pivots serve better.
MOST_VISITS = 2.5
# A block has at most so many vectors, and so many bytes in double precision.
ROWS_PER_BLOCK, BYTES_PER_BLOCK = 40_960, 20 << 20
# From so many vectors on, those of one cell are dealt to several tasks.
_ROWS_ALONE = 2_000
_STRIP, _WIDTH = 512, 256
# Sketches that leave a larger share of the sample's pairs are made longer.
_LEFT = 2e-5
_SKETCHES = (7, 11, 15, 19, 23, 31, 47, 63, 95, 127)
# Of the pairs of a tile; with more, int8 values go first.
_DENSE = 0.01
_ONE_BY_ONE = 20
# Beyond this, sums of int8 products are not exact in single precision.
_EXACT_DIMENSIONS = 1_000
_ROUNDING, _SINGLE_ROUNDING = 1e-9, 5e-4
# Up to here, sketches made in single precision err by less.
_SINGLE_DIMENSIONS = 128
# Links that wait to be put into a spanning forest.
_MOST_EDGES = 1 << 20
_BLOCK = "d int, cell int, bid long, homes int, rep binary, n binary, unit binary"
_LINKS = "a long, links long, to long"


def rows_per_block(d: int, most: int) -> int:
    return max(1, min(most, BYTES_PER_BLOCK // (8 * d)))


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an array of bytes."""
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def units(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]  # so that squares neither vanish nor overflow
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x


def choose_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Sample vectors far from each other: each next one is the farthest from those before."""
    if not len(sample):
        return sample
    chosen, nearest = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(most, len(sample)):
        far = int(nearest.argmax())
        if nearest[far] < 1e-6:
            break
        chosen.append(far)
        nearest = np.minimum(nearest, np.linalg.norm(sample - sample[far], axis=1))
    return sample[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * x @ pivots.T))


def useful_pivots(sample: np.ndarray, pivots: np.ndarray, reach: float) -> np.ndarray:
    """As many of the pivots as keep the sample's visits few, each moved amid the vectors nearest to it.

    Vectors that visit more than a quarter of the cells are not worth being written to them:
    vectors without clusters are left with one cell.
    """
    while len(pivots) > 1:
        home = _distances(sample, pivots).argmin(axis=1)
        amid = np.zeros_like(pivots)
        np.add.at(amid, home, sample)
        moved = amid / np.maximum(1, np.bincount(home, minlength=len(pivots)))[:, None]
        far = _distances(sample, moved)
        if (far <= far.min(axis=1)[:, None] + reach).sum(axis=1).mean() <= min(MOST_VISITS, max(1, len(pivots) / 4)):
            return moved
        pivots = pivots[: len(pivots) * 3 // 4]
    return pivots


def sketches(raw: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Of vectors made units: the parts along the orthonormal columns of ``basis``, and the length of the rest.

    No product of two sketches is below that of the vectors by more than ``_SINGLE_ROUNDING``.
    """
    if raw.shape[1] > _SINGLE_DIMENSIONS:
        x = units(raw)
    else:
        x = (raw / np.abs(raw).max(axis=1)[:, None]).astype(np.float32)
        x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    part = x @ basis.astype(x.dtype)
    # A root near 0 would make much of a small error, so what it is taken of errs upwards.
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", part, part)) + _SINGLE_ROUNDING)
    return np.concatenate([part, rest[:, None]], axis=1).astype(np.float32)


def sketch_basis(sample: np.ndarray, threshold: float) -> np.ndarray | None:
    """The shortest basis whose sketches tell most pairs of the sample apart; None if whole vectors serve as well."""
    some = sample[:1_000]
    if len(some) < 2:
        return None
    directions = np.linalg.svd(some - some.mean(axis=0), full_matrices=False)[2]
    tried = sample[1_000:2_000] if len(sample) >= 2_000 else some
    linked = (tried @ tried.T >= threshold).sum()
    for size in _SKETCHES:
        if 2 * size > len(directions):
            break
        basis = np.ascontiguousarray(directions[:size].T)
        short = sketches(tried, basis)
        if (short @ short.T >= threshold - _SINGLE_ROUNDING).sum() - linked <= _LEFT * len(tried) ** 2:
            return basis
    return None


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, scale, |x - scale q|) per row, q within int8; errors are rounded up."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(x - scale[:, None] * q, axis=1)
    return q, scale, error * (1 + 1e-9) + 1e-12


class Side:
    """Vectors on one side of a product, with what is made of them once."""

    def __init__(self, raw: np.ndarray, basis: np.ndarray | None) -> None:
        self.raw = raw
        self.short = None if basis is None else sketches(raw, basis)

    @cached_property
    def small(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``quantised``, with the integers as floating point numbers for a fast product."""
        q, scale, error = quantised(units(self.raw))
        return q.astype(np.float32 if q.shape[1] <= _EXACT_DIMENSIONS else np.float64), scale, error


def _tile(x: Side, y: Side, rows: slice, columns: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within a tile by int8 values; products in double precision where these leave doubt."""
    (qx, sx, ex), (qy, sy, ey) = ([v[at] for v in side.small] for side, at in ((x, rows), (y, columns)))
    # No pair of a row can link whose integer product is below this: all bounds and scales at their largest.
    widest = ex + (1 + ex) * ey.max(initial=0) + _ROUNDING
    least = (threshold - widest) / (sx * sy.max(initial=1e-300))
    least = (least - 1e-6 * np.abs(least)).astype(qx.dtype)
    product = qx @ qy.T
    r, c = np.nonzero(product >= least[:, None])
    near = product[r, c].astype(np.float64) * sx[r] * sy[c]
    bound = ex[r] + (1 + ex[r]) * ey[c] + _ROUNDING
    open_ = near + bound >= threshold
    r, c, sure = r[open_], c[open_], (near - bound)[open_] >= threshold
    doubt = np.flatnonzero(~sure)
    sure[doubt] = _linked(x, y, rows.start + r[doubt], columns.start + c[doubt], threshold)
    return rows.start + r[sure], columns.start + c[sure]


def _linked(x: Side, y: Side, r: np.ndarray, c: np.ndarray, threshold: float) -> np.ndarray:
    found = np.empty(len(r), bool)
    for at in range(0, len(r), 65_536):
        part = slice(at, at + 65_536)
        found[part] = np.einsum("ij,ij->i", units(x.raw[r[part]]), units(y.raw[c[part]])) >= threshold
    return found


def _set(flags: np.ndarray, many: int) -> np.ndarray:
    """Where ``many`` flags are set; one after the other if they are few, as a search is faster than a list."""
    if many > _ONE_BY_ONE:
        return np.flatnonzero(flags)
    found, at = [], -1
    for _ in range(many):
        at += 1 + int(flags[at + 1 :].argmax())
        found.append(at)
    return np.array(found)


def tile_links(x: Side, y: Side, threshold: float, upper: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors of ``x`` and ``y`` with a product of at least ``threshold``, some at a time.

    ``upper``: x and y are the same, and only pairs with a larger second index are asked for.
    """
    turned = None if y.short is None else np.ascontiguousarray(y.short.T)
    least = np.float32(threshold - _SINGLE_ROUNDING)
    product, left = np.empty(_STRIP * _WIDTH, np.float32), np.empty(_STRIP * _WIDTH, bool)
    for i in range(0, len(x.raw), _STRIP):
        rows = slice(i, min(i + _STRIP, len(x.raw)))
        few = []
        for j in range(i if upper else 0, len(y.raw), _WIDTH):
            columns = slice(j, min(j + _WIDTH, len(y.raw)))
            wide = columns.stop - j
            size = (rows.stop - i) * wide
            if turned is not None:
                np.matmul(x.short[rows], turned[:, columns], out=product[:size].reshape(-1, wide))
                np.greater_equal(product[:size], least, out=left[:size])
                many = np.count_nonzero(left[:size])
                if not many:
                    continue
                if many <= _DENSE * size:
                    at = _set(left[:size], many)
                    few.append((i + at // wide, j + at % wide))
                    continue
            r, c = _tile(x, y, rows, columns, threshold)
            later = c > r if upper else slice(None)
            if len(r):
                yield r[later], c[later]
        if few:
            r, c = (np.concatenate(side) for side in zip(*few, strict=True))
            if upper:
                r, c = r[c > r], c[c > r]
            linked = _linked(x, y, r, c, threshold)
            yield r[linked], c[linked]


class Block:
    """Vectors of one cell: ``homes`` of them at home, then visitors."""

    def __init__(self, rep: np.ndarray, n: np.ndarray, homes: int, raw: np.ndarray, basis: np.ndarray | None) -> None:
        self.rep, self.n, self.homes = rep, n, homes
        self.parts = Side(raw[:homes], basis), Side(raw[homes:], basis)


def meet(a: Block, b: Block | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, links, to) from the pairs of two blocks, or of one with itself if ``b`` is None; visitors do not meet.

    Every vector that has links gets their count and a vector of its part, which makes a spanning forest.
    """
    own = b is None
    b = b or a
    ids, n = (a.rep, a.n) if own else (np.concatenate([a.rep, b.rep]), np.concatenate([a.n, b.n]))
    counts, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
    new: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def forest() -> np.ndarray:
        left = np.concatenate([np.arange(len(ids)), *(r for r, _ in new)])
        return local_components(len(ids), left, np.concatenate([labels, *(c for _, c in new)]))

    for p, q in [(0, 0), (0, 1)] + [(1, 0)] * (not own):
        left, right = p * a.homes, q * b.homes + (0 if own else len(a.rep))
        for r, c in tile_links(a.parts[p], b.parts[q], threshold, own and q == 0):
            r, c = r + left, c + right
            other = ids[r] != ids[c]
            r, c = r[other], c[other]
            np.add.at(counts, r, n[c])
            np.add.at(counts, c, n[r])
            new.append((r, c))
            waiting += len(r)
            if waiting > _MOST_EDGES:
                labels, waiting = forest(), 0
                new.clear()
    labels = forest()
    linked = np.flatnonzero(counts)
    return ids[linked], counts[linked], ids[labels[linked]]


def _packed(d: int, cell: int, bid: int, homes: int, raw: np.ndarray, **columns: np.ndarray) -> dict:
    """One row of a table of blocks."""
    row = {"d": d, "cell": cell, "bid": bid, "homes": homes, "unit": raw.tobytes()}
    return {k: [v] for k, v in (row | {k: v.astype(np.int64).tobytes() for k, v in columns.items()}).items()}


def _stored(df: DataFrame, most: int, parts: int) -> DataFrame:
    """The distinct vectors of ``df(k1, k2, id, v)`` as stored blocks of vectors of one length."""
    classes = df.groupBy("k1", "k2").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")
    )

    def pack(batches: Iterator) -> Iterator[dict]:
        waiting: dict[int, list[tuple]] = {}
        made = 0

        def block(d: int) -> dict:
            nonlocal made
            made += 1
            k1, k2, rep, n, raw = (np.concatenate(x) for x in zip(*waiting.pop(d), strict=True))
            # Numbered by partition, and stored before anything reads the number.
            bid = (TaskContext.get().partitionId() << 32) + made
            return _packed(d, 0, bid, len(raw), raw, k1=k1, k2=k2, rep=rep, n=n)

        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            ends, values = batch.column(4).offsets.to_numpy(), batch.column(4).values.to_numpy()
            sizes = np.diff(ends)
            for d in map(int, np.unique(sizes)):
                index, room = np.flatnonzero(sizes == d), rows_per_block(d, most)
                for at in range(0, len(index), room):
                    part = index[at : at + room]
                    held = sum(len(x[-1]) for x in waiting.get(d, ()))
                    if held and held + len(part) > room:
                        yield block(d)
                    raw = values[ends[part][:, None] + np.arange(d)]
                    waiting.setdefault(d, []).append((*(x[part] for x in columns), raw))
        for d in list(waiting):
            yield block(d)

    # Vectors whose ids are all NULL have no name to be linked by.
    stored = map_batches(classes.filter("rep IS NOT NULL").coalesce(parts), pack, f"{_BLOCK}, k1 binary, k2 binary")
    return reliable_checkpoint(stored)


def _matrix(data: bytes, kind: type, d: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, d)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


@dataclass
class _Plan:
    """What tasks have to know of the whole table; by number of dimensions where it is a dict."""

    threshold: float
    kind: type  # of stored components
    most: int  # vectors of a block
    reach: float
    pivots: dict[int, np.ndarray]
    bases: dict[int, np.ndarray | None]
    direct: list[int]  # dimensions whose vectors are one cell, and too many for one task
    crowded: dict[tuple[int, int], int]  # cells of several blocks

    def block(self, d: int, homes: int, rep: bytes, n: bytes, unit: bytes) -> Block:
        return Block(_numbers(rep), _numbers(n), homes, _matrix(unit, self.kind, d), self.bases.get(d))


def _plan(stored: DataFrame, counts: dict[int, int], threshold: float, kind: type, most: int) -> _Plan:
    # The hashes are even, so these are about as many vectors as the sample is to have.
    last = -(1 << 63) + min((1 << 64) - 1, (SAMPLE << 64) // max(1, sum(counts.values())))

    def sampled(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                k1, k2 = _numbers(row["k1"]), _numbers(row["k2"])
                at = np.flatnonzero(k1 <= last)
                raw = _matrix(row["unit"], kind, row["d"])[at]
                yield {"d": np.full(len(at), row["d"], np.int32), "k1": k1[at], "k2": k2[at], "unit": _binary(raw)}

    some = map_batches(stored.select("d", "k1", "k2", "unit"), sampled, "d int, k1 long, k2 long, unit binary").collect()
    some.sort(key=lambda r: (r["k1"], r["k2"]))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) * 2 + 1e-9
    plan = _Plan(threshold, kind, most, reach, {}, {}, [], {})
    for d, count in counts.items():
        if own := [r["unit"] for r in some if r["d"] == d][:SAMPLE]:
            sample = units(_matrix(b"".join(own), kind, d))
            chosen = choose_pivots(sample, int(min(MOST_PIVOTS, max(1, count**0.5))))
            plan.pivots[d] = useful_pivots(sample, chosen, reach)
            plan.bases[d] = sketch_basis(sample, threshold)
        if count >= _ROWS_ALONE and len(plan.pivots.get(d, ())) <= 1:
            plan.direct.append(d)
    return plan


def _visits(stored: DataFrame, plan: _Plan) -> DataFrame:
    """A row per vector and cell that it lives in or visits."""

    def visit(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                d, raw = row["d"], _matrix(row["unit"], plan.kind, row["d"])
                rep, n, spread = _numbers(row["rep"]), _numbers(row["n"]), _numbers(row["k1"]).view(np.uint64)
                # Lengths that the sample has not met make one cell each.
                own = plan.pivots.get(d, np.zeros((1, d)))
                parts = np.array([plan.crowded.get((d, c), 1) for c in range(len(own))], np.uint64)
                for start in range(0, len(raw), 1_024):
                    x = units(raw[start : start + 1_024])
                    far = _distances(x, own)
                    home = far.argmin(axis=1)
                    near = far <= far.min(axis=1)[:, None] + plan.reach + 1e-7
                    r, cell = np.nonzero(near & (np.arange(len(own)) <= home[:, None]))
                    at = start + r
                    yield {
                        "d": np.full(len(r), d, np.int32), "cell": cell.astype(np.int32),
                        "block": (spread[at] % parts[cell]).astype(np.int32), "home": home[r] == cell,
                        "rep": rep[at], "n": n[at], "unit": _binary(raw[at]),
                    }

    return map_batches(stored, visit, "d int, cell int, block int, home boolean, rep long, n long, unit binary")


def _in_cells(visits: DataFrame, plan: _Plan) -> DataFrame:
    """The links of cells of one block, and the blocks of the others."""
    schema = f"{_LINKS}, {_BLOCK}"
    fields = to_arrow_schema(T._parse_datatype_string(schema))

    def in_cell(tile: pa.Table) -> pa.Table:
        d, cell, bid = (tile.column(c)[0].as_py() for c in ("d", "cell", "block"))
        home = np.array(tile.column("home"))
        order = np.argsort(~home, kind="stable")
        rep, n = (np.array(tile.column(c))[order] for c in ("rep", "n"))
        raw, homes = _matrix(b"".join(tile.column("unit").to_pylist()), plan.kind, d)[order], int(home.sum())
        if (d, cell) in plan.crowded:
            found = _packed(d, cell, bid, homes, raw, rep=rep, n=n)
        else:
            a, count, to = meet(Block(rep, n, homes, raw, plan.bases.get(d)), None, plan.threshold)
            found = {"a": a, "links": count, "to": to}
        size = len(next(iter(found.values())))
        return pa.table([pa.array(found[f.name], f.type) if f.name in found else pa.nulls(size, f.type) for f in fields], schema=fields)

    return visits.groupBy("d", "cell", "block").applyInArrow(in_cell, schema)


def _unpacked(stored: DataFrame) -> DataFrame:
    """A row per distinct vector, without the vector."""
    names = ["k1", "k2", "rep", "n"]

    def rows(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                yield {c: _numbers(row[c]) for c in names}

    return map_batches(stored.select(names), rows, ", ".join(f"{c} long" for c in names))


def _in_pairs(blocks: DataFrame, parts: int, plan: _Plan) -> DataFrame:
    """The links between all blocks of a cell, and within each; tasks read the blocks where they are stored."""
    one, names = blocks.coalesce(parts), blocks.columns
    x, y = (one.select(F.struct(*names).alias(side)) for side in "xy")
    meeting = (F.col("x.d") == F.col("y.d")) & (F.col("x.cell") == F.col("y.cell")) & (F.col("x.bid") <= F.col("y.bid"))
    pairs = x.hint("shuffle_replicate_nl").join(y, meeting)

    def in_pair(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            sides = [dict(zip(names, batch.column(i).flatten(), strict=True)) for i in range(2)]
            for i in range(batch.num_rows):
                x, y = (
                    [*(side[c][i].as_py() for c in ("bid", "d", "homes")), *(side[c][i].as_buffer() for c in ("rep", "n", "unit"))]
                    for side in sides
                )
                other = None if x[0] == y[0] else plan.block(*y[1:])
                yield dict(zip(("a", "links", "to"), meet(plan.block(*x[1:]), other, plan.threshold), strict=True))

    # A batch holds some blocks at most: spark.sql.execution.arrow.maxBytesPerBatch is 64 MB if nobody changes it.
    return map_batches(pairs, in_pair, _LINKS)


def links(df: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per row of ``df``: key, ``n_links``, ``component_id``, ``kept``.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components link with
    nothing: 0 links, their own component. So do those of another length, and those without
    a key. Repeated rows count as vectors of their own. Other columns are ignored.
    ``threshold`` must be above 0; an empty table gives no rows.
    """
    single = df.schema[vector].dataType.elementType == T.FloatType()
    v = F.col("v").cast("array<double>")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    usable = F.coalesce((F.size("v") > 0) & finite & F.exists(v, lambda e: e != 0), F.lit(False))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    keyed = rows.select(
        "id", F.when(usable, F.xxhash64("v")).alias("k1"), F.when(usable, F.xxhash64(F.lit(1), "v")).alias("k2"), "v"
    )
    cores, most = df.sparkSession.sparkContext.defaultParallelism, ROWS_PER_BLOCK
    given, components = rows.agg(F.count(F.lit(1)), F.sum(F.greatest(F.size("v"), F.lit(0)))).first()
    distinct = keyed.filter("k1 IS NOT NULL").withColumn("v", F.col("v") if single else v)
    parts = max(1, -(-given // most), -(-8 * (components or 0) // BYTES_PER_BLOCK), min(cores, given // _ROWS_ALONE))
    stored = _stored(distinct, most, parts)
    counts = {r["d"]: r["n"] for r in stored.groupBy("d").agg(F.sum("homes").alias("n")).collect()}
    plan = _plan(stored, counts, threshold, np.float32 if single else np.float64, most)

    found, blocks, parts = [], [], cores
    direct = F.col("d").isin(plan.direct)
    if plan.direct:
        blocks.append(stored.filter(direct))
        parts += sum(-(-counts[d] // rows_per_block(d, most)) for d in plan.direct)
    if len(plan.direct) < len(counts):
        others = stored.filter(~direct)
        # No cell has more vectors than there are of its length.
        rooms = {d: room for d in counts if d not in plan.direct and counts[d] > (room := rows_per_block(d, most))}
        if rooms:
            crowd = _visits(others.filter(F.col("d").isin(list(rooms))), plan).groupBy("d", "cell").count()
            for r in crowd.filter(F.col("count") > min(rooms.values())).collect():
                if r["count"] > rooms[r["d"]]:
                    plan.crowded[r["d"], r["cell"]] = -(-r["count"] // rooms[r["d"]])
        cells = reliable_checkpoint(_in_cells(_visits(others, plan), plan))
        found.append(cells.filter("a IS NOT NULL").select("a", "links", "to"))
        if plan.crowded:
            blocks.append(cells.filter("a IS NULL"))
            parts += sum(plan.crowded.values())
    if blocks:
        meeting = reduce(DataFrame.unionByName, [b.select("d", "cell", "bid", "homes", "rep", "n", "unit") for b in blocks])
        found.append(reliable_checkpoint(_in_pairs(meeting, parts, plan)))
    if not found:
        found.append(df.sparkSession.createDataFrame([], _LINKS))
    forest = reduce(DataFrame.unionByName, found)
    linked = forest.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "rep")
    parts_of = connected_components(forest, "a", "to").withColumnRenamed("node", "rep")
    # A class without links and of one row needs no row of its own here.
    classes = _unpacked(stored).join(linked, "rep", "left").join(parts_of, "rep", "left").filter("n > 1 OR links IS NOT NULL")
    classes = reliable_checkpoint(classes.select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    ))
    component = F.coalesce("component", "id")
    return keyed.select("id", "k1", "k2").join(classes, ["k1", "k2"], "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("id") == component).alias("kept"),
    )
