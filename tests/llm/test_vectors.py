"""Near-duplicate vectors against all pairs: in blocks, in cells, in crowded cells, and what they write."""

import gc
import os
import time

import numpy as np
import pytest

pytest.importorskip("xxhash")

from millrace.llm import vectors
from millrace.llm.components import local_components

SCHEMA = "vec_id long, embedding array<float>"


def table_of(spark, x, ids=None, kind="float"):
    ids = range(len(x)) if ids is None else ids
    rows = [(None if i is None else int(i), v) for i, v in zip(ids, x.tolist(), strict=True)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def all_pairs(x, threshold=0.95):
    """(n_links, component) per row, whose keys are the places."""
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    r, c = np.nonzero(linked)
    return linked.sum(axis=1), local_components(len(x), r, c)


def agrees(spark, x, kind="float"):
    counts, parts = all_pairs(x.astype(np.float32).astype(np.float64) if kind == "float" else x)
    got = sorted(tuple(r) for r in vectors.links(table_of(spark, x, kind=kind)).collect())
    assert got == [(i, int(counts[i]), int(parts[i]), int(parts[i]) == i) for i in range(len(x))]
    return int(counts.sum())


def scattered(n, seed, d=64):
    """Vectors without clusters, a group of near copies, and exact copies of one."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    some = rng.permutation(n)[: n // 20]
    x[some] = x[some[0]] + 0.15 * rng.normal(size=(len(some), d))
    x[rng.permutation(n)[: n // 50]] = x[some[1]]
    return x


def clustered(n, seed, d=16, groups=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    return centres[rng.integers(0, groups, n)] + 0.05 * rng.normal(size=(n, d))


def written(spark):
    """Bytes that the session has in its local folders."""
    found = 0
    for folder in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for at, _, names in os.walk(folder.getPath()):
            for name in names:
                try:
                    found += os.path.getsize(os.path.join(at, name))
                except OSError:
                    pass
    return found


def test_vectors_without_clusters_are_not_written_once_per_block(spark, monkeypatch):
    """Before, every block was shuffled to all others: 30 times each vector's doubles here, and n / 8,000 at size."""
    monkeypatch.setattr(vectors, "ROWS_PER_BLOCK", 200)
    x = scattered(3_000, 1)
    df = table_of(spark, x)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(1)
    before = written(spark)
    assert vectors.links(df).count() == len(x)
    assert written(spark) - before < 8 * x.astype(np.float32).nbytes


@pytest.mark.parametrize("kind", ["float", "double"])
def test_blocks_meet(spark, monkeypatch, kind):
    monkeypatch.setattr(vectors, "ROWS_PER_BLOCK", 300)
    assert agrees(spark, scattered(2_500, 2), kind) > 1_000


def test_cells_meet(spark, monkeypatch):
    made = []
    monkeypatch.setattr(vectors, "_in_cells", lambda *a, f=vectors._in_cells: made.append(a[1]) or f(*a))
    assert agrees(spark, clustered(1_500, 3)) > 1_000
    assert made and len(made[0].pivots[16]) > 8 and not made[0].crowded


def test_crowded_cells_meet(spark, monkeypatch):
    made = []
    monkeypatch.setattr(vectors, "_in_cells", lambda *a, f=vectors._in_cells: made.append(a[1]) or f(*a))
    monkeypatch.setattr(vectors, "ROWS_PER_BLOCK", 60)
    assert agrees(spark, clustered(1_500, 4)) > 1_000
    assert made and made[0].crowded


def test_lengths_do_not_meet(spark):
    x, y = clustered(200, 5), clustered(200, 5)[:, :15]
    rows = [(i, v) for i, v in enumerate(x.tolist() + y.tolist())]
    got = {r["vec_id"]: r for r in vectors.links(spark.createDataFrame(rows, SCHEMA)).collect()}
    for part, start in ((x, 0), (y, 200)):
        counts, parts = all_pairs(part.astype(np.float32).astype(np.float64))
        assert [(got[start + i]["n_links"], got[start + i]["component_id"]) for i in range(200)] == [
            (int(n), int(p) + start) for n, p in zip(counts, parts, strict=True)
        ]


def test_rows_without_keys_and_repeated_keys(spark):
    """A vector without a key links with nothing; before, such a row ended the run."""
    rng = np.random.default_rng(6)
    near = rng.normal(size=16) + 0.05 * rng.normal(size=(3, 16))
    far = rng.normal(size=(2, 16))
    rows = [(1, near[0]), (2, near[1]), (None, near[2]), (None, far[0]), (3, far[1]), (3, far[1])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = sorted((tuple(r) for r in vectors.links(df).collect()), key=str)
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (3, 1, 3, True), (None, 0, None, None), (None, 0, None, None)]


@pytest.mark.parametrize("x", [scattered(1_500, 7), clustered(1_500, 8), clustered(1_500, 9, 64, 2)], ids=["few", "some", "many"])
def test_tiles_find_all_pairs(x):
    """With sketches, without, and where a tile is mostly links."""
    x = vectors.units(x)
    want = x @ x.T >= 0.95
    for basis in (None, vectors.sketch_basis(x, 0.95), np.linalg.qr(np.random.default_rng(1).normal(size=(x.shape[1], 5)))[0]):
        side = vectors.Side(x, basis)
        for upper in (False, True):
            found = np.zeros_like(want)
            for r, c in vectors.tile_links(side, side, 0.95, upper):
                assert not found[r, c].any()
                found[r, c] = True
            assert (found == (np.triu(want, 1) if upper else want)).all()


def test_sketches_never_fall_below_the_product():
    x = vectors.units(scattered(800, 10))
    basis = vectors.sketch_basis(x, 0.95)
    assert basis is not None and np.allclose(basis.T @ basis, np.eye(basis.shape[1]))
    short = vectors.sketches(x, basis)
    assert (short @ short.T + vectors._SINGLE_ROUNDING >= x @ x.T).all()


def test_pivots_that_do_not_part_vectors_are_left_out():
    """Written to cells, such vectors would be on disk once or twice more, and no pair less would be looked at."""
    x = vectors.units(scattered(2_000, 11))
    reach = 2 * float(np.sqrt(0.1))
    assert len(vectors.useful_pivots(x, vectors.choose_pivots(x, 64), reach)) == 1
    y = vectors.units(clustered(2_000, 12))
    assert len(vectors.useful_pivots(y, vectors.choose_pivots(y, 40), reach)) > 8


def test_forest_of_many_links(monkeypatch):
    """Waiting links are put into the forest now and then; the parts stay the same."""
    monkeypatch.setattr(vectors, "_MOST_EDGES", 100)
    x = clustered(600, 13)
    counts, parts = all_pairs(x)
    half = [vectors.Block(np.arange(s.start, s.stop), np.ones(300, np.int64), 300, x[s], None) for s in (slice(0, 300), slice(300, 600))]
    total, left, right = np.zeros(600, np.int64), [], []
    for pair in ((half[0], None), (half[0], half[1]), (half[1], None)):
        a, n, to = vectors.meet(*pair, 0.95)
        total[a] += n
        left.append(a)
        right.append(to)
    assert (total == counts).all()
    assert (local_components(600, np.concatenate(left), np.concatenate(right)) == parts).all()
