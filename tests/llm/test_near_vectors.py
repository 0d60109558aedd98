"""Near-duplicate vectors against brute force where tiles, cells and single precision could go wrong, and what they move."""

import contextlib
import os
import threading

import numpy as np
import pytest

from tidemark.llm import neardup
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.vectors import in_order


@pytest.fixture(autouse=True)
def small_cells(monkeypatch):
    monkeypatch.setattr(neardup, "CELL", 20)


def brute(ids, x):
    """Links and lowest ids by all pairs, in double precision."""
    x = np.asarray(x, float)
    norm = np.sqrt(in_order(x, x))
    link = np.stack([in_order(np.broadcast_to(r, x.shape), x) / (n * norm) >= 0.95 for r, n in zip(x, norm, strict=True)])
    np.fill_diagonal(link, False)
    low, changed = np.array(ids), True
    while changed:
        new = np.where(link, low[None, :], low[:, None]).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(new, low)
        changed, low = (new != low).any(), new
    return {(int(i), int(n), int(r), bool(i == r)) for i, n, r in zip(ids, link.sum(axis=1), low, strict=True)}


def table(spark, ids, x, kind="float", parts=5):
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(parts)


def some(seed, n, dims, groups):
    """Unrelated vectors, and groups around some of them, from copies to ones far over the threshold."""
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dims))
    for g in range(groups):
        at = r.choice(n, 30, replace=False)
        x[at] = x[at[0]] + r.choice([0, 0.01, 0.2, 0.3], (30, 1)) * r.standard_normal((30, dims))
    return r.permutation(n) + 10, x


@pytest.mark.parametrize("dims, kind, tile", [(64, "float", 50), (64, "float", 1 << 17), (25, "double", 50), (2, "double", 50), (1, "float", 50)])
def test_equal_to_brute_force(spark, dims, kind, tile):
    ids, x = some(dims, 500, dims, 8 if dims > 2 else 0)
    x = x.astype(np.float32) if kind == "float" else x
    assert set(map(tuple, near_duplicates(table(spark, ids, x, kind), tile=tile).collect())) == brute(ids, x)


def test_at_the_threshold_double_precision_decides(spark):
    r, pairs = np.random.default_rng(3), []
    for k, off in enumerate([0, 1e-15, -1e-15, 1e-12, -1e-12, 1e-9, -1e-9, 1e-6, -1e-6, 1e-4, -1e-4] * 8):
        a, b = np.linalg.qr(r.standard_normal((64, 2)))[0].T
        c = 0.95 + off
        pairs += [a * (k + 1), (c * a + np.sqrt(1 - c * c) * b) * 1e-3]
    x = np.array(pairs)
    got = set(map(tuple, near_duplicates(table(spark, range(len(x)), x, "double"), tile=60).collect()))
    assert got == brute(range(len(x)), x)
    assert 0 < sum(r[1] for r in got) < len(x)


def test_copies_in_many_tasks_and_batches_are_one_class(spark, settings):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    ids, x = some(9, 60, 32, 2)
    x = np.concatenate([x, x[:20], x[:20], np.repeat(x[:1], 150, axis=0)]).astype(np.float32)
    x[x < -1.5] = 0.0
    x[::3] = np.where(x[::3] == 0, np.float32(-0.0), x[::3])
    for tile in (1 << 17, 10):
        got = near_duplicates(table(spark, range(len(x)), x, parts=9), tile=tile).collect()
        assert set(map(tuple, got)) == brute(range(len(x)), x)


def test_lengths_out_of_range_and_extreme_ones(spark):
    r = np.random.default_rng(4)
    base = r.standard_normal((6, 16))
    x = np.concatenate([base, base * 1e140, base * 1e-140])
    rows = table(spark, range(18), x, "double").union(table(spark, [100, 101], np.array([[1e-200] * 16, [1e200] * 16]), "double"))
    assert set(map(tuple, near_duplicates(rows).collect())) == brute(range(18), x) | {(100, 0, 100, True), (101, 0, 101, True)}


def test_one_large_group(spark):
    r = np.random.default_rng(6)
    x = np.concatenate([r.standard_normal(48) + 0.02 * r.standard_normal((1200, 48)), r.standard_normal((300, 48))]).astype(np.float32)
    got = near_duplicates(table(spark, range(len(x)), x), tile=400).collect()
    assert set(map(tuple, got)) == brute(range(len(x)), x)


def test_vectors_move_once_however_many_tiles_meet(spark):
    tops = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    seen, over = {}, threading.Event()

    def look():  # Spark deletes shuffle files when their tables are gone
        for d, _, names in (x for top in tops for x in os.walk(top)):
            for f in names:
                if f.startswith("shuffle_") and f.endswith(".data"):
                    with contextlib.suppress(OSError):
                        seen[f] = os.path.getsize(os.path.join(d, f))

    def watch():
        while not over.wait(0.05):
            look()

    x = np.random.default_rng(8).standard_normal((4000, 64)).astype(np.float32)
    rows = table(spark, range(len(x)), x).localCheckpoint()
    look()
    before, thread = set(seen), threading.Thread(target=watch)
    thread.start()
    try:
        assert near_duplicates(rows, tile=100).where("n_links > 0").count() == 0
    finally:
        over.set()
        thread.join()
    moved = sum(n for f, n in seen.items() if f not in before)
    assert x.nbytes < moved < 4 * x.nbytes, moved
