"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are put on a sphere first: with ``m`` the largest norm, x becomes (x, sqrt(m^2 - |x|^2)) and a query q becomes
(q m / |q|, 0), so that the largest inner product is the smallest distance. Each table hashes with ``hashes`` projections
floor((a.x + b) / width), a from the normal distribution. A query visits buckets with entries moved by at most one, in
the order of the chance that a neighbour at its own expected distance lies there, until the chances add up to ``success``.
Candidates of all tables are merged and ranked by their exact product.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors import first_of_each, in_order, main_length, matrix, usable

NEAREST, QUERY_EVERY = 20, 20
TABLES, HASHES, WIDTH = 2, 8, 2.4
#: Chance, in each table, that a neighbour's bucket is visited.
SUCCESS = 0.7
#: Rows, at most, in which the expected distance of a query's last neighbour is looked up.
SAMPLE = 2000
#: Rows of a bucket in one block, rows that one task ranks at once (as a mean), and queries it ranks at once.
BLOCK, PART, ASK = 4096, 16384, 256


@dataclass(frozen=True)
class Index:
    """The hash functions; a few kilobytes, the same on every task."""

    largest: float
    a: np.ndarray  # tables x hashes x (dims + 1)
    b: np.ndarray  # tables x hashes

    def lifted(self, x: np.ndarray) -> np.ndarray:
        left = np.sqrt(np.maximum(0.0, self.largest**2 - (x * x).sum(axis=1)))
        return np.column_stack([x, left]) / self.largest

    def turned(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q / np.linalg.norm(q, axis=1)[:, None], np.zeros(len(q))])

    def places(self, x: np.ndarray, table: int) -> np.ndarray:
        """Projections in units of the width; those of unit vectors have variance 1."""
        return x @ self.a[table].T / WIDTH + self.b[table]

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        """One number a row for table and entries, each entry in a byte."""
        return _named(np.floor(self.places(x, table)).astype(np.int64), table)


def _named(entries: np.ndarray, table: int) -> np.ndarray:
    name = np.zeros(entries.shape[:-1], np.uint64)
    for k in range(entries.shape[-1]):
        name = name * np.uint64(0x9E3779B97F4A7C15) + (entries[..., k] + 1000).astype(np.uint64)
    return (name * np.uint64(0xD6E8FEB86659FD93) + np.uint64(table)).view(np.int64)


def _normal_below(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, to about 1e-7 (Abramowitz and Stegun 7.1.26)."""
    z = np.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1 - tail * np.exp(-z * z)
    return 0.5 * (1 + np.sign(x) * erf)


MOVES = np.array(list(product((-1, 0, 1), repeat=HASHES)), np.int64)


def distances(index: Index, queries: np.ndarray, sample: np.ndarray, near: int) -> np.ndarray:
    """Of each query the distance to its ``near``-th neighbour in the lifted ``sample``, which may hold the query itself.

    Among all rows that neighbour can only be nearer, so chances are underestimated and more buckets are visited.
    """
    turned, far = index.turned(queries), np.empty(len(queries))
    nth = min(near, len(sample) - 1)
    for i in range(0, len(queries), 256):
        far[i : i + 256] = np.partition(2 - 2 * (turned[i : i + 256] @ sample.T), nth, axis=1)[:, nth]
    return np.sqrt(np.maximum(1e-6, far))


def probes(
    index: Index, queries: np.ndarray, distance: np.ndarray, table: int, success: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For a few queries at a time: (which query, bucket) of the visited buckets, likeliest first."""
    at = index.places(index.turned(queries), table)
    home = np.floor(at)
    inside = at - home
    step = distance[:, None] / WIDTH  # a projection of the difference, in widths, has this deviation
    edge = lambda x: _normal_below(x / step)
    chance = np.stack(
        [edge(-inside) - edge(-inside - 1), edge(1 - inside) - edge(-inside), edge(2 - inside) - edge(1 - inside)], axis=2
    )
    for lo in range(0, len(queries), 64):
        part = chance[lo : lo + 64]
        odds = np.ones((len(part), len(MOVES)))
        for k in range(HASHES):
            odds *= part[:, k, MOVES[:, k] + 1]
        order = np.argsort(-odds, axis=1, kind="stable")
        total = np.cumsum(np.take_along_axis(odds, order, axis=1), axis=1)
        take = total - np.take_along_axis(odds, order, axis=1) < success
        q, nth = np.nonzero(take)
        entries = home[lo + q].astype(np.int64) + MOVES[order[q, nth]]
        yield lo + q, _named(entries, table)


def fit(rows: DataFrame, dims: int, seed: int = 17) -> tuple[Index, np.ndarray]:
    """Hash functions for ``rows`` (k1, k2, v), and a bounded sample of them, lifted: the ``SAMPLE`` with the smallest hash.

    The largest norm is taken over all rows.
    """
    largest = rows.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0] or 1.0
    sample = [r["v"] for r in rows.orderBy("k1", "k2").select("v").limit(SAMPLE).collect()]
    random = np.random.default_rng(seed)
    a = random.standard_normal((TABLES, HASHES, dims + 1))
    b = random.random((TABLES, HASHES))
    index = Index(float(largest), a, b)
    return index, index.lifted(np.array(sample, np.float64).reshape(len(sample), dims))


def _best(
    rough: np.ndarray, q: np.ndarray, x: np.ndarray, ids: list[list[int]], own: int, near: int
) -> tuple[list[int], list[float]]:
    """The ``near`` best ids of the rows whose rough product is set, with their exact scores."""
    can = np.flatnonzero(rough > -np.inf)
    most = TABLES * (near + 1)  # a row may be met in every table, and one may be the query's own
    if len(can) > most:
        kth = np.partition(rough[can], len(can) - most)[len(can) - most]
        can = can[rough[can] >= kth - 1e-9 * max(1.0, abs(kth))]
    score = in_order(np.broadcast_to(q, (len(can), len(q))), x[can])
    found = sorted({(-s, i) for c, s in zip(can.tolist(), score.tolist(), strict=True) for i in ids[c] if i != own})
    return [i for _, i in found[:near]], [-s for s, _ in found[:near]]


def _ranked(near: int):
    """For partitions sorted by (part, asks): holds a part's rows, then ranks them for the queries that visit them.

    A query without blocks visits the whole part.
    """

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, fresh, rows, blocks, x, block_at = None, True, [], {}, None, {}
        asking: list[dict] = []

        def answered() -> pa.RecordBatch:
            q = np.array([r["v"] for r in asking])
            rough = np.full((len(q), len(x)), -np.inf)
            visits: dict[int, list[int]] = {}
            for i, r in enumerate(asking):
                for b in r["blocks"] or ():
                    visits.setdefault(b, []).append(i)
            everywhere = [i for i, r in enumerate(asking) if r["blocks"] is None]
            if everywhere:
                rough[everywhere] = q[everywhere] @ x.T
            for b, who in visits.items():
                if b in block_at:
                    rough[who, block_at[b]] = q[who] @ x[block_at[b]].T
            out = [[], [], [], [], []]
            for i, r in enumerate(asking):
                ids, scores = _best(rough[i], q[i], x, blocks, r["query_id"], near)
                for col, value in zip(out, (r["query_id"], r["k1"], r["k2"]), strict=False):
                    col += [value] * len(ids)
                out[3] += ids
                out[4] += scores
            asking.clear()
            kinds = [pa.int64()] * 4 + [pa.float64()]
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["query_id", "k1", "k2", "vec_id", "score"]
            )

        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != part:
                    if asking:
                        yield answered()
                    part, rows, x = r["part"], [], None
                if not r["asks"]:
                    rows.append((r["blocks"][0], r["v"], r["ids"]))
                    continue
                if x is None and not rows:
                    continue  # nothing lies in this part
                if x is None:
                    rows.sort(key=lambda r: r[0])
                    names = np.array([r[0] for r in rows], np.int64)
                    x, blocks = np.array([r[1] for r in rows], np.float64).reshape(len(rows), -1), [r[2] for r in rows]
                    at, first = np.unique(names, return_index=True)
                    ends = [*first[1:].tolist(), len(names)]
                    block_at = {int(n): slice(int(i), j) for n, i, j in zip(at, first, ends, strict=True)}
                    rows = []
                asking.append(r)
                if len(asking) >= ASK:
                    yield answered()
        if asking:
            yield answered()

    return rank


def nearest(
    vectors: DataFrame,
    near: int = NEAREST,
    every: int = QUERY_EVERY,
    success: float = SUCCESS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its ``near`` nearest others found.

    Nearness is the largest inner product on the original vectors, added in double precision from the first component
    on; ties go to the smaller id. All other rows are candidates; where fewer exist all come out, and a query that found
    fewer than there are is ranked against all rows. Vectors that are null, empty, zero or hold nulls or non-finite
    numbers, vectors of another length than most and rows without an id take no part. Of equal vectors only the
    ``near + 1`` smallest ids can be among the nearest, so no more enter the index: exact, and a bucket of copies stays
    small. An id on several rows is asked with each of their vectors. An empty table gives an empty one.
    """
    rows = usable(vectors, id_col, vector_col)
    dims = main_length(rows)
    rows = rows.where(F.col("ok") & F.col("vec_id").isNotNull() & (F.size("v") == dims)).drop("ok")
    if not dims:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    classes = stored(first_of_each(rows, near + 1), "classes")
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).withColumnRenamed("vec_id", "query_id")
    asked = stored(asked, "asked")
    index, sample = fit(classes, dims)

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lifted = index.lifted(matrix(batch["v"]))
            for t in range(TABLES):
                yield pa.record_batch({c: batch[c] for c in ("k2", "v", "ids")} | {"bucket": index.buckets(lifted, t)})

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch["v"])
            far = distances(index, x, sample, near) if len(x) else np.empty(0)
            for t in range(TABLES if len(x) else 0):
                for q, bucket in probes(index, x, far, t, success):
                    own = batch.select(["query_id", "k1", "k2"]).take(pa.array(q))
                    yield pa.record_batch([*own.columns, pa.array(bucket)], ["query_id", "k1", "k2", "bucket"])

    placed = stored(classes.mapInArrow(put, "k2 long, v array<double>, ids array<long>, bucket long"), "placed")
    buckets = placed.groupBy("bucket").count()
    buckets = stored(buckets.select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "bucket-sizes")
    parts = max(1, math.ceil(placed.count() / PART))
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part")
    held = placed.join(buckets, "bucket").withColumn("block", F.xxhash64("bucket", F.pmod("k2", "blocks")))
    none = F.lit(None).cast("long")
    held = held.select(
        part, F.lit(False).alias("asks"), none.alias("query_id"), none.alias("k1"), none.alias("k2"), "v", "ids",
        F.array("block").alias("blocks"),
    )
    blocks = buckets.withColumn("nth", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.select("bucket", F.xxhash64("bucket", F.col("nth").cast("long")).alias("block"))

    def ranked(by_part: DataFrame) -> DataFrame:
        """``by_part`` (query_id, k1, k2, part, blocks)."""
        ask_rows = by_part.join(asked.distinct(), ["query_id", "k1", "k2"]).select(
            "part", F.lit(True).alias("asks"), "query_id", "k1", "k2", "v", F.lit(None).cast("array<long>"), "blocks"
        )
        both = held.union(ask_rows).repartition("part").sortWithinPartitions("part", "asks")
        schema = "query_id long, k1 long, k2 long, vec_id long, score double"
        best = both.mapInArrow(_ranked(near), schema).distinct()
        order = Window.partitionBy("query_id", "k1", "k2").orderBy(F.desc("score"), "vec_id")
        return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= near)

    visits = asked.distinct().mapInArrow(ask, "query_id long, k1 long, k2 long, bucket long")
    visits = visits.join(blocks, "bucket").groupBy("query_id", "k1", "k2", part)
    found = stored(ranked(visits.agg(F.collect_list("block").alias("blocks"))), "found")
    some = found.groupBy("query_id", "k1", "k2").count().where(F.col("count") >= min(near, rows.count() - 1))
    lacking = stored(asked.distinct().join(some, ["query_id", "k1", "k2"], "anti").select("query_id", "k1", "k2"), "lacking")
    out = ["query_id", "rank", "vec_id", "score"]
    if lacking.isEmpty():
        return found.select(*out)
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    whole = F.lit(None).cast("array<long>").alias("blocks")
    again = ranked(lacking.select("query_id", "k1", "k2", every_part, whole))
    return found.join(lacking, ["query_id", "k1", "k2"], "anti").select(*out).union(again.select(*out))
