"""Near-duplicate vectors by comparing tiles of cells in the order of principal components.

Unit vectors are rotated to principal axes, which puts most of a product into the leading dimensions. Some of them are
pivots, every row belongs to the cell of the pivot nearest to it, and cells that lie together form tiles of bounded
size. Two unit vectors with cosine ``c`` are ``sqrt(2 - 2c)`` apart, so a tile meets only tiles whose box, over all
axes, is that near; and their angle is ``acos(c)``, so two rows meet only if their angles to the pivot of either one
differ by at most that. For what is left, products accumulate over blocks of leading dimensions; what the rest can add
is at most the product of the two suffix norms, and a pair is given up as soon as it cannot reach the threshold. All of
this is done in single precision with a bound on its error; pairs within that bound of the threshold are decided on the
original vectors in double precision.

Vectors are shuffled to their tiles once. A tile is a file in the shared folder, and the tasks that compare tiles read
them there: pairs of tiles, whose number grows with the square of the table, move as pairs of names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import even_labels, shared_path, stored
from tidemark.llm.graph import components
from tidemark.llm.vectors import in_order, main_length, matrix, usable

THRESHOLD = 0.95
#: Vectors in a tile at most, in a tile where the table allows it, and tiles of a table that is large enough.
TILE, LEAST_TILE, TILES = 1 << 17, 2048, 48
#: Tiles that one task compares with its own.
TOGETHER = 8
#: Numbers in a tile, in the pivots, and in the part of another tile that is held at a time, at most.
TILE_SIZE, PIVOTS_SIZE, SLICE_SIZE = 1 << 23, 1 << 22, 1 << 21
#: Vectors in a cell on the mean.
CELL = 2048
#: Rows of a cell, and rows of another tile's cell, that are compared at a time.
STRIP, ACROSS = 512, 1024
#: Dimensions added at a time.
LEADING = 24


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; zeros where the length is zero or not finite."""
    x = np.asarray(x, np.float64)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        return np.where(((norm > 0) & np.isfinite(norm))[:, None], x / norm[:, None], 0.0)


def margin(dims: int) -> float:
    """What single precision may be wrong by in a product of two rotated unit vectors, at most."""
    return (dims + 16) * math.sqrt(dims) * 2.0**-22


def principal_axes(rows: DataFrame, dims: int) -> np.ndarray:
    """Columns are the eigenvectors of the mean outer product, largest eigenvalue first.

    Tasks add up their own rows; the driver gets dims x dims sums.
    """

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = matrix(batch["v"])
            if len(x):
                x = unit(x)
                total += x.T @ x
        yield pa.record_batch({"at": pa.array(range(dims * dims), pa.int32()), "x": pa.array(total.ravel())})

    found = rows.select("v").mapInArrow(sums, "at int, x double").groupBy("at").agg(F.sum("x").alias("x"))
    outer = np.zeros(dims * dims)
    for row in found.collect():
        outer[row["at"]] = row["x"]
    values, axes = np.linalg.eigh(outer.reshape(dims, dims))
    return axes[:, np.argsort(-values, kind="stable")]


def pivots_of(rows: DataFrame, axes: np.ndarray, n: int) -> np.ndarray:
    """Unit vectors of some of the ``n`` distinct vectors, by their hash; near ones follow each other, in the order of the
    first axis.

    One for each cell comes to the driver. Any choice gives the same pairs.
    """
    most = max(1, min(n // CELL, PIVOTS_SIZE // len(axes)))
    some = rows.where(F.col("k1") < F.lit(2**64 * most // n - 2**63)) if most < n else rows
    some = some.groupBy("k1", "k2").agg(F.first("v").alias("v")).select("v")
    x = matrix(some.toArrow()["v"].combine_chunks())
    x = np.unique(unit(x), axis=0) if len(x) else x.reshape(0, len(axes))
    x = x[x.any(axis=1)] if x.any() else np.eye(1, len(axes))
    z = x @ axes
    heads = z[:: max(1, math.isqrt(len(z)))]
    near = np.argmax(z @ heads.T, axis=1)
    return x[np.lexsort((z[:, 0], near, heads[near, 0]))]


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """Unit vectors in whole numbers whose products single precision adds without an error, in any order: equal vectors
    get equal products in every task."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return np.rint(x / np.sqrt(in_order(x, x))[:, None] * 2048).astype(np.float32)


def tile_table(rows: DataFrame, axes: np.ndarray, pivots: np.ndarray, path: str, tile: int, n: int) -> DataFrame:
    """(tile, lo, hi, low, high, rows, file): one row a tile, ``low`` and ``high`` its box over all axes.

    The file has ids, counts and cells of distinct vectors and then the vectors, by cell and from its pivot outwards. Its
    name is new in each attempt, and only names that Spark commits are read. Equal vectors get one cell and so one tile,
    where they become one; a task sends one of those that it reads together. Vectors without a length are in no tile.
    """
    dims, whole_pivots = len(axes), whole_numbers(pivots).T
    size = max(1, min(tile, max(LEAST_TILE, n // TILES), TILE_SIZE // dims))
    parts, count = math.ceil(n / size), len(pivots)
    label = np.array(even_labels(rows.sparkSession, parts), np.int32)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 21) // count)
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            order = np.lexsort((k2, k1))
            new = np.ones(len(order), bool)
            new[1:] = (k1[order[1:]] != k1[order[:-1]]) | (k2[order[1:]] != k2[order[:-1]])
            first = order[new]
            batch = batch.take(pa.array(first))
            x = matrix(batch["v"])
            if not len(x):
                continue
            q = whole_numbers(x)
            cell = np.concatenate([(q[at : at + step] @ whole_pivots).argmax(axis=1) for at in range(0, len(q), step)])
            out = {"part": label[cell * parts // count], "cell": cell.astype(np.int32), "k1": batch["k1"], "k2": batch["k2"]}
            out |= {"n": np.diff(np.flatnonzero(np.append(new, True))), "v": batch["v"]}
            yield pa.record_batch(out).filter(pa.array(unit(x).any(axis=1)))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        files.create_dir(root, recursive=True)
        ids, ns, cells, vs, held, now, last = [], [], [], [], 0, None, None

        def row() -> pa.RecordBatch:
            name, products = uuid.uuid4().hex, []
            low, high = np.full(dims, np.inf), np.full(dims, -np.inf)
            for x, cell in zip(vs, cells, strict=True):
                u = unit(x)
                products.append(np.einsum("ij,ij->i", u, pivots[cell]))
                z = u @ axes
                low, high = np.minimum(low, z.min(axis=0)), np.maximum(high, z.max(axis=0))
            order = np.lexsort((-np.concatenate(products), np.concatenate(cells)))
            with files.open_output_stream(f"{root}/{name}") as out:
                for x in (ids, ns, cells, vs):
                    out.write(np.concatenate(x)[order].data)
            return pa.record_batch(
                {
                    "tile": pa.array([int(ids[0][0])], pa.int64()),
                    "lo": pa.array([low[0]]),
                    "hi": pa.array([high[0]]),
                    "low": pa.array([low.tolist()]),
                    "high": pa.array([high.tolist()]),
                    "rows": pa.array([held], pa.int64()),
                    "file": pa.array([name]),
                }
            )

        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch["k1"].to_numpy(), batch["k2"].to_numpy()])
            before = keys[:, :1] + 1 if last is None else last
            new = (keys != np.concatenate([before, keys[:, :-1]], axis=1)).any(axis=0)
            last, n = keys[:, -1:], batch["n"].to_numpy()
            starts = np.flatnonzero(new)
            more = starts[0] if len(starts) else len(n)
            if more:
                ns[-1][-1] += n[:more].sum()
            if not len(starts):
                continue
            n, part, cell = np.add.reduceat(n, starts), batch["part"].to_numpy()[starts], batch["cell"].to_numpy()[starts]
            v = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)[starts]
            at = 0
            while at < len(part):
                if held and (part[at] != now or held == size):
                    yield row()
                    ids, ns, cells, vs, held = [], [], [], [], 0
                now = part[at]
                end = min(at + int(np.searchsorted(part[at:], now, "right")), at + size - held)
                ids.append(keys[0, starts[at:end]])
                ns.append(n[at:end])
                cells.append(cell[at:end])
                vs.append(v[at:end])
                held += end - at
                at = end
        if held:
            yield row()

    kind = rows.schema["v"].dataType.simpleString()
    dealt = rows.select("k1", "k2", "v").mapInArrow(deal, f"part int, cell int, k1 long, k2 long, n long, v {kind}")
    schema = "tile long, lo double, hi double, low array<double>, high array<double>, rows long, file string"
    return dealt.repartition(parts, "part").sortWithinPartitions("part", "cell", "k1", "k2").mapInArrow(pack, schema)


@dataclass
class Rows:
    """Rows of a tile from place ``at`` on, with what is compared of them."""

    at: int
    ids: np.ndarray
    n: np.ndarray
    cells: np.ndarray
    v: np.ndarray
    z: np.ndarray
    #: Suffix norms behind each block of dimensions; the first block, and the first of these norms.
    rest: list[np.ndarray]
    lead: np.ndarray


def cuts_of(dims: int) -> list[int]:
    return [*range(0, dims, LEADING), dims]


def slices(files, name: str, rows: int, turn: np.ndarray, kind: str, most: int) -> Iterator[Rows]:
    """A tile's file, ``most`` rows at a time."""
    dims = len(turn)
    width, cuts = np.dtype(kind).itemsize * dims, cuts_of(dims)
    with files.open_input_file(name) as f:
        for at in range(0, rows, most):
            m = min(most, rows - at)
            ids = np.frombuffer(f.read_at(8 * m, 8 * at), np.int64)
            n = np.frombuffer(f.read_at(8 * m, 8 * (rows + at)), np.int64)
            cells = np.frombuffer(f.read_at(4 * m, 16 * rows + 4 * at), np.int32)
            v = np.frombuffer(f.read_at(width * m, 20 * rows + width * at), kind).reshape(m, dims)
            z = unit(v).astype(np.float32) @ turn
            rest = [np.sqrt(np.einsum("ij,ij->i", z[:, c:], z[:, c:])) for c in cuts[1:]]
            yield Rows(at, ids, n, cells, v, z, rest, np.concatenate([z[:, : cuts[1]], rest[0][:, None]], axis=1))


def whole(files, name: str, rows: int, turn: np.ndarray, kind: str) -> Rows:
    parts = list(slices(files, name, rows, turn, kind, max(1, SLICE_SIZE // len(turn))))
    rest = [np.concatenate(x) for x in zip(*(p.rest for p in parts), strict=True)]
    ids, n, cells, v, z, lead = (np.concatenate([getattr(p, x) for p in parts]) for x in ("ids", "n", "cells", "v", "z", "lead"))
    return Rows(0, ids, n, cells, v, z, rest, lead)


@dataclass
class Strips:
    """Rows of one cell each, from ``start`` to ``end``; ``pivot`` counts the ``pivots`` of all. Other rows can be near
    them only with a product with the pivot between ``least`` and ``most``."""

    pivots: np.ndarray
    start: np.ndarray
    end: np.ndarray
    pivot: np.ndarray
    least: np.ndarray
    most: np.ndarray


def strips_of(own: Rows, pivots: np.ndarray, threshold: float, size: int) -> Strips:
    error, n = margin(pivots.shape[1]), len(own.ids)
    cells, first = np.unique(own.cells, return_index=True)
    ends = [*first[1:], n]
    start = np.concatenate([np.arange(a, b, size) for a, b in zip(first, ends, strict=True)])
    pivot = np.searchsorted(first, start, "right") - 1
    product = np.einsum("ij,ij->i", own.z, pivots[own.cells]).astype(np.float64)
    angle = lambda x: np.arccos(np.clip(x, -1, 1))
    reach = angle(threshold - error)
    furthest = angle(np.minimum.reduceat(product, start) - error)
    nearest = angle(np.maximum.reduceat(product, start) + error)
    least = np.cos(np.minimum(furthest + reach, np.pi)) - error
    most = np.cos(np.maximum(nearest - reach, 0)) + error
    end = np.minimum(start + size, np.array(ends)[pivot])
    return Strips(pivots[cells], start, end, pivot, least.astype(np.float32), most.astype(np.float32))


def decided(own: Rows, other: Rows, i: np.ndarray, j: np.ndarray, about: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each pair reaches the threshold; ``about`` is its cosine in single precision."""
    near = about >= threshold
    doubt = np.flatnonzero(np.abs(about - threshold) <= margin(own.z.shape[1]))
    if len(doubt):
        x, y = own.v[i[doubt]].astype(np.float64), other.v[j[doubt]].astype(np.float64)
        near[doubt] = in_order(x, y) / (np.sqrt(in_order(x, x)) * np.sqrt(in_order(y, y))) >= threshold
    return near


def close_pairs(
    own: Rows, strips: Strips, other: Rows, across: Strips, threshold: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) in both with cosine at or over the threshold; of a tile with itself only i < j.

    Of two strips, those rows meet that each of the two pivots allows.
    """
    cuts, limit = cuts_of(own.z.shape[1]), np.float32(threshold - margin(own.z.shape[1]))
    there, here = strips.pivots @ other.z.T, across.pivots @ own.z.T
    for s in range(len(strips.start)):
        a, b = strips.start[s], strips.end[s]
        behind = max(0, a + 1 - other.at) if same else 0
        product = there[strips.pivot[s], behind:]
        met = np.flatnonzero((product >= strips.least[s]) & (product <= strips.most[s])) + behind
        if not len(met):
            continue
        theirs, product = other.lead.take(met, axis=0), here[across.pivot, a:b]
        mine = (product >= across.least[:, None]) & (product <= across.most[:, None])
        ends = np.append(np.searchsorted(met, across.start), len(met))
        for t in np.flatnonzero((ends[1:] > ends[:-1]) & mine.any(axis=1)):
            rows, some = np.flatnonzero(mine[t]) + a, met[ends[t] : ends[t + 1]]
            so_far = own.lead.take(rows, axis=0) @ theirs[ends[t] : ends[t + 1]].T
            hit = np.flatnonzero(so_far >= limit)
            if not len(hit):
                continue
            if 16 * len(hit) > so_far.size:
                so_far = own.z.take(rows, axis=0) @ other.z.take(some, axis=0).T
                hit = np.flatnonzero(so_far >= limit)
                i, j, so_far = rows[hit // len(some)], some[hit % len(some)], so_far.ravel()[hit]
            else:
                i, j = rows[hit // len(some)], some[hit % len(some)]
                so_far = so_far.ravel()[hit] - own.rest[0][i] * other.rest[0][j]
                for k in range(1, len(cuts) - 1):
                    part = slice(cuts[k], cuts[k + 1])
                    so_far = so_far + np.einsum("ij,ij->i", own.z[i, part], other.z[j, part])
                    left = so_far + own.rest[k][i] * other.rest[k][j] >= limit
                    i, j, so_far = i[left], j[left], so_far[left]
            if same:
                ahead = j + other.at > i
                i, j, so_far = i[ahead], j[ahead], so_far[ahead]
            near = decided(own, other, i, j, so_far, threshold)
            if near.any():
                yield i[near], j[near]


def _lowest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the lowest that the pairs connect it with."""
    low = np.arange(n)
    while True:
        new = low.copy()
        m = np.minimum(low[i], low[j])
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


class Groups:
    """Groups of ``n`` places by the pairs added so far; pairs within a group are not kept."""

    def __init__(self, n: int):
        self.low, self.pairs, self.held = np.arange(n), [], 0

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        i, j = self.low[i], self.low[j]
        new = i != j
        self.pairs.append((i[new], j[new]))
        self.held += int(new.sum())
        if self.held > 1 << 18:
            self.lowest()

    def lowest(self) -> np.ndarray:
        if self.held:
            i, j = (np.concatenate(x) for x in zip(*self.pairs, strict=True))
            self.low = _lowest(len(self.low), self.low[i], self.low[j])[self.low]
        self.pairs, self.held = [], 0
        return self.low


def tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """(i, j) tiles whose boxes are near enough, each pair once and every tile with itself.

    Tiles meet over cells of the first axis as wide as the reach, so this is a join on cells, not on all pairs.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    cell = lambda x: F.floor(x / reach)
    i = tiles.select(*[F.col(c).alias(f"{c}_i") for c in ("tile", "lo", "hi", "low", "high")])
    i = i.withColumn("cell", F.explode(F.sequence(cell(F.col("lo_i")), cell(F.col("hi_i") + reach))))
    j = tiles.select(*[F.col(c).alias(f"{c}_j") for c in ("tile", "lo", "low", "high")])
    j = j.withColumn("cell", cell(F.col("lo_j")))
    order = F.struct("lo_i", "tile_i") <= F.struct("lo_j", "tile_j")
    above = F.zip_with("low_j", "high_i", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    below = F.zip_with("low_i", "high_j", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    gap = F.aggregate(F.zip_with(above, below, lambda x, y: x * x + y * y), F.lit(0.0), lambda s, x: s + x)
    near = i.join(j, "cell").where(order & (gap <= reach * reach))
    return near.select(F.col("tile_i").alias("i"), F.col("tile_j").alias("j"))


def tile_links(
    tiles: DataFrame, path: str, axes: np.ndarray, pivots: np.ndarray, threshold: float, kind: str
) -> DataFrame:
    """(cid, links, root): per compared pair of tiles, each row with links, how many vectors they add, and a row that
    the tile pair's links connect it with."""
    turn, pivots = axes.astype(np.float32), (pivots @ axes).astype(np.float32)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        most, held = max(1, SLICE_SIZE // len(turn)), None
        for batch in batches:
            for row in batch.to_pylist():
                if held != row["file_i"]:
                    held = row["file_i"]
                    own = whole(files, f"{root}/{held}", row["rows_i"], turn, kind)
                    strips = strips_of(own, pivots, threshold, STRIP)
                same = row["i"] == row["j"]
                shift = 0 if same else row["rows_i"]
                groups = Groups(shift + row["rows_j"])
                links, ids = np.zeros(shift + row["rows_j"], np.int64), [] if same else [own.ids]
                for other in slices(files, f"{root}/{row['file_j']}", row["rows_j"], turn, kind, most):
                    ids.append(other.ids)
                    across = strips_of(other, pivots, threshold, ACROSS)
                    for i, j in close_pairs(own, strips, other, across, threshold, same):
                        place = j + (shift + other.at)
                        np.add.at(links, i, other.n[j])
                        np.add.at(links, place, own.n[i])
                        groups.add(i, place)
                has = np.flatnonzero(links)
                if len(has):
                    ids = np.concatenate(ids)
                    yield pa.record_batch({"cid": ids[has], "links": links[has], "root": ids[groups.lowest()[has]]})

    nth = F.row_number().over(Window.partitionBy("i").orderBy("j"))
    pairs = stored(tile_pairs(tiles, threshold).withColumn("part", F.floor((nth - 1) / TOGETHER)), "tile-pairs")
    tasks = pairs.select("i", "part").distinct().count()
    for end in ("i", "j"):
        files = tiles.select(F.col("tile").alias(end), F.col("rows").alias(f"rows_{end}"), F.col("file").alias(f"file_{end}"))
        pairs = pairs.join(files, end)
    dealt = pairs.repartitionByRange(max(1, tasks), "i", "part").sortWithinPartitions("i", "part", "j")
    return dealt.mapInArrow(compare, "cid long, links long, root long")


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    tile: int = TILE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Links join different rows with cosine at or over ``threshold``, in double precision on the original vectors.
    ``component_id`` is the smallest id reachable, itself included; ``kept`` tells whether that is the row's own id.
    Equal vectors are one class with a count, so copies are compared once. Vectors that are null, empty, zero or hold
    nulls or non-finite numbers, vectors of another length than most, and rows without an id link with nothing; without
    an id ``component_id`` is null and ``kept`` false. Repeated rows count as different vectors with one id. An empty
    table gives an empty one; other columns are not read.
    """
    rows = usable(vectors, id_col, vector_col)
    dims = main_length(rows)
    part = F.col("ok") & F.col("vec_id").isNotNull() & (F.size("v") == dims)
    rows = rows.withColumn("part", part)
    # Floats stay floats: no value changes, and less moves.
    kind = "float" if vectors.select(vector_col).schema[0].dataType.simpleString() == "array<float>" else "double"
    own = rows.where("part").select("k1", "k2", F.col("v").cast(f"array<{kind}>").alias("v"))
    classes = rows.where("part").groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
    classes = stored(classes.select(F.col("k1").alias("cid"), "n", "low"), "classes")
    count = classes.count()
    if count:
        axes = principal_axes(own, dims)
        pivots, path = pivots_of(own, axes, count), shared_path(vectors.sparkSession, "tile-rows")
        tiles = stored(tile_table(own, axes, pivots, path, tile, count), "tiles")
        found = stored(tile_links(tiles, path, axes, pivots, threshold, f"f{4 if kind == 'float' else 8}"), "tile-links")
    else:
        found = classes.select("cid", F.col("n").alias("links"), F.col("cid").alias("root"))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "cid")
    named = classes.select("cid", "n", "low").join(groups, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "root").join(links, "cid", "left")
    named = named.select(
        F.col("cid").alias("k1"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    taken = rows.where("part").select("vec_id", "k1").join(named, "k1").select("vec_id", "n_links", "component_id")
    rest = rows.where(~part).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id"))
    both = taken.union(rest)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
