"""Near-duplicate texts by SimHash and BK-trees.

A text's fingerprint takes the majority of every bit over the hashes of its word shingles. Two fingerprints are linked
when they differ in at most ``radius`` bits. The 64 bits are cut into ``radius + 2`` blocks: two linked fingerprints
agree in two of them at least, so every linked pair meets in a bucket keyed by two blocks' values. A bucket is dealt in
shards of bounded size, each shard gets a BK-tree (children keyed by the Hamming distance to their parent), and a
search follows only edges within the radius. Trees are built in the tasks that hold the shard and are not sent through
the driver: all trees together are as large as all fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, stored, two_keys
from tidemark.llm.graph import components

SHINGLE_WORDS, SEED, RADIUS = 4, 42, 4
#: Fingerprints in one tree; larger buckets are dealt in shards.
SHARD = 1024
#: Hashes whose bits are counted at once; bounds the memory of a task on long texts.
COUNT_AT_ONCE = 1 << 17


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle, repeats included; a shorter text is one shingle, a text without words has none."""
    parts = text.lower().split()  # on bytes: letters A-Z, and blanks 0x20 and 0x09-0x0D
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(parts) - span + 1].tolist(), ends[span - 1 :].tolist(), strict=True)
    return np.array([digest(joined[i:j], SEED) for i, j in pairs], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNT_AT_ONCE):
        part = hashes[i : i + COUNT_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, fp): the fingerprint as a signed 64-bit number; a null text counts as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t.as_py() or b"")) for t in batch["text"]]
            signed = pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())
            yield pa.record_batch({c: batch[c] for c in ("doc_id", "k1", "k2")} | {"fp": signed})

    own = documents(docs).withColumn("text", F.col("text").cast("binary"))
    return own.mapInArrow(run, "doc_id long, k1 long, k2 long, fp long")


#: Fingerprints are signed here; their difference is taken over 64 bits.
ALL = (1 << 64) - 1


class BKTree:
    """Fingerprints under their distance to the parent; found ones can be taken out."""

    def __init__(self, values: Iterable[int]):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.above: list[int] = []
        self.live: list[int] = []  # values still in the subtree
        self.there: list[bool] = []
        self.place: dict[int, int] = {}
        for v in values:
            self.add(v)

    def add(self, value: int) -> None:
        at, new = 0, len(self.values)
        if value in self.place:
            return
        if new:
            while True:
                far = ((self.values[at] ^ value) & ALL).bit_count()
                below = self.children[at].get(far)
                if below is None:
                    self.children[at][far] = new
                    break
                at = below
        self.values.append(value)
        self.children.append({})
        self.above.append(at if new else -1)
        self.live.append(0)
        self.there.append(True)
        self.place[value] = new
        self._count(new, 1)

    def _count(self, node: int, by: int) -> None:
        while node >= 0:
            self.live[node] += by
            node = self.above[node]

    def take(self, value: int) -> None:
        node = self.place[value]
        if self.there[node]:
            self.there[node] = False
            self._count(node, -1)

    def within(self, value: int, radius: int) -> list[int]:
        """Values still there at most ``radius`` away."""
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            if not self.live[node]:
                continue
            far = ((self.values[node] ^ value) & ALL).bit_count()
            if far <= radius and self.there[node]:
                found.append(self.values[node])
            for edge, child in self.children[node].items():
                if far - radius <= edge <= far + radius:
                    todo.append(child)
        return found


def linked(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """(smallest member, member) of every group of linked values.

    A found value leaves the tree, so a group of n close values costs about n searches of a shrinking tree.
    """
    tree = BKTree(values)
    for seed in values:
        if not tree.there[tree.place[seed]]:
            continue
        tree.take(seed)
        group, todo = [seed], [seed]
        while todo:
            for near in tree.within(todo.pop(), radius):
                tree.take(near)
                group.append(near)
                todo.append(near)
        low = min(group)
        yield from ((low, v) for v in group if v != low)


def bucket_keys(fp: str, radius: int) -> F.Column:
    """One key for each pair of blocks: which pair, and the two values."""
    blocks = radius + 2
    at = [64 * i // blocks for i in range(blocks + 1)]
    value = [
        F.shiftrightunsigned(F.col(fp), low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(at, at[1:], strict=False)
    ]
    pairs = [
        F.lit(n << 40).bitwiseOR(F.shiftleft(value[i], 20)).bitwiseOR(value[j])
        for n, (i, j) in enumerate(combinations(range(blocks), 2))
    ]
    return F.array(*pairs)


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple[int, bool, int]]]]:
    """Groups of a partition sorted by (key, shard): their (fp, asks, root) rows."""
    at, rows = None, []
    for batch in batches:
        cols = [batch[c].to_pylist() for c in ("key", "shard", "fp", "asks", "root")]
        for key, shard, *row in zip(*cols, strict=True):
            if (key, shard) != at:
                if rows:
                    yield at, rows
                at, rows = (key, shard), []
            rows.append(row)
    if rows:
        yield at, rows


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch(
        {"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())}
    )


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(id, root) of the fingerprints that have links: ``fps`` (fp) distinct, root the smallest linked one.

    Within a shard one link per member is kept. A bucket of several shards is searched a second time: its members of
    every group but the largest ask all its shards. Any pair that the first search left apart has such a member, so no
    link between groups is lost, and copies of one text, which by then are one group, ask nothing.
    """

    def within_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, rows in _batches(batches):
            if len(rows) > 1:
                out += linked([r[0] for r in rows], radius)
            if len(out) > 50_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _batches(batches):
            asking = [(r[0], r[2]) for r in rows if r[1]]
            if not asking:
                continue
            root = {r[0]: r[2] for r in rows if not r[1]}
            tree = BKTree(root)
            out = set()
            for fp, own in asking:
                out |= {(own, root[v]) for v in tree.within(fp, radius) if root[v] != own}
            yield _pairs(sorted(out))

    deal = ["key", "shard"]
    rows = stored(fps.select("fp", F.explode(bucket_keys("fp", radius)).alias("key")), "buckets")
    large = rows.groupBy("key").count().where(F.col("count") > shard)
    large = stored(large.select("key", F.ceil(F.col("count") / shard).cast("int").alias("shards")), "large")
    dealt = rows.join(large, "key", "left").withColumn(
        "shard", F.pmod(F.xxhash64("fp"), F.coalesce("shards", F.lit(1))).cast("int")
    )
    plain = dealt.select(*deal, "fp", F.lit(False).alias("asks"), F.lit(0).cast("long").alias("root"))
    first = plain.repartition(*deal).sortWithinPartitions(*deal).mapInArrow(within_shard, "a long, b long")
    edges = stored(first, "edges")
    groups = components(edges)
    if large.isEmpty():
        return groups
    named = dealt.where(F.col("shards").isNotNull()).join(groups.withColumnRenamed("id", "fp"), "fp", "left")
    named = stored(named.select(*deal, "shards", "fp", F.coalesce("root", "fp").alias("root")), "named")
    sizes = named.groupBy("key", "root").count()
    most = sizes.groupBy("key").agg(F.max_by("root", F.struct("count", "root")).alias("most"))
    asks = named.join(most, "key").where(F.col("root") != F.col("most"))
    asks = asks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    both = named.select(*deal, "fp", F.lit(False).alias("asks"), "root").union(
        asks.select(*deal, "fp", F.lit(True).alias("asks"), "root")
    )
    more = both.repartition(*deal).sortWithinPartitions(*deal).mapInArrow(across, "a long, b long")
    return components(edges.union(stored(more, "edges")))


def _named(docs: DataFrame, radius: int, shard: int) -> tuple[DataFrame, DataFrame]:
    """Every row with its fingerprint; every fingerprint with the first row (by id, ids before nulls) of its group."""
    fps = stored(fingerprints(docs), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "k1", "k2")
    classes = stored(fps.groupBy("fp").agg(F.min(row).alias("low")), "classes")
    groups = fingerprint_links(classes.select("fp"), radius, shard).withColumnRenamed("id", "fp")
    named = stored(classes.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    lows = named.groupBy("root").agg(F.min("low").alias("low"))
    return fps, named.select("fp", "root").join(lows, "root").select("fp", "low")


def simhash_components(docs: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links, itself included. A null text is an empty one; texts
    without words share fingerprint zero. Rows with a null id are fingerprinted and linked; a component of such rows
    alone has a null component_id. Repeated rows get the same result each. An empty table gives an empty one; other
    columns are not read.
    """
    fps, of_fp = _named(docs, radius, shard)
    return fps.join(of_fp, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("low.doc_id").alias("component_id"),
    )


def keep_first(docs: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id, with all its columns.

    A row with a null id stays only where no row of its group has an id. Of rows that repeat an id and text one stays.
    """
    _, of_fp = _named(docs, radius, shard)
    kept = of_fp.select("low.k1", "low.k2").distinct()
    keys = two_keys(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(*keys, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(kept, ["k1", "k2"], "semi")
    nth = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))
    return rows.withColumn("nth", nth).where("nth = 1").select("row.*")
