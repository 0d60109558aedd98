"""Best-fit packing of token sequences by minimum bin slack.

Only the lengths matter to the plan, and there are at most ``capacity`` of them, so the plan is made on a histogram: how
many pieces of each length there are. For one bin, a subset-sum over the lengths still there, kept as a bitset of
reachable sums, finds the fullest feasible combination. The combination is taken as often as its pieces last, so a plan
has about as many lines as there are lengths, however many pieces it packs. Pieces are then numbered within their length
and meet their place in the plan by that number.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, release, stored
from tidemark.llm.words import tokenizer

CAPACITY, END = 1024, 2
#: Pieces of one length in one numbered group.
GROUP = 50_000


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, k1, k2, piece, start, length, ids_crc32): documents cut into pieces of ``capacity`` tokens.

    A document's tokens are its text's, then ``end``. Only a document longer than ``capacity`` is cut; then its first
    piece takes what does not fill a whole one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, last = tokenizer(path), np.uint32(end).tobytes()
        for batch in batches:
            out = []
            for *key, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "k1", "k2")), batch["text"], strict=True):
                ids = tok.ids(text.as_py() or "") + last
                count = len(ids) // 4
                first = count % capacity or capacity
                for piece, start in enumerate([0, *range(first, count, capacity)]):
                    stop = first if not piece else start + capacity
                    out.append((*key, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        release()

    names = ["doc_id", "k1", "k2", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = "doc_id long, k1 long, k2 long, piece int, start long, length long, ids_crc32 long"
    return documents(docs).mapInArrow(run, schema)


def fullest(counts: dict[int, int], capacity: int) -> Counter:
    """Lengths, with repeats, of the fullest bin that can be filled from ``counts``.

    The longest length there is goes in first. Lengths then join in falling order, a length's copies in binary groups;
    ``reached`` has bit s set if some choice so far adds up to s. The search stops once the bin can be full, and the
    choice is read back from the sets before each step.
    """
    longest = max(counts)
    room = capacity - longest
    mask, reached = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        many = 1
        while left > 0 and not reached >> room & 1:
            take = min(many, left)
            left, many = left - take, many * 2
            new = (reached | reached << (take * length)) & mask
            if new != reached:
                steps.append((length, take, reached))
                reached = new
    at, chosen = reached.bit_length() - 1, Counter({longest: 1})
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += take
            at -= take * length
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """(first bin, bins, places) lines; a place is (length, how many of it in a bin, offset of the first).

    ``histogram`` has at most ``capacity`` lengths of 1 to ``capacity``.
    """
    left, lines, bins = {k: n for k, n in histogram.items() if n > 0}, [], 0
    while left:
        chosen = fullest(left, capacity)
        times = min(left[k] // n for k, n in chosen.items())
        places, offset = [], 0
        for length, n in sorted(chosen.items(), reverse=True):
            places.append((length, n, offset))
            offset += length * n
            left[length] -= n * times
            if not left[length]:
                del left[length]
        lines.append((bins, times, places))
        bins += times
    return lines


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every document's pieces in sequences.

    ``start`` counts the document's ids before the piece, ``ids_crc32`` is over its ids as little-endian unsigned 32-bit
    numbers, ``sequence_id`` and ``offset`` say where it lies. Sequences hold at most ``capacity`` tokens without gaps. A null text
    is an empty one, whose one piece is the end token. Every row counts, repeated ones and ones with a null id too.
    Pieces of one length are interchangeable; they are numbered in groups. An empty table gives an empty one;
    other columns are not read.
    """
    # A number for each row, stored with it: rows that repeat id and text are dealt to different groups, too.
    cut = stored(pieces(docs, path, capacity, end).withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-cut.count() // GROUP))
    cut = cut.withColumn("group", F.pmod(F.xxhash64("k1", "row"), F.lit(groups)).cast("int"))
    sizes = cut.groupBy("length", "group").count()
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    rows = []  # of one length: numbers from, to, each bin takes so many, first bin, offset of the first
    taken: Counter = Counter()
    for first_bin, bins, places in plan(histogram, capacity):
        for length, n, offset in places:
            rows.append((length, taken[length], taken[length] + bins * n, n, first_bin, offset))
            taken[length] += bins * n
    spark = docs.sparkSession
    lines = spark.createDataFrame(rows, "length long, low long, high long, each long, first_bin long, at long")
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "group").orderBy("doc_id", "k1", "k2", "piece", "row")
    numbered = cut.withColumn("nth", F.row_number().over(own) - 1).join(sizes, ["length", "group"])
    numbered = numbered.withColumn("nth", F.col("nth") + F.col("base"))
    # At most one line for each length and step of the plan: a table of bounded size, broadcast.
    by_length = lines.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("low", "high", "each", "first_bin", "at"))).alias("lines")
    )
    placed = numbered.join(F.broadcast(by_length), "length")
    line = F.filter("lines", lambda x: (x["low"] <= F.col("nth")) & (F.col("nth") < x["high"]))[0]
    placed = placed.withColumn("line", line).withColumn("n", F.col("nth") - F.col("line.low"))
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("line.first_bin") + F.floor(F.col("n") / F.col("line.each"))).alias("sequence_id"),
        (F.col("line.at") + F.col("length") * F.pmod("n", "line.each")).alias("offset"),
    )
