"""Benchmark passages in documents: one Aho-Corasick automaton over the words of all test items.

An item's words are cut into windows of ten. Every distinct word of the items gets one character, a window is a string of
such characters, and the automaton of all windows reads each document once, as the string of its words' characters, with
one character for all words that no item has. A match ends at a word, so hits are places among the document's words,
and ``spans`` maps them to places in the text as it came.

Items are dealt in shares of bounded size, since an automaton takes memory in proportion to its windows. A share is
collected, sent to the executors once, and built there in the worker; with more than one share a task reads its documents
once per share, a bounded number of bytes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, ship, stored

#: Words of a window.
WINDOW = 10
#: Words of the items in one share, about, and of one row of a long item.
SHARE, ROW = 200_000, 2000
#: Bytes of documents that a task holds to read them once per share.
HELD = 32 << 20
#: The class of a word's characters, as a table of bytes: A-Z to a-z, digits and bytes from 0x80 stay, others are blanks.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: Stands for words that no item has.
OTHER = "\0"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def windows(words: list[bytes], size: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    """All runs of ``size`` words; of fewer words, but not none, the one run there is."""
    if words:
        for i in range(max(1, len(words) - size + 1)):
            yield tuple(words[i : i + size])


def _character(n: int) -> str:
    """The n-th character from U+0001 on that is no surrogate."""
    return chr(n + 1 if n + 1 < 0xD800 else n + 0x801)


class Automaton:
    """The windows of one share of the items: rows of (words, ids of the items that have them), as ``shares`` gives them."""

    def __init__(self, rows: list[tuple[bytes, list[int]]], size: int = WINDOW):
        import ahocorasick

        self.code: dict[bytes, str] = {}
        self.machine = ahocorasick.Automaton()
        places: dict[str, int] = {}
        self.texts: list[set[int]] = []  # by window: which texts have it
        self.ids = [ids for _, ids in rows]  # by text: whose it is
        for n, (joined, _) in enumerate(rows):
            for run in windows(joined.split(), size):
                key = "".join([self.code.setdefault(w, _character(len(self.code))) for w in run])
                at = places.setdefault(key, len(places))
                if at == len(self.texts):
                    self.texts.append(set())
                    self.machine.add_word(key, (len(key), at))
                self.texts[at].add(n)
        if places:
            self.machine.make_automaton()
        self.some = bool(places)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], frozenset[int]]:
        """Runs of hit words (first, end), disjoint and in order, and the windows that were met."""
        runs: list[tuple[int, int]] = []
        met = set()
        if self.some and words:
            of = self.code.get
            for last, (length, at) in self.machine.iter("".join([of(w, OTHER) for w in words])):
                met.add(at)
                first = last + 1 - length
                while runs and runs[-1][1] >= first:  # ends rise, so only the last runs can touch
                    first = min(first, runs.pop()[0])
                runs.append((first, last + 1))
        return runs, frozenset(met)

    def items(self, met: frozenset[int]) -> frozenset[int]:
        of = set().union(*(self.texts[at] for at in met))
        return frozenset().union(*(self.ids[i] for i in of))


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if out and out[-1][1] >= first:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def places(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as code points of the original text, from the first word's start to the last one's end."""
    if not runs:
        return []
    starts, ends, inside = [], [], False
    for i, c in enumerate(text):
        is_word = c >= "\x80" or c in "0123456789" or "a" <= c <= "z" or "A" <= c <= "Z"
        if is_word and not inside:
            starts.append(i)
        elif inside and not is_word:
            ends.append(i)
        inside = is_word
    if inside:
        ends.append(len(text))
    return [(starts[first], ends[end - 1]) for first, end in runs]


def shares(items: DataFrame, size: int = WINDOW, share: int = SHARE) -> list:
    """Broadcasts of rows (words joined by blanks, ids), each of about ``share`` words and ids at most.

    A long item is cut in rows of ``ROW`` words that overlap by a window less one word, so that no window is lost. Equal
    rows are one with the ids of all. The rows are dealt by a hash of their words into as many shares as it takes until
    the largest is small enough. Only one share at a time is on the driver.
    """
    spark = items.sparkSession

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = words_of(text or b"")
                for i in range(0, max(1, len(words) - size + 1), ROW):
                    part = words[i : i + ROW + size - 1]
                    if part:
                        out.append((item, b" ".join(part), len(part)))
            if out:
                ids, texts, counts = zip(*out, strict=True)
                yield pa.record_batch(
                    {"item_id": pa.array(ids, pa.int64()), "words": pa.array(texts, pa.binary()), "n": pa.array(counts, pa.int64())}
                )

    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    rows = own.mapInArrow(cut, "item_id long, words binary, n long")
    texts = rows.groupBy("words").agg(F.max("n").alias("n"), F.collect_set("item_id").alias("ids"))
    texts = stored(texts.withColumn("n", F.col("n") + F.size("ids")), "items")
    total, longest = texts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    dealt = max(1, -(-total // share))

    def dealt_to(k: int) -> F.Column:
        return F.pmod(F.xxhash64("words"), F.lit(k))

    # A row can be larger than a share only by the ids of its copies.
    while (texts.groupBy(dealt_to(dealt)).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0) > 2 * max(share, longest):
        dealt *= 2
    return [
        spark.sparkContext.broadcast(
            sorted((bytes(r["words"]), sorted(r["ids"])) for r in texts.where(dealt_to(dealt) == k).select("words", "ids").collect())
        )
        for k in range(dealt)
    ]


def contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, share: int = SHARE, with_spans: bool = False) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs`` (doc_id, text), and with
    ``with_spans`` also ``spans``: hit passages as (start, end) code points of the text.

    A word is a run of a-z, digits and characters from U+0080, after A-Z were lowered. It is hit if it lies inside any
    occurrence of ``size`` consecutive words of an item of ``items`` (item_id, text); an item of fewer words, but not
    none, must occur whole. ``n_items`` counts ids of items with an occurring window, and ``items_sha256`` is the lower-case
    hex SHA-256 of these ids, sorted as strings and joined by commas. Null and empty texts have no words; items without
    words never occur; an item without id marks words and is not counted; rows of items that repeat an id are one item. Every row of
    ``docs``, repeated ones and ones without id too, gives one row. Without items nothing is hit. Other columns are not read.
    """
    ship(docs.sparkSession)
    sent = shares(items, size, share)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One automaton at a time; digests of the sets of items met last.
        automaton = lru_cache(maxsize=1)(lambda k: Automaton(sent[k].value, size))
        digest = lru_cache(maxsize=256)(lambda ids: hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest())

        def found(texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], frozenset[int]]]:
            counts, runs, ids = [0] * len(texts), [[] for _ in texts], [frozenset()] * len(texts)
            for k in range(len(sent)):
                machine = automaton(k)
                for n, text in enumerate(texts):
                    words = words_of(text)
                    some, met = machine.hits(words)
                    counts[n] = len(words)
                    if met:
                        runs[n] = merged(runs[n] + some) if runs[n] else some
                        ids[n] |= machine.items(met)
            return list(zip(counts, runs, ids, strict=True))

        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"]
            at = 0
            while at < len(ids):
                held, size_held, first = [], 0, at
                while at < len(ids) and (size_held < HELD or not held):
                    held.append(texts[at].as_py() or b"")
                    size_held += len(held[-1])
                    at += 1
                rows = found(held)
                made = {
                    "doc_id": pa.array(ids[first:at], pa.int64()),
                    "n_words": pa.array([n for n, _, _ in rows], pa.int64()),
                    "n_hit": pa.array([sum(b - a for a, b in runs) for _, runs, _ in rows], pa.int64()),
                    "n_items": pa.array([len(i) for _, _, i in rows], pa.int64()),
                    "items_sha256": pa.array([digest(i) for _, _, i in rows], pa.string()),
                    "contaminated": pa.array([bool(runs) for _, runs, _ in rows], pa.bool_()),
                }
                if with_spans:
                    spans = [places(t.decode(), runs) for t, (_, runs, _) in zip(held, rows, strict=True)]
                    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                    made["spans"] = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind)
                yield pa.record_batch(made)

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    schema += ", spans array<struct<start:long,end:long>>" if with_spans else ""
    rows = documents(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)
