"""Collocations by set-oriented mining (SETM): sorted occurrence relations, merged with themselves and counted.

The occurrences of a text's words are a relation of (piece, position, word), sorted by the first two. Longer phrases come
from merging the occurrences of frequent phrases with those of words at the position after them; their groups are
counted, groups that are not frequent are taken out of the relation, and only what is left is extended again.

The relations lie in chunks of some megabytes of text in one language: a row of a stored table holds a chunk's occurrences,
packed, with its pieces and documents one after the other and a position without a word between two pieces. The tables are
bucketed by chunk, so that they are written once and never shuffled. What is counted goes by key: a chunk
counts its own groups first and asks, in shards of keys, which of them are frequent; a shard sums what all chunks ask, keeps the
frequent groups, and answers each chunk in the order in which it asked. A group that every text has costs one number for a
chunk.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, shared_path, ship, stored

#: Bytes of text in a chunk, held in a task over all languages, cut into words at once, and in a bucket of chunks.
CHUNK, HELD, SLICE, BUCKET = 8 << 20, 32 << 20, 4 << 20, 16 << 20
#: Groups in a shard, about.
SHARD = 500_000
#: Borders between pieces, and blanks, as a table of bytes; A-Z become a-z.
MARKS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x0A if b in b".,;:!?\n\x0b\f\r" else 0x20 if b == 0x09 else b for b in range(256)
)
BORDER, NOTHING = -1, -2


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in the smallest type that holds them, compressed."""
    top = int(numbers.max()) if len(numbers) else 0
    kind = next(k for k in "BHIQ" if top <= np.iinfo(k).max)
    return kind.encode() + zstandard.compress(numbers.astype(kind).tobytes())


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data[1:]), data[:1].decode()).astype(np.int64)


def pack_rising(numbers: np.ndarray) -> bytes:
    return pack(np.diff(numbers, prepend=0))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


class Numbers(dict):
    """Words by the order in which they came."""

    def __init__(self):
        super().__init__({b"\n": BORDER, b"": NOTHING})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 2
        return n

    def words(self) -> list[bytes]:
        return list(self)[2:]


def sliced(text: bytes, most: int) -> Iterator[bytes]:
    """Parts of about ``most`` bytes that together are the text; none ends inside a word."""
    at = 0
    while at < len(text):
        end = at + most
        if end < len(text):
            cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end)) + 1
            if not cut:  # a word longer than a part
                after = [i for i in (text.find(b" ", end), text.find(b"\n", end)) if i >= 0]
                cut = min(after) + 1 if after else len(text)
            end = cut
        yield text[at:end]
        at = end


def positions(text: bytes, numbers: Numbers, most: int = SLICE) -> list[np.ndarray]:
    """The number of the word at every position, ``BORDER`` where there is none."""
    out = []
    for part in sliced(text.translate(MARKS), most):
        tokens = part.replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
        out.append(found[found != NOTHING])
    out.append(np.array([BORDER], np.int32))
    return out


def chunks(docs: DataFrame, chunk: int = CHUNK, held: int = HELD) -> DataFrame:
    """(chunk, lang, n, asked, words, seq): ``seq`` is a word's number in ``words``, more by one, at every position."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, sizes = TaskContext.get().partitionId() << 33, 0, {}
        open_: dict[str, tuple[Numbers, list[np.ndarray]]] = {}

        def close(lang: str) -> pa.RecordBatch:
            nonlocal made
            numbers, parts = open_.pop(lang)
            del sizes[lang]
            seq = np.concatenate(parts)
            words = numbers.words()
            made += 1
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "chunk": first + made, "lang": lang, "n": int((seq >= 0).sum()), "asked": len(words),
                        "words": zstandard.compress(b"\n".join(words)), "seq": pack(seq.astype(np.int64) + 1),
                    }
                ],
                kind,
            )

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                text = text.as_py()
                if lang not in open_:
                    open_[lang], sizes[lang] = (Numbers(), []), 0
                numbers, parts = open_[lang]
                parts += positions(text, numbers)
                sizes[lang] += len(text) + 1
                if sizes[lang] >= chunk:
                    yield close(lang)
                elif sum(sizes.values()) >= held:
                    yield close(max(sizes, key=sizes.__getitem__))
        for lang in list(open_):
            yield close(lang)

    kind = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("asked", pa.int64()), ("words", pa.binary()), ("seq", pa.binary())])
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return own.select("lang", text).mapInArrow(run, "chunk long, lang string, n long, asked long, words binary, seq binary")


def bucketed(df: DataFrame, buckets: int, name: str) -> DataFrame:
    """Stored like ``stored``, in buckets by chunk; joins by chunk read it where it is.

    Its name in the catalog goes at once: the files' layout is in the plan.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, "chunk").option("path", shared_path(spark, name)).saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return kept


def grouped(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that share their first columns, where these lie together."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != at:
                if held:
                    yield at, held
                at, held = row[:keys], []
            held.append(row)
    if held:
        yield at, held


ASKS = "lang string, shard int, chunk long, first binary, last binary, counts binary"
ASK_KIND = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("chunk", pa.int64()), ("first", pa.binary()), ("last", pa.binary()), ("counts", pa.binary())])
#: Answers to chunks, frequent groups, and how many words a language has, in one stored table.
TOLD = "lang string, chunk long, shard int, yes binary, ids binary, id long, first long, last long, word string, f long, n long"
TOLD_KIND = pa.schema(
    [("lang", pa.string()), ("chunk", pa.int64()), ("shard", pa.int32()), ("yes", pa.binary()), ("ids", pa.binary()), ("id", pa.int64()),
     ("first", pa.int64()), ("last", pa.int64()), ("word", pa.string()), ("f", pa.int64()), ("n", pa.int64())]
)


def shards_of(total: int, shard: int) -> int:
    return max(1, -(-total // shard))


def settled(asks: DataFrame, shards: int, least: int, words: bool, answer: bool) -> DataFrame:
    """What all chunks ask, summed by shard: the groups of at least ``least``, and for every chunk which of its are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, shard), rows in grouped(batches, 2):
            if words:
                number: dict[bytes, int] = {}
                of = [[number.setdefault(w, len(number)) for w in zstandard.decompress(r[4]).split(b"\n")] for r in rows]
                of = [np.array(o, np.int64) for o in of]
                inverse = np.concatenate(of)
            else:
                first, last = (np.concatenate([f(r[i]) for r in rows]) for i, f in ((3, unpack_rising), (4, unpack)))
                kinds, inverse = unique_pairs(first, last)
                of = np.split(inverse, np.cumsum([len(unpack(r[5])) for r in rows])[:-1])
            counts = np.concatenate([unpack(r[5]) for r in rows])
            f = np.zeros(int(inverse.max()) + 1, np.int64)
            np.add.at(f, inverse, counts)
            often = f >= least
            ids = (np.cumsum(often) - 1) * shards + shard
            if answer:
                out = [
                    {"lang": lang, "chunk": r[2], "shard": shard, "yes": np.packbits(often[o]).tobytes(), "ids": pack(ids[o][often[o]])}
                    for r, o in zip(rows, of, strict=True)
                ]
                yield pa.RecordBatch.from_pylist(out, TOLD_KIND)
            at = np.flatnonzero(often)
            same = {"lang": pa.array([lang] * len(at), pa.string()), "id": pa.array(ids[at]), "f": pa.array(f[at])}
            if words:
                listed = list(number)
                same["word"] = pa.array([listed[i].decode() for i in at.tolist()], pa.string())
                yield pa.RecordBatch.from_pylist([{"lang": lang, "n": int(f.sum())}], TOLD_KIND)
            else:
                same |= {"first": pa.array(first[kinds[at]]), "last": pa.array(last[kinds[at]])}
            columns = [same.get(k.name, pa.nulls(len(at), k.type)) for k in TOLD_KIND]
            yield pa.RecordBatch.from_arrays(columns, schema=TOLD_KIND)

    return asks.repartition("lang", "shard").sortWithinPartitions("lang", "shard").mapInArrow(run, TOLD)


def answers(told: DataFrame) -> DataFrame:
    """(chunk, answers): a chunk's answers by shard."""
    rows = told.where("chunk is not null").groupBy("chunk")
    return rows.agg(F.sort_array(F.collect_list(F.struct("shard", "yes", "ids"))).alias("answers"))


def unique_pairs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each pair is first met, in order of the pairs, and which of them each one is."""
    a, first_of = np.unique(first, return_inverse=True)
    b, last_of = np.unique(last, return_inverse=True)
    _, at, inverse = np.unique(first_of * max(1, len(b)) + last_of, return_index=True, return_inverse=True)
    return at, inverse


def shard_of_words(words: list[bytes], shards: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words))


def shard_of_pairs(first: np.ndarray, last: np.ndarray, shards: int) -> np.ndarray:
    mixed = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.astype(np.uint64)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def dealt(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shards that are asked, in order, and what is asked of each."""
    order = np.argsort(of, kind="stable")
    which, starts = np.unique(of[order], return_index=True)
    if len(of):
        yield from zip(which.tolist(), np.split(order, starts[1:]), strict=True)


def heard(of: np.ndarray, told: list[dict]) -> np.ndarray:
    """The id of everything that was asked, -1 where it is not frequent."""
    out = np.full(len(of), -1, np.int64)
    by = {t["shard"]: t for t in told}
    for shard, asked in dealt(of):
        yes = np.unpackbits(np.frombuffer(by[shard]["yes"], np.uint8), count=len(asked)).astype(bool)
        out[asked[yes]] = unpack(by[shard]["ids"])
    return out


def merged(at: np.ndarray, word: np.ndarray, after: np.ndarray, phrase: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, phrase, word): occurrences of phrases merged with those of the words right after them."""
    if not len(at):
        return after[:0], phrase[:0], word[:0]
    place = np.minimum(np.searchsorted(at, after), len(at) - 1)
    met = at[place] == after
    return after[met], phrase[met], word[place[met]]


def ask_words(chunk_rows: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = zstandard.decompress(row["words"]).split(b"\n") if row["asked"] else []
                counts = np.bincount(unpack(row["seq"]), minlength=len(words) + 1)[1:]
                out = [
                    {"lang": row["lang"], "shard": s, "chunk": row["chunk"], "last": zstandard.compress(b"\n".join(words[i] for i in asked.tolist())), "counts": pack(counts[asked])}
                    for s, asked in dealt(shard_of_words(words, shards))
                ]
                yield pa.RecordBatch.from_pylist(out, ASK_KIND)

    return chunk_rows.mapInArrow(run, ASKS)


def word_relation(chunk_rows: DataFrame, told: DataFrame, shards: int) -> DataFrame:
    """(chunk, lang, n, at, word): occurrences of frequent words, sorted by position."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = zstandard.decompress(row["words"]).split(b"\n") if row["asked"] else []
                ids = np.concatenate([[-1], heard(shard_of_words(words, shards), row["answers"] or [])])
                word = ids[unpack(row["seq"])]
                at = np.flatnonzero(word >= 0)
                out = {"chunk": row["chunk"], "lang": row["lang"], "n": len(at), "at": pack_rising(at), "word": pack(word[at])}
                yield pa.RecordBatch.from_pylist([out], kind)

    kind = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("at", pa.binary()), ("word", pa.binary())])
    joined = chunk_rows.join(answers(told), "chunk", "left")
    return joined.mapInArrow(run, "chunk long, lang string, n long, at binary, word binary")


def _occurrences(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's phrases, merged with the words after them; ``after`` is null where the phrases are the words."""
    at, word = unpack_rising(row["at"]), unpack(row["word"])
    after, phrase = (at + 1, word) if row["after"] is None else (unpack_rising(row["after"]), unpack(row["phrase"]))
    return merged(at, word, after, phrase)


def ask_pairs(relations: DataFrame, shards: int) -> DataFrame:
    """What a chunk has of phrases that are longer by a word, with their counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, phrase, word = _occurrences(row)
                if not len(phrase):
                    continue
                kinds, inverse = unique_pairs(phrase, word)
                counts, first, last = np.bincount(inverse), phrase[kinds], word[kinds]
                out = [
                    {"lang": row["lang"], "shard": s, "chunk": row["chunk"], "first": pack_rising(first[a]), "last": pack(last[a]), "counts": pack(counts[a])}
                    for s, a in dealt(shard_of_pairs(first, last, shards))
                ]
                yield pa.RecordBatch.from_pylist(out, ASK_KIND)

    return relations.mapInArrow(run, ASKS)


def phrase_relation(relations: DataFrame, told: DataFrame, shards: int) -> DataFrame:
    """(chunk, n, after, phrase): occurrences of frequent phrases, sorted by the position after them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place, phrase, word = _occurrences(row)
                ids = phrase
                if len(phrase):
                    kinds, inverse = unique_pairs(phrase, word)
                    ids = heard(shard_of_pairs(phrase[kinds], word[kinds], shards), row["answers"])[inverse]
                often = ids >= 0
                out = {"chunk": row["chunk"], "n": int(often.sum()), "after": pack_rising(place[often] + 1), "phrase": pack(ids[often])}
                yield pa.RecordBatch.from_pylist([out], kind)

    kind = pa.schema([("chunk", pa.int64()), ("n", pa.int64()), ("after", pa.binary()), ("phrase", pa.binary())])
    return relations.join(answers(told), "chunk", "left").mapInArrow(run, "chunk long, n long, after binary, phrase binary")


def scored(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact: the product has at most 38 digits, or it is an error."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, wide(left) * wide(right))


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, most: int = 2000,
    chunk: int = CHUNK, shard: int = SHARD,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of every language whose words stick together most.

    Texts of ``docs`` (text, lang) are lowered from A to Z, cut into pieces at ``.,;:!?`` and line ends, and these into words
    at blanks and tabs. ``a`` is how often a phrase of 2 to ``longest`` words occurs within pieces, overlaps included; those
    of at least ``least`` are candidates. Of all cuts into two parts, with ``l`` and ``r`` occurrences, the lowest floor(1000000 a a /
    (l r)) is the score, with equal ones that of the shortest first part. A candidate inside a longer one that has at least ``covered`` percent
    of its occurrences goes. ``n`` counts the language's words. Of every language the first ``most`` by score, a (both falling) and
    phrase (UTF-8 bytes, rising) are returned. A null text is empty, a null language ``und``. Repeated rows count as
    often as they are there. An empty table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    buckets = max(1, -(-size // BUCKET))
    base = bucketed(chunks(docs, chunk), buckets, "chunks")
    asked = base.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]
    shards = shards_of(asked, shard)
    told = stored(settled(ask_words(base, shards), shards, least, words=True, answer=True), "words")
    totals = told.where("n is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    none = F.array().cast("array<long>")
    words = told.where("word is not null").select(
        "lang", "id", F.col("id").alias("rest"), "first", "last", "word", F.col("word").alias("phrase"), "f",
        none.alias("lefts"), none.alias("rights"),
    )
    relation = bucketed(word_relation(base, told, shards), buckets, "occurrences")
    relations = relation.select("chunk", "lang", "at", "word", F.lit(None).cast("binary").alias("after"), F.lit(None).cast("binary").alias("phrase"))
    count, levels = relation, [words]
    for length in range(2, longest + 1):
        total = count.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        shards = shards_of(total, shard)
        more = length < longest
        told = stored(settled(ask_pairs(relations, shards), shards, least, words=False, answer=more), "phrases")
        found = told.where("id is not null").select("lang", "id", "first", "last", "f")
        levels.append(stored(_longer(found, levels[-1], length), "levels"))
        if more:
            count = bucketed(phrase_relation(relations, told, shards), buckets, "phrases")
            relations = relation.drop("n").join(count.drop("n"), "chunk")
    return _best(levels, totals, covered, most)


def _longer(found: DataFrame, shorter: DataFrame, length: int) -> DataFrame:
    """Phrases with their words, and how often their first and their last words occur, from those shorter by a word.

    ``rest`` is the phrase without its first word: the one that goes on from the first part's rest with the same word.
    """
    first = shorter.select(
        "lang", F.col("id").alias("first"), F.col("rest").alias("g_rest"), F.col("phrase").alias("g_phrase"), F.col("f").alias("g_f"), "lefts"
    )
    rest = shorter.select(
        F.col("lang").alias("s_lang"), F.col("id").alias("rest"), F.col("first").alias("s_first"), F.col("last").alias("s_last"),
        "word", F.col("f").alias("s_f"), "rights",
    )
    same = [F.col("lang") == F.col("s_lang")]
    if length == 2:
        same += [F.col("last") == F.col("rest")]
    else:
        same += [F.col("g_rest") == F.col("s_first"), F.col("last") == F.col("s_last")]
    return found.join(first, ["lang", "first"]).join(rest, same).select(
        "lang", "id", "rest", "first", "last", "word", F.concat_ws(" ", "g_phrase", "word").alias("phrase"), "f",
        F.concat("lefts", F.array("g_f")).alias("lefts"), F.concat("rights", F.array("s_f")).alias("rights"),
    )


def _cut(k: int, length: int) -> Column:
    """A phrase cut after ``k`` words; the least of these is the lowest score with the shortest first part."""
    left, right = F.get("lefts", F.lit(k - 1)), F.get("rights", F.lit(length - 1 - k))
    return F.struct(scored(F.col("f"), left, right).alias("score"), F.lit(k).alias("cut"), left.alias("l"), right.alias("r"))


def _best(levels: list[DataFrame], totals: DataFrame, covered: int, most: int) -> DataFrame:
    rows = None
    for length, level in enumerate(levels[1:], 2):
        if length < len(levels):
            longer = levels[length]
            inside = longer.select("lang", F.col("first").alias("id"), "f").union(longer.select("lang", "rest", "f"))
            over = inside.groupBy("lang", "id").agg(F.max("f").alias("over"))
            level = level.join(over, ["lang", "id"], "left").where(f"over is null or 100 * over < {covered} * f").drop("over")
        cuts = F.array(*[_cut(k, length) for k in range(1, length)])
        level = level.select("lang", "phrase", F.col("f").alias("a"), F.array_min(cuts).alias("cut"))
        rows = level if rows is None else rows.union(level)
    flat = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
