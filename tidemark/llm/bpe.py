"""BPE encoding and decoding through a table of distinct words.

Documents are dealt in chunks, one for each piece of a file that a task reads. Every chunk lists its distinct words
once; the lists meet by word, each word is encoded once, and its ids go back to the chunks that asked. There they are
put in the place of the words, and decoded by a lookup, in the same task, in the list of pieces, which has one entry for
each of the vocabulary and so a fixed size.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents
from tidemark.llm.words import tokenizer

#: Parquet bytes of a chunk, about: bounds the words that a task holds.
CHUNK_MB = 16
#: Distinct words of one chunk that are collected before they are passed on.
HELD = 400_000


def chunk_key(docs: DataFrame) -> F.Column:
    """A number for the piece of a file that a row is read from; large pieces are split by the row's key.

    It is the same in every read of the file. A table that is not read from files is split by the key alone.
    """
    most = docs.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "128m")
    number = int("".join(c for c in most if c.isdigit()) or 1)
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(most.lower().rstrip("b")[-1:], 1)
    split = max(1, math.ceil(number * unit / (CHUNK_MB << 20)))
    at_file = F.xxhash64(F.input_file_name(), F.input_file_block_start())
    return F.xxhash64(at_file, F.pmod("k1", F.lit(split)))


def encode(docs: DataFrame, path: str | None = None, with_text: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), and with ``with_text`` also (ids, decoded).

    ``ids`` are those the tokenizer gives for the whole text without special tokens of its own, ``decoded`` what its
    decoder makes of them, special tokens kept. The hashes are of the ids as decimals joined by commas, and of the
    decoded text in UTF-8, in lower-case hex. ``path`` is the vocabulary's file on the executors. A null text is an
    empty one: no ids, and the hashes of nothing. Every row, repeated ones too, gives one row; ids of rows may be null.
    An empty table gives an empty one; other columns are not read.
    """
    rows = documents(docs).withColumn("chunk", chunk_key(docs)).select("chunk", "doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def list_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, held, size = tokenizer(path), {}, 0

        def listed() -> Iterator[pa.RecordBatch]:
            for chunk, words in held.items():
                yield pa.record_batch({"chunk": pa.repeat(pa.scalar(chunk, pa.int64()), len(words)), "word": pa.array(words, pa.string())})

        for batch in batches:
            for chunk, text in zip(batch["chunk"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = held.setdefault(chunk, {})
                size -= len(words)
                words.update(dict.fromkeys(tok.split(text)))
                size += len(words)
                if size > HELD:
                    yield from listed()
                    held, size = {}, 0
        yield from listed()

    def encode_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted words: each is encoded once and goes to its chunks, many in one compressed row."""
        tok, last, last_ids, small = tokenizer(path), None, b"", zstandard.ZstdCompressor()
        held: dict[int, list[tuple[str, bytes]]] = {}
        size = 0

        def sent() -> pa.RecordBatch:
            packs = [small.compress(pickle.dumps(list(zip(*pairs, strict=True)))) for pairs in held.values()]
            return pa.record_batch({"chunk": pa.array(held, pa.int64()), "pack": pa.array(packs, pa.binary())})

        for batch in batches:
            words = batch["word"].to_pylist()
            new = list(dict.fromkeys(w for w in words if w != last))
            ids = dict(zip(new, tok.encode(new), strict=True)) | ({last: last_ids} if last is not None else {})
            for chunk, word in zip(batch["chunk"].to_pylist(), words, strict=True):
                held.setdefault(chunk, []).append((word, ids[word]))
            if words:
                last, last_ids = words[-1], ids[words[-1]]
            size += len(words)
            if size > HELD // 4:
                yield sent()
                held, size = {}, 0
        if held:
            yield sent()

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor()
        for batch in batches:
            z = [small.compress(t.as_py()) for t in batch["text"]]
            yield pa.record_batch([batch["chunk"], batch["doc_id"], pa.array(z, pa.binary())], ["chunk", "doc_id", "z"])

    def put_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, pieces, large = tokenizer(path), tokenizer(path).pieces, zstandard.ZstdDecompressor()
        at, ids_of = None, {}
        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("chunk", "is_doc", "doc_id", "z")]
            for chunk, is_doc, doc_id, z in zip(*columns, strict=True):
                if chunk != at:
                    at, ids_of = chunk, {}
                if not is_doc:
                    ids_of.update(zip(*pickle.loads(large.decompress(z)), strict=True))
                    continue
                words = tok.split(large.decompress(z).decode())
                found = np.frombuffer(b"".join(map(ids_of.__getitem__, words)), "<u4").tolist()
                decoded = b"".join(map(pieces.__getitem__, found)).decode("utf-8", "replace")
                one = {
                    "doc_id": doc_id,
                    "n_tokens": len(found),
                    "ids_sha256": hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(),
                    "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
                }
                out.append(one | ({"ids": found, "decoded": decoded} if with_text else {}))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_text:
        kinds += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
        ddl += ", ids array<int>, decoded string"
    schema = pa.schema(kinds)
    listed = rows.select("chunk", "text").mapInArrow(list_words, "chunk long, word string")
    by_word = listed.repartition("word").sortWithinPartitions("word")
    encoded = by_word.mapInArrow(encode_words, "chunk long, pack binary")
    packed = rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(pack, "chunk long, doc_id long, z binary")
    words = encoded.select("chunk", F.lit(False).alias("is_doc"), F.lit(None).cast("long").alias("doc_id"), F.col("pack").alias("z"))
    both = words.union(packed.select("chunk", F.lit(True), "doc_id", "z"))
    return both.repartition("chunk").sortWithinPartitions("chunk", "is_doc").mapInArrow(put_back, ddl)
