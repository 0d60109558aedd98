"""WARC archives: a deterministic sharded writer, and the reader.

Pages are range-sorted by id into shards, each record is a compressed member of its own, and files are rolled by their
compressed size. Headers and digests are made anew from the rows. A task writes under a temporary name and renames when
the file is complete; the list of files and their checksums is a table that Spark commits. Readers open only listed
files, so what a lost or repeated attempt leaves behind is never read, and a repeated attempt writes the same bytes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import urllib.parse
import uuid
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import even_labels, shared_path, ship, stored

#: Payloads from this size on are stored once.
LEAST = 1000
#: Payload bytes of a shard as a mean, and compressed bytes after which a file is closed.
SHARD, ROLL = 32 << 20, 16 << 20
#: Ids, at most, from which the limits of the shards are taken.
SAMPLE = 20_000
# Fixed values of the format.
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'page:{page_id}')}>"


def sha1_text(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def member(
    page_id: int | None, url: str | None, sha: str, size: int, payload: bytes | None, refers_to: int | None = None
) -> bytes:
    """One record, compressed: a response with its payload, or without one a revisit with the response's headers."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}"]
    head += [f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    head.append(f"WARC-Payload-Digest: {sha1_text(bytes.fromhex(sha))}")
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if payload is None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-Id: {refers_to}"]
    else:
        block += payload
    head.append(f"WARC-Block-Digest: {sha1_text(hashlib.sha1(block).digest())}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", 6, mtime=0)


def _headers(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """The lines up to an empty one; None at the end of the file."""
    first = stream.readline()
    if not first:
        return None
    out = {"": first.decode().strip()}
    while (line := stream.readline().decode().rstrip("\r\n")):
        name, _, value = line.partition(": ")
        out[name.lower()] = value
    return out


def records(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of an archive, digests compared with the content."""
    while (head := _headers(stream)) is not None:
        block = stream.read(int(head["content-length"]))
        stream.read(4)
        if head["warc-block-digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
            raise ValueError(f"damaged record {head['warc-record-id']}")
        inner = io.BytesIO(block)
        http = _headers(inner)
        payload = inner.read() if head["warc-type"] == "response" else None
        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
        if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload {head['warc-record-id']}")
        whole = lambda name: int(head[name]) if name in head else None
        yield {
            "page_id": whole("page-id"),
            "payload_bytes": int(http["content-length"]),
            "payload_digest": digest,
            "record_type": head["warc-type"],
            "refers_to": whole("refers-to-page-id"),
            "url": urllib.parse.unquote(head["warc-target-uri"]) if "warc-target-uri" in head else None,
            "payload": payload,
        }


def write_archives(pages: DataFrame, path: str, shard: int = SHARD, roll: int = ROLL) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) under ``path``; returns the stored list (file, n_records, n_bytes, sha256).

    ``path`` is a folder that all executors share, by a URI that Arrow's file systems know. Of equal payloads of at
    least ``LEAST`` bytes the row with the largest id is the response (so is each, if its id repeats) and the others
    revisit it; all are responses if none has an id. A null html is an empty payload, a null url and a null id leave
    their header out. An empty table gives an empty list; other columns are not read.
    """
    ship(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    large = F.length("payload") >= LEAST
    total, count = rows.agg(F.sum(F.length("payload").cast("long") + 500), F.count("*")).first()
    shards = max(1, math.ceil((total or 0) / shard))
    few = rows.select("page_id").where("page_id IS NOT NULL").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE)
    ids = sorted(r["page_id"] for r in few.collect())
    limits = sorted({ids[len(ids) * i // shards] for i in range(1, shards)}) if ids else []
    copies = rows.where(large).groupBy("sha").agg(F.max("page_id").alias("target"), F.count("*").alias("n"))
    copies = copies.where("n > 1 AND target IS NOT NULL").select("sha", "target")
    # Which rows revisit which: ids and digests alone. They meet the records in the writer, so payloads move once.
    revisits = rows.where(large).select("page_id", "sha").join(copies, "sha")
    revisits = revisits.where(~F.col("target").eqNullSafe(F.col("page_id"))).distinct()

    labels = even_labels(pages.sparkSession, shards)

    def dealt(ids: list[int | None], shas: list[str]) -> dict[str, pa.Array]:
        """A row's shard, by its id or, without one, by its payload, and the label of the shard's partition."""
        at = [int(sha[:8], 16) % shards if i is None else bisect_left(limits, i + 1) for i, sha in zip(ids, shas, strict=True)]
        return {"label": pa.array([labels[k] for k in at], pa.int32()), "shard": pa.array(at, pa.int32())}

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch[c].to_pylist() for c in ("page_id", "url", "sha", "payload")]
            made = [member(i, url, sha, len(p), p) for i, url, sha, p in zip(*cols, strict=True)]
            size = pa.array([len(p) for p in cols[3]], pa.int64())
            more = {"size": size, "member": pa.array(made, pa.binary())}
            yield pa.record_batch(dealt(cols[0], cols[2]) | {c: batch[c] for c in ("page_id", "url", "sha")} | more)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = dealt(batch["page_id"].to_pylist(), batch["sha"].to_pylist())
            yield pa.record_batch(at | {c: batch[c] for c in ("page_id", "sha", "target")})

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        files.create_dir(root, recursive=True)
        at, nth, held, size, done = None, 0, [], 0, []

        def close() -> None:
            nonlocal nth, held, size
            if held:
                name, data = f"part-{at:06d}-{nth:05d}.warc.gz", b"".join(held)
                hidden = f"{root}/.{name}.{uuid.uuid4().hex}"
                with files.open_output_stream(hidden, compression=None) as out:
                    out.write(data)
                files.move(hidden, f"{root}/{name}")
                done.append((name, len(held), len(data), hashlib.sha256(data).hexdigest()))
                nth, held, size = nth + 1, [], 0

        refers: dict[tuple[int | None, str], int] = {}
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("shard", "page_id", "url", "sha", "size", "target", "member")]
            for of, page_id, url, sha, n, target, one in zip(*columns, strict=True):
                if of != at:
                    close()
                    at, nth = of, 0
                if one is None:
                    if refers and next(iter(refers))[0] != page_id:
                        refers = {}
                    refers[page_id, sha] = target
                    continue
                if (page_id, sha) in refers:
                    one = member(page_id, url, sha, n, None, refers[page_id, sha])
                held.append(one)
                size += len(one)
                if size >= roll:
                    close()
        close()
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        cols = zip(*done, strict=True) if done else [[]] * 4
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["file", "n_records", "n_bytes", "sha256"])

    schema = "label int, shard int, page_id long, url string, sha string, size long, member binary"
    made = rows.mapInArrow(make, schema).withColumn("target", F.lit(None).cast("long"))
    told = revisits.mapInArrow(place, "label int, shard int, page_id long, sha string, target long")
    made = made.unionByName(told, allowMissingColumns=True).repartition(shards, "label")
    made = made.sortWithinPartitions("shard", "page_id", F.col("member").isNotNull(), "sha", "url")
    listed = made.mapInArrow(put, "file string, n_records long, n_bytes long, sha256 string")
    return stored(listed, "manifest")


def read_archives(listed: DataFrame, path: str, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), and (url, payload), of the listed files' records."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, sha256 in zip(batch["file"].to_pylist(), batch["sha256"].to_pylist(), strict=True):
                with files.open_input_stream(f"{root}/{name}", compression=None) as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != sha256:
                    raise ValueError(f"{name} is not the file that was listed")
                held = []
                for r in records(gzip.open(io.BytesIO(data))):
                    held.append({c: r[c] for c in schema.names})
                    if len(held) == 1000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    kinds += [("record_type", pa.string()), ("refers_to", pa.int64())]
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if with_payload:
        kinds, ddl = [*kinds, ("url", pa.string()), ("payload", pa.binary())], ddl + ", url string, payload binary"
    schema = pa.schema(kinds)
    many = max(1, listed.count())
    return listed.select("file", "sha256").repartition(many).mapInArrow(read, ddl)


def through_archives(pages: DataFrame) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back."""
    path = shared_path(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, path), path)
