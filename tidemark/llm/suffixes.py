"""Exact removal of long repeated passages by bucket-pointer refinement of suffixes.

A suffix is compared by its first ``length`` bytes. Its buckets carry names instead of ranks: the name of a string is a
number computed from its bytes, so tasks agree on it without a common order. Names of single bytes are joined to names
of 2, 4, 8 ... bytes, each from the names at the offset and at the later offset half a length on, so every round reuses
the one before.

1. Buckets of q-grams. Of the suffixes in a run only the one that owns their smallest q-gram is listed (leftmost on
   ties): equal ``length``-byte strings own the same q-gram at the same place, so none is lost, and about one suffix in
   140 is listed. Suffixes whose q-gram is alone are done: nothing in their run repeats.
2. Each remaining bucket is split by the name of all that the run's strings can reach. Where that repeats, the whole run
   repeats.
3. What is left - mostly ends of passages - is split by names of ``length`` bytes, for each start of the run. Buckets
   up to ``BUCKET`` rows do so in one task. In larger ones tasks first count the names of their own rows, and the counts
   meet by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, free_name, stored

LENGTH, GRAM = 400, 128
BUCKET = 4096
#: Bytes named at once; positions among them take 20 bits.
AT_ONCE = 600_000
PLACE = np.uint64((1 << 20) - 1)


def names(data: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """The name of the ``length`` bytes from each offset on; ``lane`` chooses one of independent namings."""
    if len(data) < length:
        return np.empty(0, np.uint64)
    h = data.astype(np.uint64) + np.uint64(1 + 1000 * lane)
    c = (0x9E3779B97F4A7C15 + 2 * lane * 0xD1B54A32D192ED03) % (1 << 64) | 1
    size, done, out = 1, 0, None
    while True:
        if length & size:
            if out is None:
                out = h
            else:
                n = len(data) - done - size + 1
                out = out[:n] * np.uint64(c) + h[done : done + n]
                out ^= out >> np.uint64(30)
            done += size
        if size * 2 > length:
            break
        h = h[:-size] * np.uint64(c) + h[size:]
        h ^= h >> np.uint64(29)
        c = (c * 0xBF58476D1CE4E5B9 + 2) % (1 << 64) | 1
        size *= 2
    out = out * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first start, last start, name of the q-gram) of each listed suffix; ``data`` of at most 2^20 bytes."""
    g = names(data, gram)
    low = smallest((g & ~PLACE) | np.arange(len(g), dtype=np.uint64), length - gram + 1)
    place = (low & PLACE).astype(np.int64)
    turn = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate([[0], turn])
    last = np.concatenate([turn, [len(place)]]) - 1
    at = place[first]
    return at, first, last, g[at].view(np.int64)


def _cut(texts: list[bytes], length: int, gram: int) -> Iterator[list[tuple[int, int, int, int]]]:
    """(text, from, to, first start) parts, some at once. A part owns the runs that begin at its first start or at one of
    the ``AT_ONCE // 2`` - 1 next; it has one start more in front, to see a run that began earlier, and at its end as many
    more as its last run can reach. So each run of a text is whole in the one part that owns it.
    """
    held, size, step = [], 0, AT_ONCE // 2
    for n, text in enumerate(texts):
        for start in range(0, max(0, len(text) - length + 1), step):
            begin, stop = max(0, start - 1), min(len(text), start + step + 2 * length - gram - 1)
            held.append((n, begin, stop, start))
            size += stop - begin
            if size > step:
                yield held
                held, size = [], 0
    if held:
        yield held


def listed(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, place, first, last, q-gram, reach) of the listed suffixes; ``reach`` names all that the run can reach.

    Each place of a text is listed once.
    """
    for parts in _cut(texts, length, gram):
        data = np.frombuffer(b"".join(texts[n][i:j] for n, i, j, _ in parts), np.uint8)
        at, first, last, g = runs(data, length, gram)
        begin = np.cumsum([0, *(j - i for _, i, j, _ in parts)])
        # Strings must lie within one part: cut each run to its part's starts, once for every part it touches.
        out = []
        for k, (n, i, _, start) in enumerate(parts):
            low, high = begin[k], begin[k + 1] - length
            a = np.searchsorted(last, low)
            b = np.searchsorted(first, high, side="right")
            shift = i - low
            begins = np.maximum(first[a:b], low) + shift
            own = (begins >= start) & (begins < start + AT_ONCE // 2)
            out.append(
                (
                    np.full(own.sum(), n),
                    (at[a:b] + shift)[own],
                    begins[own],
                    (np.minimum(last[a:b], high) + shift)[own],
                    g[a:b][own],
                )
            )
        text, at, first, last, g = (np.concatenate(x) for x in zip(*out, strict=True))
        before, after, reach = length - gram, length, []
        for n, p in zip(text.tolist(), at.tolist(), strict=True):
            t = texts[n]
            low, high = max(0, p - before), min(len(t), p + after)
            reach.append(xxhash.xxh3_64_intdigest(t[low:high], (p - low) << 10 | (high - p)))
        yield text, at, first, last, g, np.array(reach, np.uint64).view(np.int64)


def window_names(context: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start in the row, name, second name) of every ``length``-byte string of the rows."""
    data = np.frombuffer(b"".join(context), np.uint8)
    starts = [np.arange(len(c) - length + 1) for c in context]
    begin = np.cumsum([0, *map(len, context)])
    row = np.repeat(np.arange(len(context)), [len(s) for s in starts])
    start = np.concatenate(starts)
    at = begin[row] + start
    return row, start, names(data, length)[at], names(data, length, 1)[at]


def _repeated(*keys: np.ndarray) -> np.ndarray:
    """How often each row's keys occur."""
    order = np.lexsort(keys)
    change = np.zeros(len(order), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[order][1:] != k[order][:-1]
    group = np.cumsum(change) - 1
    out = np.empty(len(order), np.int64)
    out[order] = np.bincount(group)[group] if len(order) else 0
    return out


def _stretches(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of neighbouring starts of a row."""
    if not len(row):
        return row, start, start
    turn = np.flatnonzero((np.diff(row) != 0) | (np.diff(start) != 1)) + 1
    first = np.concatenate([[0], turn])
    last = np.concatenate([turn, [len(row)]]) - 1
    return row[first], start[first], start[last]


def _packed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, k1, k2, z) and the row that is carried: texts compressed before they are shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor()
        for batch in batches:
            z = pa.array([small.compress(t.as_py() or b"") for t in batch["text"]], pa.binary())
            yield pa.record_batch({c: z if c == "text" else batch[c] for c in batch.schema.names})

    own = documents(docs, carry).withColumn("text", F.col("text").cast("binary"))
    return own.mapInArrow(run, own.schema).withColumnRenamed("text", "z")


def repeated_spans(
    docs: DataFrame, packed: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET
) -> DataFrame:
    """(k1, k2, first, last): stretches of starts whose ``length``-byte strings start elsewhere too.

    ``packed`` are the compressed texts of ``docs``.
    """

    def list_suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch["text"]]
            for text, _, first, last, g, reach in listed(texts, length, gram):
                who = pa.array(text)
                own = {"k1": batch["k1"].take(who), "k2": batch["k2"].take(who)}
                starts = {"first": first.astype(np.int32), "last": last.astype(np.int32)}
                yield pa.record_batch(own | starts | {"gram": g, "reach": reach})

    def lines(**columns: np.ndarray) -> pa.RecordBatch:
        """A batch of what buckets hold; what is not given is zero or empty."""
        n = len(columns["key"])
        zero = pa.array(np.zeros(n, np.int64))
        given = {c: pa.array(v) for c, v in columns.items()}
        plain = {c: given.get(c, zero) for c in ("key", "name", "n", "k1", "k2", "first", "last")}
        return pa.record_batch(plain | {"context": given.get("context", pa.nulls(n, pa.binary()))})

    def open_rows(rows: list[tuple]) -> pa.RecordBatch:
        key, k1, k2, first, context = zip(*rows, strict=True)
        return lines(
            key=np.array(key), k1=np.array(k1), k2=np.array(k2), first=np.array(first), context=list(context)
        )

    def name_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Rows of large buckets: each name with its count among them, and its owner where it occurs once."""
        _, k1, k2, base, context = zip(*rows, strict=True)
        row, start, w1, w2 = window_names(list(context), length)
        n = _repeated(w1, w2)
        k1, k2, own = np.array(k1)[row], np.array(k2)[row], np.array(base)[row] + start
        many = np.flatnonzero(n > 1)
        _, seen = np.unique(w1[many], return_index=True)  # one line for a name that occurs more often here
        line = np.concatenate([np.flatnonzero(n == 1), many[seen]])
        yield lines(
            key=w1[line].view(np.int64), name=w2[line].view(np.int64), n=n[line], k1=k1[line], k2=k2[line],
            first=own[line], last=own[line],
        )
        r, first, last = _stretches(row[many], own[many])
        if len(r):  # these are found already: a line with a count of two is passed on as it is
            at = np.searchsorted(row, r)
            yield lines(
                key=w1[at].view(np.int64), name=w2[at].view(np.int64) ^ 1, n=np.full(len(r), 2), k1=k1[at], k2=k2[at],
                first=first, last=last,
            )

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = zstandard.ZstdDecompressor()
        few, many = [], []
        for batch in batches:
            for k1, k2, z, runs_of in zip(*(batch[c].to_pylist() for c in ("k1", "k2", "z", "open")), strict=True):
                text = large.decompress(z)
                for r in runs_of:
                    row = (r["gram"], k1, k2, r["first"], text[r["first"] : r["last"] + length])
                    (many if r["many"] else few).append(row)
                if len(few) > 5000:
                    yield open_rows(few)
                    few = []
                if len(many) > 3000:
                    yield from name_rows(many)
                    many = []
        if few:
            yield open_rows(few)
        if many:
            yield from name_rows(many)

    def found(k1: np.ndarray, k2: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"k1": k1, "k2": k2, "first": first, "last": last})

    def solved(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """What repeats in whole buckets."""
        named = table.filter(pc.greater(table["n"], 0))
        if named.num_rows:
            key, name, n, k1, k2, first, last = (named[c].to_numpy() for c in named.schema.names[:7])
            both = (_repeated(key, name) > 1) | (n > 1)
            yield found(k1[both], k2[both], first[both], last[both])
        table = table.filter(pc.equal(table["n"], 0))
        if table.num_rows:
            row, start, w1, w2 = window_names(table["context"].to_pylist(), length)
            key, k1, k2, base = (table[c].to_numpy() for c in ("key", "k1", "k2", "first"))
            twice = _repeated(w1, w2, key[row]) > 1
            row, first, last = _stretches(row[twice], start[twice])
            yield found(k1[row], k2[row], base[row] + first, base[row] + last)

    def refine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partitions sorted by bucket: takes whole buckets, some at once."""
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                held.append(batch.slice(i, 2000))
                count += held[-1].num_rows
                if count < 2000 or (len(held) > 1 and held[0]["key"][0] == held[-1]["key"][-1]):
                    continue
                table = pa.Table.from_batches(held)
                g = table["key"].to_numpy()
                whole = int(np.argmax(g == g[-1]))
                if whole:
                    yield from solved(table.slice(0, whole))
                    held = table.slice(whole).combine_chunks().to_batches()
                    count = sum(b.num_rows for b in held)
        if held:
            yield from solved(pa.Table.from_batches(held))

    keys = ["k1", "k2"]
    texts = documents(docs).select(*keys, F.col("text").cast("binary").alias("text"))
    schema = "k1 long, k2 long, first int, last int, gram long, reach long"
    suffixes = stored(texts.mapInArrow(list_suffixes, schema), "suffixes")
    # Counts are stored before they are joined: then both sides are plain, and a hot key's rows can be split.
    grams = stored(suffixes.groupBy("gram").count().where("count > 1").select("gram"), "grams")
    shared = stored(suffixes.join(grams, "gram"), "shared")
    row = F.struct(*keys, "first", "last")
    classes = shared.groupBy("gram", "reach").agg(F.count("*").alias("n"), F.min(row).alias("row"))
    classes = stored(classes, "classes")
    twice = classes.where("n > 1").select("gram", "reach")
    whole = shared.join(twice, ["gram", "reach"], "semi").select(
        *keys, F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last")
    )
    # A class of equal runs sends one row along: other runs may hold some of its strings.
    kinds = classes.groupBy("gram").count().where("count > 1").select("gram", (F.col("count") > bucket).alias("many"))
    kinds = stored(kinds, "kinds")
    still = classes.join(kinds, "gram").select(
        "row.k1", "row.k2", F.struct("gram", "many", "row.first", "row.last").alias("open")
    )
    still = still.groupBy(*keys).agg(F.collect_list("open").alias("open"))
    schema = "key long, name long, n long, k1 long, k2 long, first long, last long, context binary"
    opened = packed.join(still, keys).mapInArrow(contexts, schema)
    refined = opened.repartition("key").sortWithinPartitions("key")
    return whole.union(refined.mapInArrow(refine, "k1 long, k2 long, first long, last long"))


def cut_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET, carry: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): texts without what repeats.

    Removed is every byte of a ``length``-byte string that starts anywhere else too, in the same text or another;
    strings are judged on the input and never reach over two texts. ``n_spans`` counts maximal removed runs, ``kept`` is
    what is left, as bytes. A null text is an empty one; shorter texts than ``length`` stay whole. Rows repeated in id
    and text are texts of their own, so each loses all of a text of ``length`` or more. Ids may be null. An empty table
    gives an empty one; other columns are not read. With ``carry`` they come back in the struct ``row``, and ``kept_text``
    is what is left as text, without bytes that are no whole character.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for z, spans in zip(batch["z"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                text = large.decompress(z)
                kept, end, removed, n = [], 0, 0, 0
                for s in sorted((s["first"], s["last"] + length) for s in spans or ()):
                    if s[0] > end or not n:
                        kept.append(text[end : s[0]])
                        removed += s[1] - s[0]
                        n, end = n + 1, s[1]
                    elif s[1] > end:
                        removed, end = removed + s[1] - end, s[1]
                rest = b"".join([*kept, text[end:]])
                line = (len(text), removed, n, hashlib.sha256(rest).hexdigest(), rest)
                out.append((*line, rest.decode("utf-8", "ignore")) if carry else line)
            if out:
                made = {c: pa.array(v, k) for (c, k), v in zip(kinds.items(), zip(*out, strict=True), strict=True)}
                yield pa.record_batch({c: batch[c] for c in ("doc_id", "row")[: 1 + carry]} | made)

    number = pa.int64()
    kinds = {"n_bytes": number, "n_removed": number, "n_spans": number, "kept_sha256": pa.string(), "kept": pa.binary()}
    kinds |= {"kept_text": pa.string()} if carry else {}
    packed = _packed(docs, carry)
    spans = repeated_spans(docs, packed, length, gram, bucket).distinct()
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    both = packed.join(spans, ["k1", "k2"], "left").drop("k1", "k2")
    schema = both.select(
        *("doc_id", "row")[: 1 + carry],
        *[F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")],
        F.lit("").alias("kept_sha256"),
        F.col("z").alias("kept"),
        *[F.lit("").alias("kept_text")] * carry,
    ).schema
    return both.mapInArrow(cut, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with what repeats taken out of ``text``, and ``n_chars`` as it is then; a text left empty goes.

    Characters that a cut goes through are dropped with it. Texts that lose nothing stay, empty and null ones too.
    """
    null = free_name(docs, "null")
    rows = cut_repeats(docs.withColumn(null, F.col("text").isNull()), carry=True)
    rows = rows.where((F.col("n_removed") == 0) | (F.trim("kept_text") != ""))
    made = {"text": F.when(~F.col("row")[null], F.col("kept_text")).alias("text")}
    if "n_chars" in docs.columns:
        n = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars"))
        made["n_chars"] = n.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return rows.select(*[made.get(c, F.col("row")[c].alias(c)) for c in docs.columns])
