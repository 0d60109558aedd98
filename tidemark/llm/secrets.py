"""Secret scans over a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: what every match must contain. Every batch of
documents gets an inverted index of the trigrams that the queries name, by one pass over its texts; postings are intersected and united as the query
says, and only the documents that come out are searched with the pattern. A rule without a mandatory trigram has all
documents searched. The index is divided by documents, so it is built and asked where the documents are, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as sre
import re._parser as parser
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import documents, ship


@dataclass(frozen=True)
class Rule:
    """Finds leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``least`` go."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = 0


# The three base kinds, in their order.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        re.IGNORECASE | re.ASCII,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Public token formats.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE
#: Alternatives of a literal stretch that are kept apart at most; beyond, the stretch ends there.
STRETCHES = 64


def _all(queries: list) -> tuple | None:
    queries = [q for q in dict.fromkeys(queries) if q is not None]
    return queries[0] if len(queries) == 1 else ("and", tuple(queries)) if queries else None


def _any(queries: list) -> tuple | None:
    queries = list(dict.fromkeys(queries))
    if None in queries:
        return None
    return queries[0] if len(queries) == 1 else ("or", tuple(queries))


def _of_strings(strings: set[str]) -> tuple | None:
    """What holds if one of ``strings`` occurs; trigrams are of lower-case letters A-Z."""
    low = sorted({s.translate(LOWER) for s in strings})
    return _any([_all([("has", s[i : i + 3]) for i in range(len(s) - 2)]) for s in low])


LOWER = {c: c + 32 for c in range(65, 91)}


def _strings(node: tuple) -> set[str] | None:
    """All strings a part of a pattern matches, if they are few."""
    op, value = node
    if op is sre.LITERAL:
        return {chr(value)}
    if op is sre.IN and all(o in (sre.LITERAL, sre.RANGE) for o, _ in value):
        size = sum(1 if o is sre.LITERAL else v[1] - v[0] + 1 for o, v in value)
        if size <= 8:
            return {
                chr(c)
                for o, v in value
                for c in ((v,) if o is sre.LITERAL else range(v[0], v[1] + 1))
            }
    if op is sre.SUBPATTERN:
        return _sequence_strings(value[-1])
    if op is sre.BRANCH:
        found = [_sequence_strings(s) for s in value[1]]
        return set().union(*found) if all(f is not None for f in found) else None
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[1] == 1:
        inner = _sequence_strings(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _sequence_strings(nodes: Iterable[tuple]) -> set[str] | None:
    out = {""}
    for node in nodes:
        found = _strings(node)
        if found is None or len(out) * len(found) > STRETCHES:
            return None
        out = {a + b for a in out for b in found}
    return out


def _sequence(nodes: Iterable[tuple]) -> tuple | None:
    """What a match of the parts, one after the other, must contain."""
    queries, stretch = [], {""}
    for node in nodes:
        found = _strings(node)
        if found is not None and len(stretch) * len(found) <= STRETCHES:
            stretch = {a + b for a in stretch for b in found}
            continue
        queries.append(_of_strings(stretch))
        stretch = found if found is not None else {""}
        op, value = node
        if op is sre.SUBPATTERN:
            queries.append(_sequence(value[-1]))
        elif op is sre.BRANCH:
            queries.append(_any([_sequence(s) for s in value[1]]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
            queries.append(_sequence(value[2]))
    return _all([*queries, _of_strings(stretch)])


def trigram_query(pattern: str) -> tuple | None:
    """("has", trigram), ("and", queries), ("or", queries), or None where no trigram is mandatory."""
    return _sequence(parser.parse(pattern))


def named(query: tuple | None) -> set[str]:
    """The trigrams of a query."""
    if query is None:
        return set()
    return {query[1]} if query[0] == "has" else set().union(*map(named, query[1]))


def asked(query: tuple | None, index: dict[str, np.ndarray], count: int) -> np.ndarray:
    """Places of the documents, in order, for which the query holds."""
    if query is None:
        return np.arange(count)
    if query[0] == "has":
        return index[query[1]]
    found = [asked(q, index, count) for q in query[1]]
    out = found[0]
    for f in found[1:]:
        out = np.intersect1d(out, f, assume_unique=True) if query[0] == "and" else np.union1d(out, f)
    return out


#: Bytes of texts whose trigrams are looked at together.
AT_ONCE = 4 << 20


def inverted(texts: list[str], trigrams: Iterable[str]) -> dict[str, np.ndarray]:
    """Postings: for each trigram the places of the texts, lower-cased in A-Z, that contain it.

    The trigrams of the texts are read once, for all that are named together: those whose first two bytes begin a named
    one are compared with the sorted names. A trigram of characters of several bytes holds where all its own do.
    """
    parts = {t: {t.encode()[i : i + 3] for i in range(len(t.encode()) - 2)} for t in trigrams}
    names = sorted(set().union(*parts.values()))
    codes = np.array([int.from_bytes(name, "big") for name in names], np.int64)
    begins = np.zeros(1 << 16, bool)
    begins[codes >> 8] = True
    of: list[list[np.ndarray]] = [[] for _ in names]
    at = 0
    while at < len(texts) and names:
        low, size, first = [], 0, at
        while at < len(texts) and (not low or size < AT_ONCE):
            low.append(texts[at].encode().lower())
            size += len(low[-1])
            at += 1
        ends = np.cumsum([len(x) + 2 for x in low])
        flow = np.frombuffer(b"\0\0".join([*low, b""]), np.uint8)  # no named trigram lies over two texts
        pairs = flow[:-1].astype(np.uint16) << 8 | flow[1:]
        here = np.flatnonzero(begins[pairs[:-1]])
        code = pairs[here].astype(np.int64) << 8 | flow[here + 2]
        name = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        met = codes[name] == code
        text = np.searchsorted(ends, here[met], side="right")
        inside = here[met] + 2 < ends[text] - 2  # a name with a zero byte could reach the border
        found = np.unique(name[met][inside] * (len(low) + 1) + text[inside])
        which, text = found // (len(low) + 1), found % (len(low) + 1)
        starts = np.searchsorted(which, np.arange(len(names) + 1))
        for n in range(len(names)):
            of[n].append(text[starts[n] : starts[n + 1]] + first)
    lists = {name: np.concatenate(o) if o else np.empty(0, np.int64) for name, o in zip(names, of, strict=True)}
    return {t: asked(_all([("has", b) for b in sorted(own)]), lists, len(texts)) for t, own in parts.items()}


def search(rule: Rule) -> re.Pattern:
    """The rule's pattern. A run of one class must be found whole, so its least length can be asked for at once."""
    run = re.fullmatch(r"(\[[^\]^]+\])\+", rule.pattern)
    if run and not rule.group:
        return re.compile(rf"(?<!{run[1]}){run[1]}{{{max(1, rule.least)},}}", rule.flags)
    return re.compile(rule.pattern, rule.flags)


def find(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) of each text in code points, by start and then in the order of the rules."""
    queries = [trigram_query(r.pattern) for r in rules]
    index = inverted(texts, sorted(set().union(*map(named, queries))))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for n, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        pattern = search(rule)
        for i in asked(query, index, len(texts)).tolist():
            for m in pattern.finditer(texts[i]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    out[i].append((m.start(), n, m.end()))
    return [[(a, b, rules[n].kind) for a, n, b in sorted(spans)] for spans in out]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row of ``docs`` (doc_id, text).

    ``spans`` are kind:start:end of all rules, by start and then in the rules' order, joined by commas; ``base_sha256`` is
    the hash of those of the base kinds. A null text is an empty one. Repeated rows get the same result each; ids may be
    null. An empty table gives an empty one; other columns are not read.
    """
    base = [r.kind for r in BASE]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find([t.as_py() or "" for t in batch["text"]], rules)
            own = [[s for s in spans if s[2] in base] for spans in found]
            text = lambda spans: ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
            counts = {f"n_{k}": pa.array([sum(s[2] == k for s in spans) for spans in own], pa.int64()) for k in base}
            digests = [hashlib.sha256(text(spans).encode()).hexdigest() for spans in own]
            more = {"base_sha256": pa.array(digests, pa.string()), "spans": pa.array(map(text, found), pa.string())}
            yield pa.record_batch({"doc_id": batch["doc_id"]} | counts | more)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return documents(docs).select("doc_id", "text").mapInArrow(run, schema)


def masked(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[str]:
    """Texts with every found span replaced by its kind in brackets; spans that overlap are replaced together."""
    out = []
    for text, spans in zip(texts, find(texts, rules), strict=True):
        parts, end = [], 0
        for a, b, kind in spans:
            if a >= end:
                parts += [text[end:a], f"[{kind}]"]
            end = max(end, b)
        out.append("".join([*parts, text[end:]]) if spans else text)
    return out


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked; all rows and columns stay, null texts too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            new = iter(masked([t for t in texts if t is not None], rules))
            at = batch.schema.get_field_index("text")
            text = pa.array([None if t is None else next(new) for t in texts], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), text)

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
