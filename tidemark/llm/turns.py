"""Repair of conversations whose turns do not alternate, by the Four-Russians method.

A repaired conversation is an optional system turn and then pairs of user and assistant. The cheapest edits are a shortest
path through the turns, with four states: nothing yet, and after a system, a user or an assistant turn. What is still to
pay, by state, is a vector of four costs; less its smallest entry there are only a few such vectors, and there are nine
kinds of turns, so the step of a whole block of turns from one vector to the next is looked up in a table made beforehand.
A conversation is read block by block from its end. For the trace the blocks are then expanded: from the vector at a
block's right border the vectors inside come back one by one, and of the cheapest edits the one first in ASCII order
is taken, from the first turn on. Taking the first of equals is safe that way, since the vectors say what is to
come. A block's trace is kept by vector, block and state.

Everything up to the trace works on one byte for each turn. Texts move once, to be put in order and hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

#: Costs of the edits and of leaving a turn cut short.
REROLE, DELETE, INSERT, LEAVE = 3, 4, 3, 3
#: Turns of a block.
BLOCK = 4
#: Blanks of a text; a text of these alone is blank.
BLANKS = " \t\n\x0b\f\r"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
SYSTEM, USER, ASSISTANT, OTHER = range(4)
#: States: nothing yet, after a system, a user, an assistant turn. What may come next, and where an added turn leads.
NEXT = {0: {SYSTEM: 1, USER: 2}, 1: {USER: 2}, 2: {ASSISTANT: 3}, 3: {USER: 2}}
ADDED = {state: next(to.items().__iter__()) if state else (USER, 2) for state, to in NEXT.items()}
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 20
#: Vector at the end: what it costs to stop in each state.
END = (0, 2 * INSERT, INSERT, 0)


def symbol(fault: int, role: int) -> int:
    """Kinds of turns: 0 must go; the others by role and whether they are cut short."""
    return 0 if fault in (BLANK, DUPLICATE) else 1 + 2 * role + (fault == TRUNCATED)


SYMBOLS = 9


def moves(state: int, kind: int) -> list[tuple[str, int, int]]:
    """Edits of a turn in ASCII order: (initial, cost, next state)."""
    out = [("D", DELETE, state)]
    if kind:
        role, cut = divmod(kind - 1, 2)
        if role in NEXT[state]:
            out.append(("K", LEAVE * cut, NEXT[state][role]))
        out.append(("R", REROLE + LEAVE * cut, ADDED[state][1]))
    return out


def with_added(costs: list[int]) -> tuple[int, ...]:
    """Costs by state where turns may be added first; a second round covers two added turns."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[ADDED[state][1]]) for state, c in enumerate(costs)]
    return tuple(costs)


def before(costs: tuple[int, ...], kind: int) -> tuple[int, ...]:
    """What is to pay before a turn, from what is to pay after it."""
    return with_added([min(c + costs[to] for _, c, to in moves(state, kind)) for state in range(4)])


class Tables:
    """All normalised vectors, their steps over one turn, and over every block of ``size`` turns."""

    def __init__(self, size: int = BLOCK):
        self.size = size
        self.vectors: list[tuple[int, ...]] = [END]
        number = {END: 0}
        step, paid = [], []
        for vector in self.vectors:  # grows while it is read, until no new vector comes
            row = []
            for kind in range(SYMBOLS):
                costs = before(vector, kind)
                least = min(costs)
                new = tuple(c - least for c in costs)
                if new not in number:
                    number[new] = len(self.vectors)
                    self.vectors.append(new)
                row.append((number[new], least))
            step.append([to for to, _ in row])
            paid.append([least for _, least in row])
        self.step, self.paid = np.array(step), np.array(paid)
        # A block is a number in base SYMBOLS, its first turn the highest digit; the last turn is stepped over first.
        to, cost = np.arange(len(self.vectors))[:, None], np.zeros((len(self.vectors), 1), int)
        for _ in range(size):
            to, cost = (
                self.step[to].transpose(0, 2, 1).reshape(len(to), -1),
                (cost[:, :, None] + self.paid[to]).transpose(0, 2, 1).reshape(len(to), -1),
            )
        self.blocks, self.costs = to.tolist(), cost.tolist()
        self.base = SYMBOLS ** np.arange(size)[::-1]
        self.expanded = lru_cache(maxsize=100_000)(self._expanded)

    def _expanded(self, right: int, kinds: bytes, state: int) -> tuple[str, int]:
        """Edits of the turns of a block, the first in ASCII order of the cheapest, and the state after it."""
        inside = [self.vectors[right]]
        for kind in reversed(kinds):
            inside.append(before(inside[-1], kind))
        out = []
        for kind, here, after in zip(kinds, inside[:0:-1], inside[-2::-1], strict=True):
            while True:
                choices = [(e, c + after[to], to) for e, c, to in moves(state, kind)]
                choices.append(("I", INSERT + here[ADDED[state][1]], ADDED[state][1]))
                edit, _, to = min(c for c in choices if c[1] == here[state])
                out.append(edit)
                state = to
                if edit != "I":
                    break
        return "".join(out), state

    def repair(self, kinds: bytes) -> tuple[int, str]:
        """Least cost of a conversation's turns and its edits."""
        whole = len(kinds) - len(kinds) % self.size
        rest = kinds[whole:]
        vector, cost = 0, 0
        for kind in reversed(rest):
            cost += int(self.paid[vector, kind])
            vector = int(self.step[vector, kind])
        after_blocks = vector
        blocks = np.frombuffer(kinds[:whole], np.uint8).reshape(-1, self.size).astype(np.int64) @ self.base
        right = []
        for block in blocks[::-1].tolist():
            right.append(vector)
            cost += self.costs[vector][block]
            vector = self.blocks[vector][block]
        cost += self.vectors[vector][0]
        state, out = 0, []
        for i, vector in enumerate(reversed(right)):
            edits, state = self.expanded(vector, kinds[i * self.size : (i + 1) * self.size], state)
            out.append(edits)
        assert not right or right[0] == after_blocks
        edits, state = self.expanded(0, rest, state)
        out.append(edits)
        while END[state]:
            out.append("I")
            state = ADDED[state][1]
        return cost, "".join(out)


@cache
def tables(size: int = BLOCK) -> Tables:
    return Tables(size)


def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): what is read, in order of these; a null role or text is one space."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), of("role"), of("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults put in, chosen by the CRC-32 of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the turn, 1 empties its text, 2 takes out full stops, question and exclamation marks, 3 repeats it, 4 makes
    its role user.
    """
    rows = rows_of(conversations)
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    hurt = rows.withColumn("kind", F.crc32(name.cast("binary")) % 20).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def _place() -> list[Column]:
    """The order of turns in a conversation: nulls first; ties by role, then by the text's SHA-256."""
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("key").asc()]


def packs(rows: DataFrame) -> DataFrame:
    """(conv_id, first, codes, turns): a conversation's turns in order, one byte each, a row for each task that has some.

    Equal turns are counted before they are sorted. A code is the fault in its high bits and the role in its low two.
    ``first`` is the first turn's place, ``turns`` the lowest and highest turn number and how many there are.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    key = F.unhex(F.sha2("text", 256))
    one = rows.select("conv_id", "turn", "role", key.alias("key"), (fault * 4 + role).cast("int").alias("code"))
    counted = one.groupBy("conv_id", "turn", "role", "key", "code").count()
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = counted.groupBy("conv_id", "role", "key").agg(F.min(at).alias("at"))
    names = {c: F.col(c).alias(f"of_{c}") for c in ("conv_id", "role", "key")}
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in names]
    told = counted.join(firsts.select(*names.values(), "at"), same).withColumn("early", F.col("at").eqNullSafe(at))
    in_order = told.repartitionByRange("conv_id", "turn", "role", "key").sortWithinPartitions("conv_id", *_place())

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, first, codes, turns, held, size = None, None, bytearray(), None, [], 0

        def done() -> pa.RecordBatch:
            nonlocal held, size
            out, held, size = held, [], 0
            return pa.RecordBatch.from_pylist(out, kind)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "role", "key", "code", "count", "early")]
            for conv_id, turn, role, key, code, count, early in zip(*columns, strict=True):
                if first is None or conv_id != conv:
                    if first is not None:
                        held.append({"conv_id": conv, "first": first, "codes": bytes(codes), "turns": turns})
                        size += len(codes)
                    conv, codes = conv_id, bytearray()
                    first = {"has_turn": turn is not None, "turn": turn, "role": role, "key": key}
                    turns = {"low": turn, "high": turn, "n": int(turn is not None)}
                    if len(held) >= 5000 or size > 4 << 20:
                        yield done()
                elif turn is not None and turn != turns["high"]:
                    turns = {"low": turn if turns["low"] is None else turns["low"], "high": turn, "n": turns["n"] + 1}
                again = code if code >> 2 == BLANK else DUPLICATE << 2 | code & 3
                codes += bytes([code if early else again]) + bytes([again]) * (count - 1)
        if first is not None:
            held.append({"conv_id": conv, "first": first, "codes": bytes(codes), "turns": turns})
        if held:
            yield done()

    place = pa.struct([("has_turn", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("key", pa.binary())])
    span = pa.struct([("low", pa.int64()), ("high", pa.int64()), ("n", pa.int64())])
    kind = pa.schema([("conv_id", pa.int64()), ("first", place), ("codes", pa.binary()), ("turns", span)])
    ddl = "conv_id long, first struct<has_turn:boolean,turn:long,role:string,key:binary>, codes binary, turns struct<low:long,high:long,n:long>"
    return in_order.mapInArrow(pack, ddl)


def scripts(conversations: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``conversations``,
    from its turns in ``rows``.

    A conversation's codes come together in one row: that is one byte for a turn, as ``audit`` has.
    """
    whole = packs(rows).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("first", "codes", "turns"))).alias("packs"))

    def repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = tables(block)
        kinds = np.array([symbol(code >> 2, code & 3) for code in range(16)], np.uint8)
        legal = np.zeros(16, bool)
        legal[[SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER]] = True
        for batch in batches:
            out = []
            for conv_id, parts in zip(batch["conv_id"].to_pylist(), batch["packs"].to_pylist(), strict=True):
                codes = np.frombuffer(b"".join(p["codes"] for p in parts), np.uint8)
                faults, roles = np.bincount(codes >> 2, minlength=4), codes & 3
                spans = [p["turns"] for p in parts if p["turns"]["n"]]
                shared = sum(a["high"] == b["low"] for a, b in zip(spans, spans[1:], strict=False))
                n = sum(s["n"] for s in spans) - shared
                gaps = spans[-1]["high"] - spans[0]["low"] + 1 - n if spans else 0
                cost, audit = made.repair(kinds[codes].tobytes())
                illegal = len(codes) - 1 - int(legal[roles[:-1] * 4 + roles[1:]].sum())
                out.append((conv_id, min(gaps, 2**63 - 1), *faults[1:].tolist(), illegal, cost, audit))
            columns = list(zip(*out, strict=True))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 7 + [pa.string()], strict=True)], names)

    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    ddl = ", ".join(f"{n} long" for n in names[:-1]) + ", audit string"
    found = whole.mapInArrow(repair, ddl).withColumnRenamed("conv_id", "of")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    return joined.fillna(0, names[1:-1]).fillna("", ["audit"])


def edited(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each turn that is left or added, in order."""
    state, roles = 0, {"s": SYSTEM, "u": USER, "a": ASSISTANT}
    for edit in audit:
        if edit == "I":
            role, state = ADDED[state]
            yield edit, NAMES[role], ""
            continue
        role, text = next(turns)
        if edit == "K":
            state = NEXT[state][roles[role[:1]]]
            yield edit, role, text
        elif edit == "R":
            to, state = ADDED[state]
            yield edit, NAMES[to], text


def repaired(conversations: DataFrame, rows: DataFrame | None = None, block: int = BLOCK, with_turns: bool = False) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation, or
    with ``with_turns`` its repaired turns (conv_id, place, edit, role, text).

    ``conversations`` has (conv_id, turn, role, text); ``rows`` are the turns to repair if not these, for instance what
    ``damaged`` makes of them. A null role or text is one space. Turns are taken by number, nulls first; ties, which no
    rule orders, by role and the text's SHA-256. A turn is blank, or else a duplicate of an earlier one in role and text, or
    else truncated if it does not end in a full stop, a question or an exclamation mark. ``gaps`` are missing numbers, ``illegal``
    neighbours whose roles may not follow each other. ``audit`` has the initials of the cheapest edits: Keep, Rerole,
    Delete, Insert; of several the first in ASCII order. ``repaired_sha256`` is of the repaired ``role:text`` joined by newlines.
    Rows without conv_id are one conversation. A conversation without turns has zeros, no edits, and the hash of nothing.
    An empty table gives an empty one; other columns are not read.

    The hash of a conversation is one chain over its texts, so these pass one task, in a stream; nothing of it is held but
    the audit. All other steps divide long conversations, too.
    """
    ship(conversations.sparkSession)
    rows = rows_of(conversations) if rows is None else rows
    told = scripts(conversations, rows, block)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    own = rows.select("conv_id", F.lit(True).alias("is_turn"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("key"), "text", F.lit(None).cast("array<long>").alias("told"))
    head = told.select(
        "conv_id", F.lit(False).alias("is_turn"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("key"), F.col("audit").alias("text"), F.array(*numbers).alias("told"),
    )
    both = head.union(own).repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", *_place())
    lines = both.select("conv_id", "is_turn", "role", "text", "told")

    def put_in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns(rest: list) -> Iterator[tuple[str, str]]:
            while rest or fill():
                if line_is_head(rest[-1]):
                    return
                _, _, role, text, _ = rest.pop()
                yield role, text

        source = iter(batches)
        waiting: list[tuple] = []

        def line_is_head(line: tuple) -> bool:
            return not line[1]

        def fill() -> bool:
            for batch in source:
                columns = [batch[c].to_pylist() for c in ("conv_id", "is_turn", "role", "text", "told")]
                waiting.extend(list(zip(*columns, strict=True))[::-1])
                if waiting:
                    return True
            return False

        held = []
        while waiting or fill():
            conv_id, _, _, audit, told = waiting.pop()
            of = edited(audit, turns(waiting))
            if with_turns:
                for place, (edit, role, text) in enumerate(of):
                    held.append((conv_id, place, edit, role, text))
                    if len(held) >= 1000:
                        yield batch_of(held)
                        held = []
            else:
                digest = hashlib.sha256()
                for n, (_, role, text) in enumerate(of):
                    digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
                held.append((conv_id, *told, audit, digest.hexdigest()))
            for _ in turns(waiting):  # deleted turns at the end of the last edit
                pass
            if len(held) >= 1000:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)

    if with_turns:
        names, kinds = ["conv_id", "place", "edit", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        ddl = "conv_id long, place long, edit string, role string, text string"
    else:
        names, kinds = ["conv_id", *numbers, "audit", "repaired_sha256"], [pa.int64()] * 7 + [pa.string()] * 2
        ddl = ", ".join(f"{n} long" for n in names[:7]) + ", audit string, repaired_sha256 string"
    return lines.mapInArrow(put_in_order, ddl)
