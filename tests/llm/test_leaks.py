"""Benchmark decontamination against a plain search for every window."""

import hashlib
import random
import re

import pytest

from tidemark.llm import leaks
from tidemark.llm.leaks import contaminated, places, words_of

DOC = "doc_id long, text string, k1 string, words string, item_id long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(texts, items, size):
    """(n_words, n_hit, ids, hit words) of each text, by trying every window at every place."""
    out = []
    for text in texts:
        w, hit, ids = WORD.findall(lowered(text)), set(), set()
        for item, of in items:
            v = WORD.findall(lowered(of))
            n = min(size, len(v))
            runs = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in runs:
                    hit.update(range(i, i + n))
                    ids |= set() if item is None else {item}
        out.append((len(w), len(hit), ids, hit))
    return out


def digest(ids):
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(11)
    some = lambda n: "".join(r.choice(["Red", "blue", "ÉTÉ", "été", "日本", "7up", "go"]) + r.choice([" ", "-", "\n", "… ", "_\t"]) for _ in range(n))
    items = [(i, some(r.randint(4, 40))) for i in range(12)]
    items += [(40, "one"), (41, "Red  blue"), (42, ""), (43, None), (None, some(15)), (44, "  --  "), (0, some(9))]
    items += [(100 + i, items[3][1]) for i in range(5)] + [(200, some(300)), (200, "xyzzy plugh"), (200, "xyzzy plugh")]
    texts = [some(r.randint(0, 60)) for _ in range(30)]
    texts += [a + " " + (i[1] or "") + "|" + b for i, a, b in zip(items, texts, texts[1:], strict=False)]
    texts += [None, "", "!!", items[-3][1], "ONE", texts[0], some(900) + items[-3][1] + some(900), "É" + items[0][1]]
    rows = [(n, t, "k", "w", 5) for n, t in enumerate(texts)] + [(0, texts[0], "k", "w", 5), (None, texts[33], None, None, None)]
    return rows, items, spark.createDataFrame(rows, DOC).repartition(3), spark.createDataFrame([(*i, "t", 1) for i in items], "item_id long, text string, words string, n int").repartition(2)


@pytest.mark.parametrize("size, share, row, held", [(10, 200_000, 2000, 1 << 25), (4, 30, 20, 500), (1, 100, 30, 10)])
def test_hits(spark, tables, monkeypatch, size, share, row, held):
    rows, items, docs, bench = tables
    monkeypatch.setattr(leaks, "ROW", row)
    monkeypatch.setattr(leaks, "HELD", held)
    want = []
    spans = {}
    for r, (n, hit, ids, at) in zip(rows, brute([r[1] for r in rows], items, size), strict=True):
        want.append((r[0], n, hit, len(ids), digest(ids), hit > 0))
        spans[r[0]] = (r[1], at)
    df = contaminated(docs, bench, size, share, with_spans=True)
    got = df.collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    for r in got:
        text, at = spans[r.doc_id]
        starts = [m.span() for m in WORD.finditer(lowered(text))]
        inside = {i for i, (a, b) in enumerate(starts) for s in r.spans if s.start <= a and b <= s.end}
        assert inside == at


def test_shares_lose_nothing(spark, tables):
    _, _, _, bench = tables
    sent = leaks.shares(bench, 10, 25)
    assert len(sent) > 4
    assert sum(len(s.value) for s in sent) == len({r for s in sent for r, _ in s.value})


def test_empty_tables(spark, tables):
    _, _, docs, bench = tables
    assert contaminated(docs.limit(0), bench).count() == 0
    clean = contaminated(docs, bench.limit(0)).collect()
    assert len(clean) == docs.count()
    assert all(not r.contaminated and r.n_hit == 0 and r.items_sha256 == digest(()) for r in clean)


def test_words_are_those_of_the_pattern():
    for text in ("Zoë's 3.5% naïve_X\x7f\x80ok\x00 日本　語", "ABC" * 3, " a"):
        assert [w.decode() for w in words_of(text.encode())] == WORD.findall(lowered(text))
        assert [lowered(text[a:b]) for a, b in places(text, [(i, i + 1) for i in range(len(WORD.findall(lowered(text))))])] == WORD.findall(lowered(text))
