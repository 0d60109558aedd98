"""Collocations against plain counting of all runs of words."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import phrases
from tidemark.llm.phrases import Numbers, collocations, merged, pack, positions, sliced, unpack, unpack_rising

DOC = "doc_id long, text string, lang string, word string, n long, chunk string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, longest, least, covered, most):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    often = {p: c for p, c in f.items() if len(p) > 2 and c >= least}
    for (lang, *p), a in often.items():
        cuts = [((1_000_000 * a * a) // (f[lang, *p[:k]] * f[lang, *p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        inside = any(
            q[0] == lang and len(q) > len(p) + 1 and 100 * c >= covered * a and any(list(q[i : i + len(p)]) == p for i in range(1, len(q) - len(p) + 1))
            for q, c in often.items()
        )
        if not inside:
            out.append((lang, -score, -a, " ".join(p).encode(), f[lang, *p[:k]], f[lang, *p[k:]]))
    ranks, got = Counter(), []
    for lang, score, a, p, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= most:
            got.append((lang, ranks[lang], p.decode(), -a, left, right, n[lang], -score))
    return sorted(got)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(12)
    words = ["Tree", "tree", "of", "the", "ÉTÉ", "日本", "life", "a\x00b", "x\x1cy", "it's"]
    some = lambda n: "".join(r.choice(words) + r.choice([" ", " ", " ", "\t ", ". ", "\n", ",", "  "]) for _ in range(n))
    out = [(i, some(r.randint(0, 60)), r.choice(["en", "en", "en", "de", None, ""])) for i in range(60)]
    out += [(100 + i, "new york city hall. in new york city", "en") for i in range(14)] + [(1, None, "en"), (None, "", "fr"), (2, " .,; ", None)]
    return out + [(3, "the the the the", "en")] * 12 + [(4, some(4000), "en"), (5, "w" * 5000 + " of the", "en"), (6, "only", "lonely")]


@pytest.mark.parametrize(
    "longest, least, covered, most, chunk, shard, cut",
    [(3, 10, 50, 2000, 8 << 20, 500_000, 4 << 20), (3, 4, 80, 7, 300, 9, 64), (4, 6, 50, 50, 2000, 100, 1000), (2, 10, 50, 2000, 100, 30, 50)],
)
def test_collocations(spark, rows, monkeypatch, longest, least, covered, most, chunk, shard, cut):
    monkeypatch.setattr(phrases, "SLICE", cut)
    monkeypatch.setattr(phrases, "BUCKET", 10_000)
    df = spark.createDataFrame([(*r, "w", 1, "c") for r in rows], DOC).repartition(3)
    got = collocations(df, longest, least, covered, most, chunk, shard)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, longest, least, covered, most)


def test_empty_tables(spark):
    df = spark.createDataFrame([], DOC)
    assert collocations(df).count() == 0
    assert collocations(spark.createDataFrame([(1, None, None, "w", 1, "c"), (2, "one two", "en", "w", 1, "c")], DOC)).count() == 0


def test_the_names_of_stored_tables_go(spark, rows):
    before = spark.catalog.listTables()
    collocations(spark.createDataFrame([(*r, "w", 1, "c") for r in rows], DOC)).count()
    assert spark.catalog.listTables() == before


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_037_000_499_123
    row = spark.range(1).select(phrases.scored(*[phrases.F.lit(v).cast("long") for v in (big, big + 1, big + 7)]).alias("s")).first()
    assert row.s == 1_000_000 * big * big // ((big + 1) * (big + 7))


def test_parts():
    text = b"aa bb\nccc " * 50 + b"d" * 300 + b" e"
    for most in (1, 7, 64, 10_000):
        assert b"".join(sliced(text, most)) == text
        assert np.array_equal(np.concatenate(positions(text, Numbers(), most)), np.concatenate(positions(text, Numbers())))
    for top in (0, 255, 256, 70_000, 1 << 40):
        x = np.sort(np.random.default_rng(top).integers(0, top + 1, 100))
        assert np.array_equal(unpack(pack(x)), x) and np.array_equal(unpack_rising(phrases.pack_rising(x)), x)
    at, word = np.array([0, 1, 2, 5, 6]), np.array([7, 8, 9, 7, 8])
    assert [x.tolist() for x in merged(at, word, at + 1, word)] == [[1, 2, 6], [7, 8, 7], [8, 9, 8]]
