"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tidemark.llm import ann, language, suffixes
from tidemark.llm.ann import nearest
from tidemark.llm.bpe import encode
from tidemark.llm.extract import Templates, extract, main_texts, parse, trained
from tidemark.llm.language import identify, with_language
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.packing import pack, plan
from tidemark.llm.secrets import BASE, asked, find, inverted, mask_secrets, named, scan, trigram_query
from tidemark.llm.simhash import BKTree, keep_first, simhash_components
from tidemark.llm.suffixes import cut_repeats, without_repeats
from tidemark.llm.vectors import in_order
from tidemark.llm.warc import through_archives
from tidemark.llm.words import Tokenizer, vocabulary_path

DOC = "doc_id long, text string, lang string, k1 string, row int, fp string"
VEC = "vec_id long, embedding array<float>, cid string, tile int"


def words(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["tree", "über", "lake", "Run", "of", "42", "naïve,", "x\ny", "don't"]) + str(r.randint(0, 60)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = words(1, 300)
    near = [base.replace("tree", "bush", i) for i in range(1, 30)]
    shared = words(2, 90)
    some = [words(10 + i, 120) + " " + shared + " " + words(50 + i, 60) for i in range(12)]
    odd = [None, "", "   ", "!!! ...", "<|endoftext|>a  b\n\n c <|endoftext|>", "日本語 text 　x", "a" * 30_000, words(3, 9000)]
    return [base, base, base, *near, *some, *odd, words(5, 40), "one"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None][i % 3], "k", i, "f") for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[5], "en", "k", 0, "f"), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def groups(n, links):
    low = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    k = min(4, len(w))
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("shard", [1024, 3])
def test_simhash(docs, empty, shard):
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = groups(len(rows), links)
    low = defaultdict(list)
    for r, g in zip(rows, root, strict=True):
        low[g] += [] if r.doc_id is None else [r.doc_id]
    want = Counter((r.doc_id, f"{f:016x}", min(low[g], default=None)) for r, f, g in zip(rows, fps, root, strict=True))
    assert Counter(map(tuple, simhash_components(docs, shard=shard).collect())) == want
    kept = keep_first(docs, shard=shard)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(v) for v in low.values() if v)
    assert simhash_components(empty).count() == 0 and keep_first(empty).count() == 0


def test_bk_tree_finds_all_within_the_radius():
    r = random.Random(3)
    base = r.getrandbits(64)
    values = {base ^ sum(1 << r.randrange(64) for _ in range(r.randrange(8))) for _ in range(300)}
    values = [v & (1 << 64) - 1 for v in values]
    tree = BKTree(values)
    for q in values[:50]:
        assert sorted(tree.within(q, 4)) == sorted(v for v in values if (v ^ q).bit_count() <= 4)
    tree.take(values[0])
    assert values[0] not in tree.within(values[0], 4)


@pytest.mark.parametrize("bucket", [4096, 2])
def test_repeats(docs, empty, bucket):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = Counter(b[i : i + 400] for _, b in rows for i in range(len(b) - 399))
    want = Counter()
    for doc_id, b in rows:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum() + (np.diff(gone.astype(int)) == 1).sum())
        want[doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()] += 1
    assert Counter(map(tuple, cut_repeats(docs, bucket=bucket).drop("kept").collect())) == want
    left = without_repeats(docs)
    assert left.columns == docs.columns and left.where("doc_id = 3").count() <= 1
    assert cut_repeats(empty).count() == 0


def test_each_place_of_a_long_text_is_listed_once(monkeypatch):
    r = random.Random(6)
    texts = [r.randbytes(n) for n in (50_000, 399, 400, 3_000, 2_400, 1_000, 9_001)] + [b"a" * 9_000, r.randbytes(700) * 9]

    def found():
        return [tuple(map(int, row)) for part in suffixes.listed(texts, 400, 128) for row in zip(*part, strict=True)]

    want = sorted(found())
    for at_once in (4_000, 2_002, 600):
        monkeypatch.setattr(suffixes, "AT_ONCE", at_once)
        assert sorted(found()) == want
    assert len({row[:2] for row in want}) == len(want)


def test_a_long_text_without_repeats_stays_whole(spark):
    r = random.Random(12)
    long = "".join(r.choices("abcdefghijklmnop ", k=950_000))
    rows = [(1, long), (2, long[300_100:300_700] + "x"), (3, "y" + long[599_500:600_600])]
    docs = spark.createDataFrame(rows[:1], "doc_id long, text string")
    assert [tuple(x)[1:4] for x in cut_repeats(docs).collect()] == [(950_000, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: tuple(x)[1:4] for x in cut_repeats(docs).collect()}
    assert got == {1: (950_000, 1_700, 2), 2: (601, 600, 1), 3: (1_101, 1_100, 1)}


def test_bpe_equals_the_library(docs, empty, spark):
    whole = Tokenizer(vocabulary_path()).whole
    want = Counter()
    for r in docs.collect():
        ids = whole.encode(r.text or "", add_special_tokens=False).ids
        back = whole.decode(ids, skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    assert Counter(map(tuple, encode(docs).collect())) == want
    assert {r.decoded for r in encode(docs, with_text=True).collect()} == {r.text or "" for r in docs.collect()}
    assert encode(empty).count() == 0


def test_both_word_patterns_agree_below_u0100():
    t = Tokenizer(vocabulary_path())
    r = random.Random(8)
    for _ in range(3000):
        text = "".join(r.choice("ab 's't  \n\t.!1²ª\x85\xa0\x1cÉ×'llre") for _ in range(r.randrange(30)))
        assert t.latin.findall(text) == t.any.findall(text)
    assert all(t.latin.findall(chr(c) + "a " + chr(c)) == t.any.findall(chr(c) + "a " + chr(c)) for c in range(256))


def test_packing(docs, empty):
    whole = Tokenizer(vocabulary_path()).whole
    want, total = Counter(), 0
    for r in docs.collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 2]
        total += len(ids)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r.doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    found = pack(docs).collect()
    assert Counter(tuple(r)[:5] for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(bins) <= max(-(-total // 1024), sum(r.length > 512 for r in found)) + 2
    assert pack(empty).count() == 0


def test_a_plan_packs_all_pieces():
    r = random.Random(4)
    for _ in range(20):
        counts = {r.randint(1, 100): r.randint(1, 40) for _ in range(r.randint(1, 30))}
        used = Counter()
        for _, bins, places in plan(counts, 100):
            assert sum(k * n for k, n, _ in places) <= 100
            for k, n, _ in places:
                used[k] += n * bins
        assert used == Counter(counts)


def test_secrets(docs, empty, spark):
    import re

    pattern = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    odd = ["ApiKey = 'abcdef12' secret:x token=longer_value", "AKIA" + "A" * 16 + " AKIAshort", "deadbeef" * 4 + " é password: hunter22", None, ""]
    rows = [(i, t) for i, t in enumerate(odd)]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        t = t or ""
        spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(pattern, t, re.ASCII) if len(m[1]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[i].spans == text
    assert scan(empty).count() == 0 and scan(docs).count() == docs.count()
    hidden = mask_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in hidden}[2] == "[hex] é [assign]"


def test_trigram_queries_never_miss():
    assert trigram_query(BASE[2].pattern) is None
    assert named(trigram_query(BASE[1].pattern)) == {"aki", "kia"}
    texts = ["my PassWD=abcdefgh", "api_key: 12345678", "apikey: 12345678", "nothing", "tokens"]
    query = trigram_query(BASE[0].pattern)
    hits = asked(query, inverted(texts, named(query)), len(texts)).tolist()
    assert {0, 1, 2} <= set(hits) and 3 not in hits
    assert [bool(s) for s in find(texts, BASE)] == [True, True, True, False, False]


def test_language(spark, empty):
    r = random.Random(2)
    of = {"aa": ["baka", "lima", "soto"], "bb": ["streng", "schloss", "wurzel"], "cc": ["éaux", "crêpe", "mieux"]}
    rows = [(i, " ".join(r.choice(of[k]) for _ in range(r.randint(2, 40))), k) for i in range(400) for k in [list(of)[i % 3]]]
    rows += [(1000, None, "aa"), (1001, "123 ...", "aa"), (None, "baka soto", None), (1003, "lima " * 20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert np.mean([by[r.doc_id].lang_pred == list(of)[r.doc_id % 3] for r in held]) > 0.97
    assert by[1000].lang_pred == by[1001].lang_pred == "und" and by[None].lang_pred == "aa" == by[1003].lang_pred
    assert with_language(docs).count() == len(rows) - 2
    assert identify(empty).count() == 0


def test_texts_do_not_come_to_the_driver_to_learn(spark, monkeypatch):
    rows = [(i, f"{'baka' if i % 2 else 'streng'}{i} " * 20_000, ["bb", "aa"][i % 2]) for i in range(40)]
    docs = spark.createDataFrame([*rows, (41, " \n", "aa"), (42, None, "cc")], "doc_id long, text string, lang string")
    got, plain = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: [got.append(r) or r for r in plain(df)])
    monkeypatch.setattr(language, "trained", lambda words, labels, languages, seed: (words, labels, languages))
    words, labels, languages = language.learn(docs)
    kept = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert set(words) == {f"{'baka' if i % 2 else 'streng'}{i}".encode() for i in kept}
    assert languages == ["aa", "bb"] and language.WORDS - len(kept) < len(words) <= language.WORDS
    assert all(w.startswith(b"baka") == (languages[k] == "aa") for w, k in zip(words, labels, strict=True))
    assert sum(len(v) for r in got for v in r if isinstance(v, str | bytes | bytearray)) < 20 * language.WORDS


def test_warc_round_trip(spark):
    long = "<p>é" + "x" * 1200
    rows = [(1, "http://a/ü b\r\nX: y", long), (9, None, long), (4, "u", long), (2, "u", "short"), (3, "u", "short"), (5, "u", None)]
    rows += [(None, "n", long), (None, "n", "only" * 400), (7, "u", "z" * 1000), (7, "u", "z" * 1000), (7, "u", "q")]
    got = Counter(map(tuple, through_archives(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()))
    want = Counter()
    for i, _, t in rows:
        b = (t or "").encode()
        top = max((j for j, _, o in rows if o == t and j is not None), default=None)
        revisit = len(b) >= 1000 and top is not None and top != i
        want[i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top if revisit else None] += 1
    assert got == want
    assert through_archives(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_main_text(spark):
    html = (
        "<html><body><header class=top><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></ul></nav><div class=ad>Buy this now.</div>"
        "<article><h1>A title &amp; more</h1><p><b>First  line of the text,\n with a comma.<br><p>Second one is here. And it ends.</p></article>"
        "<div id=comments><p>I like this page.</p></div><script>x()</script><footer>&copy; me</footer>"
    )
    rows = [(1, "u", html, "t"), (2, None, None, "t"), (3, "u", "", "t"), (None, "u", "<p", "t"), (5, "u", "plain words", "t")]
    got = {r.page_id: r for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    want = "A title & more\nFirst line of the text, with a comma.\nSecond one is here. And it ends."
    assert got[1].text == want and got[1].n_chars == len(want)
    assert got[2].text == got[3].text == "" and len(got) == 5


def test_menus_whose_labels_end_like_sentences_are_left_out():
    menu = "".join(f"<li><a href=/{i}>{w}</a></li>" for i, w in enumerate(["Home.", "News", "Who are we?", "lake."]))
    story = "<h1>Lake.</h1><p>The lake is deep, and cold in winter.</p><p>Ships cross it every day of the week.</p>"
    pages = [
        f"<body><nav><ul>{menu}</ul></nav><article>{story}</article><footer>&copy; a.b. All of it.</footer>",
        f"<body><div class=menu><ul>{menu}</ul></div><main>{story}</main><aside><h3>More.</h3><ul>{menu}</ul></aside>",
    ]
    want = "Lake.\nThe lake is deep, and cold in winter.\nShips cross it every day of the week."
    assert main_texts(pages, trained()) == [want, want]


def test_main_text_on_fresh_templates():
    model, new, right = trained(200), Templates(99), 0
    for _ in range(60):
        page = new.page()
        nodes, flow = parse(page)
        mine = [True] * len(nodes)
        for i in range(1, len(nodes)):
            mine[i] = mine[nodes[i].parent] and "data-x" not in nodes[i].attributes
        truth = sum(len(t) for i, t in flow if t and mine[i])
        found = len(main_texts([page], model)[0])
        right += abs(found - truth) < 0.1 * truth + 20
    assert right >= 50


def vectors(spark, seed=1):
    r = np.random.default_rng(seed)
    x = r.standard_normal((150, 8)).astype(np.float32)
    x[:40] = x[0] + 0.05 * r.standard_normal((40, 8))
    x[40:70] = x[40]
    rows = [(i, v.tolist(), "c", 0) for i, v in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] + [1.0] * 7), (904, [1.0, 2.0]), (905, [])]
    return x, spark.createDataFrame([*rows, *[(i, v, "c", 0) for i, v in odd], (None, x[0].tolist(), "c", 0)], VEC)


def test_near_duplicates(spark):
    x, table = vectors(spark)
    x = x.astype(float)
    n = np.sqrt(in_order(x, x))
    link = np.array([[in_order(x[[i]], x[[j]])[0] / (n[i] * n[j]) >= 0.95 for j in range(len(x))] for i in range(len(x))])
    np.fill_diagonal(link, False)
    root = groups(len(x), list(zip(*np.nonzero(link), strict=True)))
    want = {(i, int(link[i].sum()), root[i], root[i] == i) for i in range(len(x))}
    want |= {(i, 0, i, True) for i in range(900, 906)} | {(None, 0, None, False)}
    for tile in (2048, 20):
        assert set(map(tuple, near_duplicates(table, tile=tile).collect())) == want
    assert near_duplicates(spark.createDataFrame([], VEC)).count() == 0


def test_nearest(spark):
    x, table = vectors(spark, 7)
    x = x.astype(float)
    got = defaultdict(list)
    for r in nearest(table, near=10, every=10, success=0.9).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 150, 10))
    hits = 0
    for q, rows in got.items():
        score = in_order(np.broadcast_to(x[q], x.shape), x)
        best = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:10]
        assert [r[0] for r in rows] == list(range(1, 11))
        assert all(s == score[i] for _, i, s in rows)
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        hits += len(set(best) & {i for _, i, _ in rows})
    assert hits >= 0.9 * 10 * len(got)
    few = table.where("vec_id < 5")
    assert nearest(few).count() == 4
    assert nearest(spark.createDataFrame([], VEC)).count() == 0


def test_recall_next_to_many_near_copies(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((4000, 64))
    hot = np.arange(4000) % 4 != 0
    x[hot] = x[1] + 0.02 * r.standard_normal((int(hot.sum()), 64))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for row in nearest(table).collect():
        got[row.query_id].add(row.vec_id)
    x = x.astype(float)
    hits = []
    for q in range(0, 4000, 20):  # none of them is in the group
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(got[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.9, np.mean(hits)


def test_queries_that_found_too_few_are_ranked_part_by_part(spark, monkeypatch, helpers):
    monkeypatch.setattr(ann, "PART", 60)
    x, table = vectors(spark, 7)
    x = x.astype(float)
    again = nearest(table, near=40, every=10, success=1e-6)
    got = defaultdict(list)
    for r in again.orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert set(got) == set(range(0, 150, 10))
    exact = 0
    for q, ids in got.items():
        score = in_order(np.broadcast_to(x[q], x.shape), x)
        exact += ids == [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:40]
    assert exact >= 8
    plan = helpers.plan(again)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


CLASH = "doc_id long, text string, lang string, n_chars long, _k1 int, k1 int, nth int, row int, null int, letters boolean, low string"


def test_columns_of_any_name_come_through_the_stages(spark):
    text = words(77, 500)
    rows = [(i, t, "en", 5, i, i, i, i, i, True, "l") for i, t in enumerate([text, text, "one two three", None, ""])]
    df = spark.createDataFrame(rows, CLASH)
    kept = keep_first(df)
    assert kept.columns == df.columns and sorted(kept.collect()) == sorted(r for r in df.collect() if r.doc_id in (0, 2, 3))
    left = without_repeats(df)
    assert left.columns == df.columns and {r.doc_id: r._k1 for r in left.collect()} == {2: 2, 3: 3, 4: 4}
    known = with_language(df)
    assert known.columns == df.columns and {r.doc_id for r in known.collect()} <= {0, 1, 2}
    assert mask_secrets(df).columns == df.columns
    assert {c for c in scan(df).columns} >= {"doc_id", "spans"} and scan(df).count() == 5


def test_archives_of_pages_with_clashing_columns_and_without_ids(spark):
    big = "x" * 3000
    rows = [(None, f"u{i}", big if i % 2 else f"{i}", 1, "s", b"m") for i in range(40)] + [(7, None, big, 1, "s", b"m")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, shard int, sha string, member binary")
    got = through_archives(df).collect()
    assert len(got) == 41 and Counter(r.record_type for r in got) == {"response": 21, "revisit": 20}
    assert {r.refers_to for r in got} == {None, 7}


@pytest.mark.parametrize("parts", [1, 2, 7, 64])
def test_labels_deal_rows_evenly(spark, parts):
    from tidemark.llm.common import even_labels

    labels = spark.createDataFrame([(k,) for k in even_labels(spark, parts)], "label int").repartition(parts, "label")
    assert labels.rdd.glom().map(len).collect() == [1] * parts
