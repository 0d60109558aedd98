"""The whole pipeline over the given documents, against each stage by brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import brute_fingerprint, groups

import corpus_pipeline
from tidemark.llm.secrets import masked
from tidemark.llm.words import Tokenizer, vocabulary_path


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def without_near_copies(rows):
    fps = [brute_fingerprint(r["text"]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    low = defaultdict(list)
    for r, g in zip(rows, groups(len(rows), links), strict=True):
        low[g].append(r["doc_id"])
    first = {min(ids) for ids in low.values()}
    return [r for r in rows if r["doc_id"] in first]


def without_repeats(rows):
    texts = [(r["text"] or "").encode() for r in rows]
    seen = Counter(b[i : i + 400] for b in texts for i in range(len(b) - 399))
    out = []
    for r, b in zip(rows, texts, strict=True):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        if not gone.any():
            out.append(r)
        elif rest.strip(" "):
            out.append(r | {"text": rest})
    return out


def test_the_whole_pipeline(spark, sf_dir, documents):
    rows = [r.asDict() for r in documents if any(c.isalpha() for c in r.text or "")]
    rows = without_repeats(without_near_copies(rows))
    texts = dict(zip([r["doc_id"] for r in rows], masked([r["text"] for r in rows]), strict=True))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == texts.keys()
    tok, of, places = Tokenizer(vocabulary_path()).whole, defaultdict(list), defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for doc_id, pieces in of.items():
        ids = tok.encode(texts[doc_id], add_special_tokens=False).ids + [2]
        at = 0
        for n, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and 0 < r.length <= 1024 and (n == 0 or r.length == 1024)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in got)
    assert len(places) <= -(-total // 1024) + 4


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
