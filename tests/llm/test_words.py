"""Words and their ids against the tokenizer library on texts of all kinds of characters."""

import random

import numpy as np
import pytest

from tidemark.llm.words import Tokenizer, vocabulary_path


@pytest.fixture(scope="module")
def tok():
    return Tokenizer(vocabulary_path())


def fuzzed(seed, n):
    r = random.Random(seed)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    common = [" ", " ", "\n", "  ", "\t", "'t", "'s", "'ll", "a", "Word", "é", "9", "1/2", ".", "--", "　", "\xa0", "<|endoftext|>", "日本", "\0", "\x1c", "₝", "₏"]
    for _ in range(n):
        kind, size = r.random(), r.randint(0, 14)
        if kind < 0.35:  # any code points among plain ones
            yield "".join(chr(r.choice(points)) if r.random() < 0.4 else r.choice(common) for _ in range(size))
        elif kind < 0.7:
            yield "".join(r.choice(common) for _ in range(size))
        else:
            yield r.choice([" ", "\n", ""]).join(r.choice(["the", "cat's", "naïve,", "'t", "(x)", "42nd", chr(r.choice(points))]) for _ in range(size)) + r.choice(["", "\n", " "])


def test_ids_are_those_of_the_library(tok):
    texts = list(fuzzed(1, 20_000))
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.whole.encode_batch_fast(texts, add_special_tokens=False)]
    words = [tok.split(t) for t in texts]
    assert ["".join(w) for w in words] == texts
    assert [tok.ids(t) for t in texts] == want
    assert [b"".join(tok.encode(w)) for w in words] == want


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 50_000, "\n" * 9999, "^" * 50_000, "日本" * 9000, "x\u209d" * 500, "ab12 " * 9000])
def test_long_runs(tok, text):
    assert tok.ids(text) == np.array(tok.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_every_word_of_the_tables(tok, sf_dir):
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"].to_pylist()]
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.whole.encode_batch_fast(texts, add_special_tokens=False)]
    assert [tok.ids(t) for t in texts] == want


def test_an_unusual_file_goes_to_the_library(tok, tmp_path):
    import json

    file = json.loads(tok.whole.to_str())
    file["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(file))
    other = Tokenizer(str(tmp_path / "t.json"))
    assert other.fast is None and other.split("two words") == ["two words"]
    assert other.ids("two") == np.array(other.whole.encode("two", add_special_tokens=False).ids, "<u4").tobytes() != tok.ids("two")
