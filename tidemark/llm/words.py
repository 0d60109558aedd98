"""Words of a byte-level BPE tokenizer and their ids, inside a task."""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np
import regex

# The splitting pattern of byte-level BPE tokenizers, as published. The second form is the same with the
# classes spelled out for texts below U+0100, which the standard library's engine splits faster.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTERS, NUMBERS, BLANKS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN = (
    rf" ?[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{NUMBERS}]+| ?[^{BLANKS}{LETTERS}{NUMBERS}]+"
    rf"|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed tokenizer files are on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokenizer:
    """Splits texts into words and encodes texts and words; what a word's ids are does not depend on its neighbours.

    The ids are those of the tokenizer library. Where its file is a plain byte-level BPE, whose merges make the pieces in
    the order of their ids, merging by the ids of the pieces comes to the same, and a faster encoder does that; everything
    else, and texts with characters that the two class differently, goes to the library itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        added = self.whole.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.around = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.any, self.latin = regex.compile(PATTERN), re.compile(LATIN)
        self.fast = self._faster()
        self.alike: dict[str, bool] = {}

    def _faster(self):
        """An encoder that gives the library's ids, or None where that is not sure."""
        import tiktoken

        file = json.loads(self.whole.to_str())
        split, model = file["pre_tokenizer"] or {}, file["model"]
        if (
            file["normalizer"] is not None
            or split.get("type") != "ByteLevel"
            or not split.get("use_regex", True)
            or split.get("add_prefix_space", True)
            or model["type"] != "BPE"
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"])
        ):
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get(left + right) for left, right in pairs]
        if made != list(range(256, 256 + len(made))):
            return None
        ranks = {piece: i for i, piece in enumerate(self.pieces) if i < 256 + len(made)}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _is_alike(self, char: str) -> bool:
        """Whether all take a character the same way: Unicode versions differ."""
        if char not in self.alike:
            around = f"a{char}a{char} {char}1{char}1 {char}-{char}'s {char}{char}"
            words = [around[i:j] for _, (i, j) in self.whole.pre_tokenizer.pre_tokenize_str(around)]
            same = words == self.any.findall(around)
            self.alike[char] = same and self.fast.encode_ordinary(around) == self.whole.encode(around, add_special_tokens=False).ids
        return self.alike[char]

    def _is_sure(self, text: str) -> bool:
        return self.fast is not None and (text.isascii() or all(map(self._is_alike, set(text))))

    def _split(self, text: str) -> list[str]:
        if not self._is_sure(text):
            if self.fast is None:
                return [text]
            return [text[i:j] for _, (i, j) in self.whole.pre_tokenizer.pre_tokenize_str(text)]
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any.findall(text)
        return self.latin.findall(text)

    def split(self, text: str) -> list[str]:
        """Words in order; a text's added tokens are words of their own. Joined they are the text."""
        if self.around is None or not any(a in text for a in self.added):
            return self._split(text)
        words: list[str] = []
        for part in self.around.split(text):
            words += [part] if part in self.added else self._split(part)
        return words

    def ids(self, text: str) -> bytes:
        """A text's ids as little-endian unsigned 32-bit numbers."""
        if self._is_sure(text) and not any(a in text for a in self.added):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        return list(map(self.ids, words))

    @property
    def pieces(self) -> list[bytes]:
        """The bytes that each id stands for; its length is that of the vocabulary."""
        # Fixed rule of byte-level BPE: printable bytes stand for themselves, the others for U+0100 and on, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(moved)}
        vocabulary = json.loads(self.whole.to_str())["model"]["vocab"]
        out = [b""] * (max([*vocabulary.values(), *self.added.values()], default=-1) + 1)
        for piece, i in vocabulary.items():
            out[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
        for content, i in self.added.items():
            out[i] = content.encode()
        return out


@cache
def tokenizer(path: str | None = None) -> Tokenizer:
    """One for each Python worker, kept between its tasks."""
    return Tokenizer(path or vocabulary_path())
