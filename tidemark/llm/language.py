"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of one word after the other, from both ends. Its state is reset at blanks and carried through
a word of any length; every byte gets a probability for each language, and a document's are the mean over its bytes. A
word's probabilities depend on its bytes alone, so a task computes each distinct word once. The network is trained on
the driver in numpy, by backpropagation through time, on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, free_name, release, ship

UNDETERMINED = "und"
#: Units of each direction, bytes of a word that is learned from, and positions of words that are held at once.
UNITS, PIECE, STEPS_HELD = 16, 32, 64
#: Bounds of the training sample: documents, and words drawn from them; steps and words a step.
SAMPLE, WORDS, STEPS, BATCH = 3000, 60_000, 900, 256
#: Words computed at once, words whose results a task holds, and bytes of these words.
AT_ONCE, HELD, HELD_BYTES = 2048, 150_000, 8 << 20
#: Bytes of texts whose words are held at once.
SPLIT = 1 << 20


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as a steps x words matrix, filled with zeros, and the lengths."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    return flat.reshape(len(words), width).T, lengths


def turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each column's first ``length`` entries in reverse; applied twice it is the same again."""
    at = lengths[None, :] - 1 - np.arange(len(x))[:, None]
    at = np.where(at >= 0, at, np.arange(len(x))[:, None])
    return np.take_along_axis(x, at if x.ndim == 2 else at[:, :, None], axis=0)


@dataclass
class Direction:
    """One gated recurrent layer: update and reset gates and the candidate, side by side."""

    w: np.ndarray  # 256 x 3 units: what a byte adds
    u: np.ndarray  # units x 3 units: what the state adds

    def forward(self, x: np.ndarray, keep: list | None = None, h: np.ndarray | None = None, live: np.ndarray | None = None) -> np.ndarray:
        """States after each byte, from ``h`` on; where a column is not ``live`` its state is zero."""
        n = self.u.shape[0]
        h = np.zeros((x.shape[1], n), self.u.dtype) if h is None else h
        out = np.empty((*x.shape, n), self.u.dtype)
        for t in range(len(x)):
            a, s = self.w[x[t]], h @ self.u
            gates = sigmoid(a[:, : 2 * n] + s[:, : 2 * n])
            z, r = gates[:, :n], gates[:, n:]
            c = np.tanh(a[:, 2 * n :] + r * s[:, 2 * n :])
            if keep is not None:
                keep.append((h, z, r, c, s[:, 2 * n :]))
            h = c + z * (h - c)
            if live is not None:
                h = h * live[t][:, None]
            out[t] = h
        return out

    def backward(self, x: np.ndarray, keep: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``w`` and ``u``: through time, last step first. Steps past a word's end get no gradient."""
        n = self.u.shape[0]
        dw, du = np.zeros_like(self.w), np.zeros_like(self.u)
        dh = np.zeros_like(d_out[0])
        for t in reversed(range(len(x))):
            h, z, r, c, s = keep[t]
            dh = dh + d_out[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * s * r * (1 - r)
            np.add.at(dw, x[t], np.concatenate([dz, dr, dc], axis=1))
            ds = np.concatenate([dz, dr, dc * r], axis=1)
            du += h.T @ ds
            dh = dh * z + ds @ self.u.T
        return dw, du


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    back: Direction
    v: np.ndarray  # 2 units x languages
    b: np.ndarray

    def states(self, x, lengths, keep_a=None, keep_b=None):
        a = self.ahead.forward(x, keep_a)
        b = turned(self.back.forward(turned(x, lengths), keep_b), lengths)
        return np.concatenate([a, b], axis=2)

    def chances(self, states: np.ndarray) -> np.ndarray:
        s = states @ self.v + self.b
        s = np.exp(s - s.max(axis=-1, keepdims=True))
        return s / s.sum(axis=-1, keepdims=True)

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """Sum of every language's probability over the bytes of each word, none of them empty."""
        out = np.empty((len(words), len(self.languages)), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            part = order[at : at + AT_ONCE]
            # As many as fit, the shortest first; one word of any length does.
            few = max(1, next((i for i, k in enumerate(part) if (i + 1) * len(words[k]) > AT_ONCE * PIECE * 8), len(part)))
            out[part[:few]] = self._sums([words[k] for k in part[:few]])
            at += few
        return out

    def _sums(self, words: list[bytes]) -> np.ndarray:
        """The words' bytes lie below each other. The way back is gone once from the end, which leaves the states at the
        borders of stretches of ``STEPS_HELD`` bytes; then each stretch is gone both ways from its borders.
        """
        x, lengths = padded(words)
        live = np.arange(len(x))[:, None] < lengths
        starts = list(range(0, len(x), STEPS_HELD))
        after: list[np.ndarray | None] = [None]
        for i in starts[:0:-1]:
            one = slice(i, i + STEPS_HELD)
            after.append(self.back.forward(x[one][::-1], h=after[-1], live=live[one][::-1])[-1])
        total, h = np.zeros((len(words), len(self.languages)), np.float32), None
        for i, back_from in zip(starts, reversed(after), strict=True):
            one = slice(i, i + STEPS_HELD)
            a = self.ahead.forward(x[one], h=h)
            b = self.back.forward(x[one][::-1], h=back_from, live=live[one][::-1])[::-1]
            h = a[-1]
            p = self.chances(np.concatenate([a, b], axis=2))
            total += (p * live[one][:, :, None]).sum(axis=0)
        return total


def trained(words: list[bytes], labels: np.ndarray, languages: list[str], seed: int = 5) -> Network:
    """Cross entropy over all bytes, each language as often as the others, with Adam's step sizes."""
    random = np.random.default_rng(seed)
    n, k = UNITS, len(languages)
    draw = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
    net = Network(
        languages,
        Direction(draw(256, 3 * n, scale=0.3), draw(n, 3 * n, scale=0.25)),
        Direction(draw(256, 3 * n, scale=0.3), draw(n, 3 * n, scale=0.25)),
        draw(2 * n, k, scale=0.3),
        np.zeros(k, np.float32),
    )
    weights = [net.ahead.w, net.ahead.u, net.back.w, net.back.u, net.v, net.b]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    of = [np.flatnonzero(labels == i) for i in range(k)]
    for step in range(1, STEPS + 1):
        y = random.integers(0, k, BATCH)
        chosen = [int(of[i][random.integers(len(of[i]))]) for i in y]
        x, lengths = padded([words[i] for i in chosen])
        keep_a: list = []
        keep_b: list = []
        states = net.states(x, lengths, keep_a, keep_b)
        d = net.chances(states)
        d[:, np.arange(BATCH), y] -= 1
        d *= (np.arange(len(x))[:, None] < lengths)[:, :, None] / lengths.sum()
        d = d.astype(np.float32)
        d_states = d @ net.v.T
        back = turned(d_states[:, :, n:], lengths)
        grads = [
            *net.ahead.backward(x, keep_a, d_states[:, :, :n]),
            *net.back.backward(turned(x, lengths), keep_b, back),
            np.einsum("tbh,tbk->hk", states, d),
            d.sum(axis=(0, 1)),
        ]
        rate = 0.02 * (1 - step / (STEPS + 1)) + 0.0005
        for w, g, m, s in zip(weights, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def held_out(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text leaves remainder 2; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def piece_of(word: bytes, random: np.random.Generator) -> bytes:
    """At most ``PIECE`` bytes from anywhere in a word, in whole characters."""
    if len(word) <= PIECE:
        return word
    first = int(random.integers(len(word) - PIECE + 1))
    while first < len(word) and word[first] & 0xC0 == 0x80:
        first += 1
    return word[first : first + PIECE].decode("utf-8", "ignore").encode() or word[:PIECE]


def learn(docs: DataFrame, sample: int = SAMPLE, seed: int = 5) -> Network | None:
    """A network from labelled documents that are not held out; None where there is none with a word.

    Of these at most ``sample`` are used, those with the smallest hash of the id, and of their words at most ``WORDS``,
    drawn at random where the texts are, with the id as the seed: only these words come to the driver.
    """
    order = F.xxhash64("doc_id")
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    usable = usable.where(F.col("text").cast("string").rlike(r"\S"))
    # First the hashes alone, then the texts of those rows: no task sorts texts.
    first = usable.select(order.alias("at")).orderBy("at").limit(sample)
    top, n = first.agg(F.max("at"), F.count("*")).first()
    if not n:
        return None
    each = max(1, WORDS // n)

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, text, lang in zip(batch["at"].to_pylist(), batch["text"], batch["lang"].to_pylist(), strict=True):
                own = text.as_py().split()
                random = np.random.default_rng([seed, at % (1 << 64)])
                chosen = random.choice(len(own), min(each, len(own)), replace=False)
                drawn = [piece_of(own[i], random) for i in chosen]
                yield pa.record_batch(
                    {"word": pa.array(drawn, pa.binary()), "lang": pa.array([lang] * len(drawn), pa.string())}
                )

    texts = usable.where(order <= F.lit(top)).select(
        order.alias("at"), F.col("text").cast("string").cast("binary").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    # Only where rows repeat the last id are there more than WORDS; which of these are left out does not change.
    drawn = texts.mapInArrow(draw, "word binary, lang string")
    rows = drawn.orderBy(F.xxhash64("word", "lang"), "word", "lang").limit(max(WORDS, sample)).collect()
    rows = sorted((bytes(r["word"]), r["lang"]) for r in rows)
    languages = sorted({lang for _, lang in rows})
    labels = np.array([languages.index(lang) for _, lang in rows])
    return trained([word for word, _ in rows], labels, languages, seed)


def predictor(net: Network | None):
    """A function from texts, and whether each has a letter, to languages and scores; it keeps some words."""
    place: dict[bytes, int] = {}
    sums = np.empty((HELD if net else 0, len(net.languages) if net else 0), np.float32)
    size = 0

    def some_texts(split: list[list[bytes]]) -> tuple[list[str], list[float]]:
        nonlocal sums, size
        new = list(set().union(*split).difference(place))
        if len(place) + len(new) > len(sums) or size > HELD_BYTES:
            place.clear()
            size = 0
            new = list(set().union(*split))
            sums = np.empty((max(HELD, len(new)), sums.shape[1]), np.float32)
        if new:
            first = len(place)
            place.update(zip(new, range(first, first + len(new)), strict=True))
            sums[first : first + len(new)] = net.of_words(new)
            size += sum(map(len, new))
        langs, scores = [], []
        for words in split:
            if not words:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            p = sums[list(map(place.__getitem__, words))].sum(axis=0, dtype=np.float64) / sum(map(len, words))
            best = int(p.argmax())
            langs.append(net.languages[best])
            scores.append(min(1.0, max(0.0, float(p[best]))))
        return langs, scores

    def predict_some(texts: pa.Array, letters: list[bool]) -> tuple[list[str], list[float]]:
        langs, scores, split, held = [], [], [], 0
        for n, ok in enumerate(letters):
            text = texts[n].as_py() if ok and net else b""
            split.append(text.split())
            held += len(text)
            if held > SPLIT or n + 1 == len(letters):  # words take several times the memory of their text
                found = some_texts(split)
                langs += found[0]
                scores += found[1]
                split, held = [], 0
        return langs, scores

    return predict_some


def has_letter(text_col: str = "text") -> F.Column:
    return F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score): from the text alone; ``score`` is the mean probability of the language.

    A text that is null or has no letter is undetermined with score 0, and so is every text if nothing was learned.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = predictor(net)
        for batch in batches:
            langs, scores = of(batch["text"], batch["letters"].to_pylist())
            made = {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())}
            yield pa.record_batch({"doc_id": batch["doc_id"]} | made)
        release()

    rows = documents(docs).select("doc_id", F.col("text").cast("binary").alias("text"), has_letter().alias("letters"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang).

    Learned from texts and languages of documents that are not held out; see ``learn`` and ``predict``. Repeated rows
    get the same result each, rows with a null id are predicted and never learned from. An empty table gives an empty
    one; other columns are not read.
    """
    ship(docs.sparkSession)
    return predict(docs, learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, least: float = 0.25) -> DataFrame:
    """Rows whose language was determined with a mean probability of at least ``least``, with all their columns."""
    ship(docs.sparkSession)
    net = learn(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = predictor(net)
        for batch in batches:
            langs, scores = of(batch["text"].cast(pa.binary()), batch[letters].to_pylist())
            good = [k != UNDETERMINED and s >= least for k, s in zip(langs, scores, strict=True)]
            yield batch.filter(pa.array(good, pa.bool_())).select(names)
        release()

    names = docs.columns
    letters = free_name(docs, "letters")
    return docs.withColumn(letters, has_letter()).mapInArrow(run, docs.schema)
