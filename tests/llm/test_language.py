"""The network against a plain loop over bytes and against finite differences."""

import numpy as np
import pytest

from tidemark.llm import language
from tidemark.llm.language import Direction, Network, padded, piece_of, trained, turned


def network(seed=1, units=3, k=2, dtype=np.float64):
    r = np.random.default_rng(seed)
    draw = lambda *shape: r.standard_normal(shape).astype(dtype) * 0.7
    return Network(
        ["a", "b", "c"][:k], Direction(draw(256, 3 * units), draw(units, 3 * units)), Direction(draw(256, 3 * units), draw(units, 3 * units)),
        draw(2 * units, k), draw(k),
    )


def plain_states(d, word):
    n = d.u.shape[0]
    h, out = np.zeros(n), []
    for byte in word:
        a, s = d.w[byte], h @ d.u
        z, r = 1 / (1 + np.exp(-(a[:n] + s[:n]))), 1 / (1 + np.exp(-(a[n : 2 * n] + s[n : 2 * n])))
        c = np.tanh(a[2 * n :] + r * s[2 * n :])
        h = z * h + (1 - z) * c
        out.append(h)
    return out


def plain_chances(net, word):
    ahead, back = plain_states(net.ahead, word), plain_states(net.back, word[::-1])[::-1]
    out = []
    for a, b in zip(ahead, back, strict=True):
        e = np.exp(np.concatenate([a, b]) @ net.v + net.b)
        out.append(e / e.sum())
    return np.array(out)


@pytest.mark.parametrize("held, at_once", [(64, 2048), (4, 3), (1, 1)])
def test_words_of_any_length_keep_their_state(monkeypatch, held, at_once):
    monkeypatch.setattr(language, "STEPS_HELD", held)
    monkeypatch.setattr(language, "AT_ONCE", at_once)
    net = network(dtype=np.float32)
    words = [b"a", b"tree", "日本語".encode() * 40, bytes(range(256)), b"x" * 65, b"q" * 64, b"of", b"w" * 700]
    got = net.of_words(words)
    for word, sums in zip(words, got, strict=True):
        assert np.allclose(plain_chances(net, word).sum(axis=0), sums, rtol=2e-4)


def loss(net, words, y):
    total = n = 0
    for word, k in zip(words, y, strict=True):
        total -= np.log(plain_chances(net, word)[:, k]).sum()
        n += len(word)
    return total / n


def test_gradients_are_those_of_finite_differences():
    net, words, y = network(7), [b"abca", b"b", b"cabbage"], np.array([0, 1, 1])
    x, lengths = padded(words)
    keep_a, keep_b, n = [], [], 3
    states = net.states(x, lengths, keep_a, keep_b)
    d = net.chances(states)
    d[:, np.arange(3), y] -= 1
    d *= (np.arange(len(x))[:, None] < lengths)[:, :, None] / lengths.sum()
    d_states = d @ net.v.T
    grads = [
        *net.ahead.backward(x, keep_a, d_states[:, :, :n]),
        *net.back.backward(turned(x, lengths), keep_b, turned(d_states[:, :, n:], lengths)),
        np.einsum("tbh,tbk->hk", states, d),
        d.sum(axis=(0, 1)),
    ]
    r = np.random.default_rng(3)
    for w, g in zip([net.ahead.w, net.ahead.u, net.back.w, net.back.u, net.v, net.b], grads, strict=True):
        rows = sorted(set(b"abcage")) if len(w) == 256 else range(len(w))
        for _ in range(12):
            at = (int(r.choice(list(rows))), *([int(r.integers(w.shape[1]))] if w.ndim == 2 else []))
            old = w[at]
            w[at] = old + 1e-5
            up = loss(net, words, y)
            w[at] = old - 1e-5
            down = loss(net, words, y)
            w[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_training_learns():
    words = [b"the", b"then", b"there", b"that", b"der", b"und", b"dach", b"durch"] * 10
    labels = np.array([0, 0, 0, 0, 1, 1, 1, 1] * 10)
    net = trained(words, labels, ["en", "de"])
    assert (net.of_words(words).argmax(axis=1) == labels).all()


def test_pieces_are_drawn_from_the_whole_word_in_whole_characters():
    r, word = np.random.default_rng(5), "".join(chr(0x4E00 + i) for i in range(100)).encode()
    pieces = [piece_of(word, r) for _ in range(400)]
    assert all(0 < len(p) <= language.PIECE and p in word and p.decode() for p in pieces)
    assert len({word.index(p) for p in pieces}) > 60
    assert piece_of(b"short", r) == b"short"
