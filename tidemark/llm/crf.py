"""A linear-chain conditional random field over words, in numpy.

A word's emission is a sum of hashed feature weights, so it is looked up by word. Many texts are one long chain: at a
text's first word the transition is replaced by the start weights, which forgets what came before. The chain is cut in
blocks; block products of transition matrices are made for all blocks at once, linked by a short scan, and then all
blocks run forward and backward together. A text of any length is exact and costs the same per word.
"""

from __future__ import annotations

import itertools
import re
import sys
import unicodedata
import zlib
from dataclasses import dataclass, field

import numpy as np

#: Numbers that are no digits (halves, squares, circled or Roman ones): ``\w`` takes them, but they are no letters.
_NUMBERS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isdecimal() and unicodedata.category(c)[0] != "L")
#: Runs of letters. Longer ones than any word, as in scripts without spaces, are several words, one after another.
WORD = re.compile(r"[^\W\d_]{1,64}")
#: Hashed features.
WIDTH = 1 << 15
_BLOCK = 64


def letters(text: str | None) -> str:
    """The text in lower case, every number that is no digit replaced by a space: ``WORD`` finds its words."""
    text = (text or "").lower()
    for c in () if text.isascii() else _NUMBERS.intersection(text):
        text = text.replace(c, " ")
    return text


def word_features(words: list[str], lexicon: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and the number of the word that each belongs to.

    Beginnings up to five letters, ends up to three, letter bigrams and trigrams, the word and its lexicon entry.
    """
    text = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.concatenate([[0], np.cumsum(sizes + 2)[:-1]])
    word = np.repeat(np.arange(len(words)), sizes + 2)
    step = np.uint64(0x100000001B3)
    hashes, owners = [], []

    def add(kind: int, value: np.ndarray, owner: np.ndarray):
        value = (value + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        hashes.append((value >> np.uint64(40)).astype(np.int64) % WIDTH)
        owners.append(owner)

    pair = text[:-1] * step + text[1:]
    inside = word[:-1] == word[1:]
    add(1, pair[inside], word[:-1][inside])
    inside = word[:-2] == word[2:]
    add(2, (pair[:-1] * step + text[2:])[inside], word[:-2][inside])
    for kind, most, edge, way in ((10, 5, first, 1), (20, 3, first + sizes + 1, -1)):
        value, rows = np.zeros(len(words), np.uint64), np.arange(len(words))
        for k in range(1, most + 1):
            rows = rows[sizes[rows] >= k]
            value[rows] = value[rows] * step + text[edge[rows] + way * k]
            add(kind + k, value[rows], rows)
    add(30, np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words)), np.arange(len(words)))
    if lexicon:
        known = [(k, lexicon[w]) for k, w in enumerate(words) if w in lexicon]
        if known:
            add(40, np.array([v for _, v in known], np.uint64), np.array([k for k, _ in known]))
    return np.concatenate(hashes), np.concatenate(owners)


@dataclass
class Chain:
    """Fitted weights. ``labels`` name the states."""

    labels: list
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)

    def emissions(self, words: list[str]) -> np.ndarray:
        flat, owner = word_features(words, self.lexicon)
        return np.stack([np.bincount(owner, self.weights[flat, s], len(words)) for s in range(len(self.labels))], axis=1)


class _Places(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word):
        self[word] = place = len(self)
        return place


class Tagger:
    """Marginals for texts; emissions of up to ``most`` words are kept."""

    def __init__(self, chain: Chain, most: int = 600_000):
        self.chain, self.most = chain, most
        self.place, self.table = _Places(), np.empty((0, len(chain.labels)), np.float32)

    def ids(self, texts: list[list[str]]) -> np.ndarray:
        known = len(self.place)
        out = np.fromiter((i for t in texts for i in map(self.place.__getitem__, t)), np.int64, sum(map(len, texts)))
        if len(self.place) > known:
            new = list(itertools.islice(self.place, known, None))
            self.table = np.concatenate([self.table[:known], self.chain.emissions(new).astype(np.float32)])
        return out

    def marginals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all words of all texts, one after another, and the number of words of each text."""
        if len(self.place) > self.most:
            self.place, self.table = _Places(), self.table[:0]
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum():
            return np.empty((0, len(self.chain.labels))), sizes
        ids = self.ids(texts)
        first = np.zeros(len(ids), bool)
        first[np.concatenate([[0], np.cumsum(sizes[sizes > 0])[:-1]])] = True
        return forward_backward(self.table[ids].astype(float), first, self.chain.transitions, self.chain.start)[0], sizes


_TAGGERS: dict[int, Tagger] = {}


def tagger_of(chain: Chain) -> Tagger:
    """The worker's tagger for a model, with the emissions that earlier tasks of the worker looked up."""
    name = zlib.crc32(chain.weights.tobytes() + chain.transitions.tobytes() + repr(chain.labels).encode())
    if name not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[name] = Tagger(chain)
    return _TAGGERS[name]


def forward_backward(emission: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of every position, and the summed marginals of neighbours where ``pairs``.

    ``emission`` and the weights are logarithms; ``first`` marks the positions that begin a text.
    """
    n, states = emission.shape
    count = -(-n // _BLOCK)
    psi = np.ones((count * _BLOCK, states))
    psi[:n] = np.exp(emission - emission.max(axis=1, keepdims=True))
    begin = np.ones(count * _BLOCK, bool)  # what fills the last block has no part in the last text
    begin[:n] = first
    step, fresh = np.exp(transitions), np.exp(start)
    psi, begin = psi.reshape(count, _BLOCK, states), begin.reshape(count, _BLOCK)
    def moved(a, t):
        """Rows of ``a`` one step on, without the emission; a text's first step forgets where the row came from."""
        out = a.reshape(-1, states) @ step
        out = out.reshape(a.shape)
        new = begin[:, t]
        if new.any():
            out[new] = a[new].sum(axis=-1, keepdims=True) * fresh
        return out

    # Product of each block's steps, scaled now and then.
    product = np.broadcast_to(np.eye(states), (count, states, states))
    for t in range(_BLOCK):
        product = moved(np.ascontiguousarray(product), t) * psi[:, t, None, :]
        if t % 4 == 3:
            product = product / product.max(axis=(1, 2), keepdims=True)
    left, right = np.empty((count, states)), np.empty((count, states))
    a, b = np.full(states, 1 / states), np.ones(states)
    for k in range(count):
        left[k] = a
        a = a @ product[k]
        a = a / a.sum()
    for k in range(count - 1, -1, -1):
        right[k] = b
        b = product[k] @ b
        b = b / b.sum()
    forward, backward = np.empty_like(psi), np.empty_like(psi)
    a = left
    for t in range(_BLOCK):
        a = moved(a, t) * psi[:, t]
        if t % 4 == 3:
            a = a / a.sum(axis=1, keepdims=True)
        forward[:, t] = a
    b = right
    for t in range(_BLOCK - 1, -1, -1):
        backward[:, t] = b
        b = (psi[:, t] * b) @ step.T
        b[begin[:, t]] = 1.0
        if t % 4 == 0:
            b = b / b.sum(axis=1, keepdims=True)
    both = (forward * backward).reshape(-1, states)[:n]
    both = both / both.sum(axis=1, keepdims=True)
    if not pairs:
        return both, None
    before = np.concatenate([left[:, None], forward[:, :-1]], axis=1).reshape(-1, states)[:n]
    after = (psi * backward).reshape(-1, states)[:n]
    inner = ~first
    xi = before[inner][:, :, None] * step * after[inner][:, None, :]
    return both, (xi / xi.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def fit_chain(texts: list[list[str]], tags: list[np.ndarray], labels: list, lexicon: dict[str, int],
              rounds: int = 25, rate: float = 0.15, decay: float = 1e-4, weight: np.ndarray | None = None) -> Chain:
    """Maximum likelihood by Adam; ``tags`` hold a state for every word, ``weight`` the price of a state's words."""
    states = len(labels)
    kept = [k for k, t in enumerate(texts) if t]
    words = sorted({w for k in kept for w in texts[k]})
    place = {w: i for i, w in enumerate(words)}
    flat, owner = word_features(words, lexicon)
    ids = np.concatenate([np.array([place[w] for w in texts[k]]) for k in kept])
    gold = np.concatenate([tags[k] for k in kept])
    first = np.zeros(len(ids), bool)
    first[np.concatenate([[0], np.cumsum([len(texts[k]) for k in kept])[:-1]])] = True
    price = np.ones(len(ids)) if weight is None else weight[gold]
    start = np.log((np.bincount(gold[first], minlength=states) + 1) / (first.sum() + states))
    inner = np.flatnonzero(~first)
    gold_pairs = np.zeros((states, states))
    np.add.at(gold_pairs, (gold[inner - 1], gold[inner]), 1)
    onehot = np.eye(states)[gold]
    weights, moves = np.zeros((WIDTH, states)), np.zeros((states, states))
    moments = [[np.zeros_like(weights), np.zeros_like(weights)], [np.zeros_like(moves), np.zeros_like(moves)]]
    for k in range(1, rounds + 1):
        emission = np.stack([np.bincount(owner, weights[flat, s], len(words)) for s in range(states)], axis=1)
        marginal, xi = forward_backward(emission[ids], first, moves, start, pairs=True)
        error = (onehot - marginal) * price[:, None]
        by_word = np.stack([np.bincount(ids, error[:, s], len(words)) for s in range(states)], axis=1)
        slope = np.stack([np.bincount(flat, by_word[owner, s], WIDTH) for s in range(states)], axis=1) / len(ids) - decay * weights
        for value, grad, (m, v) in ((weights, slope, moments[0]), (moves, (gold_pairs - xi) / len(ids), moments[1])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            value += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Chain(labels, weights.astype(np.float32), moves, start, lexicon)


def associated(texts: list[list[str]], classes: list[int], states: int, least: int = 3, share: float = 0.9) -> dict[str, int]:
    """Words that stand in ``least`` texts or more, ``share`` of them (texts weighted by class size) of one class."""
    counts: dict[str, np.ndarray] = {}
    sizes = np.bincount(classes, minlength=states).clip(1)
    for text, c in zip(texts, classes, strict=True):
        for w in set(text):
            counts.setdefault(w, np.zeros(states, np.int64))[c] += 1
    out = {}
    for w, c in counts.items():
        rates = c / sizes
        top = int(rates.argmax())
        if c.sum() >= least and rates[top] >= share * rates.sum():
            out[w] = top
    return out
