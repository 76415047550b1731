"""Token counts by a finite-state transducer compiled from a byte-pair vocabulary.

The vocabulary's merges define, for every beginning of a word, the last token of its encoding; the encoding of a longer
beginning depends only on the last tokens at the places where a token can still be open. That is a finite state, so
words are counted by a deterministic transducer over bytes: a transition adds the change of the number of tokens (it
may take tokens back), and the end of a word adds what the end-of-word token changes and returns to the start. States
are compiled when a text first needs them, up to a bound; then all are dropped and the stream goes on in two halves.

Texts of a batch form one stream of symbols, cut in chunks of fixed length that run side by side. No word of the stream
is as long as a chunk, so every chunk holds a word end and its state map is constant: the scan over chunks composes such
maps by taking the exit of the chunk before. A text with a longer word (unspaced data, a clause without spaces) would
compile a state for each of its bytes and never use them again; it is left to the library.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, slices, table

#: Token number up to which a document is within the limit.
LIMIT = 2048
#: Symbols of a chunk, bytes of the longest word that is read by states, and states held at once.
CHUNK, LONG, MOST_STATES = 256, 64, 320_000
#: Distinct words whose token numbers a worker holds at once.
MOST_WORDS = 300_000
#: The table of transitions begins with 2 ** so many slots and doubles when it is half full.
SLOT_BITS = 14
_END = 256
_NEVER = 1 << 30
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(moved)}


@lru_cache(maxsize=2)
def character_classes(path: str) -> bytes:
    """Class of every code point, asked from the library's own splitter."""
    from tokenizers import Tokenizer

    splitter = Tokenizer.from_file(path).pre_tokenizer
    out = np.full(0x110000, _OTHER, np.uint8)
    for low in range(0, 0x40000, 0x4000):
        points = [p for p in range(low, low + 0x4000) if not 0xD800 <= p < 0xE000]
        out[points] = _SPACE
        for _, (a, b) in splitter.pre_tokenize_str("".join(f"a{chr(p)}! " for p in points)):
            k, place = divmod(a, 4)
            if place == 0 and b - a == 2:
                out[points[k]] = _LETTER
            elif place == 1:
                out[points[k]] = _OTHER if b - a == 2 else _NUMBER
    return out.tobytes()


@lru_cache(maxsize=2)
def odd_characters(path: str) -> str:
    """Characters that the library normalises in another way than ``normalized``, or may do so beside others.

    These are all marks, as their order and composition depend on the version of the Unicode tables. Texts with one of
    them are normalised by the library.
    """
    from tokenizers import Tokenizer

    step = Tokenizer.from_file(path).normalizer.normalize_str
    every = (chr(p) for p in range(128, 0x110000) if not 0xD800 <= p < 0xE000)
    return "".join(c for c in every if not c.isspace() and (
        unicodedata.category(c)[0] == "M" or (unicodedata.category(c)[0] != "C" or ord(c) < 0x40000) and step(c) != normalized(c)))


class _Full(Exception):
    """No state can be added."""


class Transducer:
    """Counts tokens of symbol streams; ``vocabulary`` is the file of a byte-level vocabulary with word-end tokens."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        self.suffix = model["end_of_word_suffix"]
        of = {c: bytes([b]) for b, c in byte_symbols().items()}
        self.ranks: dict[tuple, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks[self._piece(a, of), self._piece(b, of)] = rank
        tokens = {self._piece(t, of) for t in model["vocab"]}
        self.inner = {t: t for t, last in tokens if not last}  # states share the tokens that are in here
        self.final = {t for t, last in tokens if last}
        # What a token that is not yet read whole can begin with; a word-end token still needs the end.
        self.open = {t[:k] for t in self.inner for k in range(len(t))} | {t[:k] for t in self.final for k in range(len(t) + 1)}
        self.fits: dict[tuple, bool] = {}
        self.clear()

    def _piece(self, token: str, of: dict) -> tuple[bytes, bool]:
        last = token.endswith(self.suffix) and token != self.suffix
        return b"".join(of[c] for c in (token[:-len(self.suffix)] if last else token)), last

    def clear(self):
        self.bits = SLOT_BITS
        self.keys, self.values = np.full((2, 1 << SLOT_BITS), -1, np.int64)
        self.known = 0
        # A state: the open end of what was read, and for each length of a possible open token the last token and count
        # (relative to now) at the place where that token would begin.
        start = (b"", ((0, b"", 0),))
        self.states, self.place = [start], {start: 0}

    def _encode(self, parts: list) -> list:
        rank = self.ranks.get
        while len(parts) > 1:
            found = [rank(pair, _NEVER) for pair in zip(parts, parts[1:], strict=False)]
            best = min(found)
            if best == _NEVER:
                break
            out, k, last = [], 0, len(parts) - 1
            while k <= last:
                if k < last and found[k] == best:
                    out.append((parts[k][0] + parts[k + 1][0], parts[k + 1][1]))
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def _follows(self, before: bytes, token: bytes, last: bool) -> bool:
        """Do the two stay apart, and whole, when they are encoded together?"""
        key = before, token, last
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > MOST_STATES:
                self.fits.clear()
            parts = [(bytes([b]), False) for b in before + token]
            parts[-1] = (parts[-1][0], last)
            want = ([(before, False)] if before else []) + [(token, last)]
            found = self.fits[key] = self._encode(parts) == want
        return found

    def _compile(self, state: int, symbol: int):
        ends, history = self.states[state]
        if symbol == _END:
            best = None
            for length, before, count in history[::-1]:
                token = ends[len(ends) - length:]
                if length and token in self.final and self._follows(before, token, True):
                    best = count + 1
                    break
            if best is None and ends:
                raise ValueError(f"no encoding ends in {ends!r}")
            self._put(state, symbol, 0, best or 0)
            return
        read = ends + bytes([symbol])
        found = None
        for length, before, count in history[::-1]:
            token = self.inner.get(read[len(read) - length - 1:])
            if token is not None and self._follows(before, token, False):
                found = token, count + 1
                break
        if found is None:
            raise ValueError(f"no encoding of {read!r}")
        token, change = found
        kept = [(length + 1, before, count - change) for length, before, count in history
                if read[len(read) - length - 1:] in self.open]
        after = (read[len(read) - max((k[0] for k in kept), default=0):] if kept else b"", ((0, token, 0), *kept))
        place = self.place.get(after)
        if place is None:
            if len(self.states) >= MOST_STATES:
                raise _Full
            place = self.place[after] = len(self.states)
            self.states.append(after)
        self._put(state, symbol, place, change)

    def _put(self, state: int, symbol: int, after: int, change: int):
        if 2 * self.known >= len(self.keys):
            self._grow()
        key = state << 9 | symbol
        slot = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        while self.keys[slot] >= 0:
            slot = (slot + 1) & (len(self.keys) - 1)
        self.keys[slot], self.values[slot] = key, after << 16 | (change + 0x8000)
        self.known += 1

    def _grow(self):
        held = self.keys >= 0
        keys, values = self.keys[held], self.values[held]
        self.bits += 1
        self.keys, self.values = np.full((2, 1 << self.bits), -1, np.int64)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            first = free[np.unique(slots[free], return_index=True)[1]]
            self.keys[slots[first]], self.values[slots[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        """Packed next state and change of each (state, symbol) key; -1 where it is not compiled."""
        slots = self._slots(keys)
        there = self.keys[slots]
        out = self.values[slots]
        other = np.flatnonzero((there != keys) & (there >= 0))
        while len(other):
            slots[other] = (slots[other] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[other]]
            out[other] = self.values[slots[other]]
            other = other[(there != keys[other]) & (there >= 0)]
        return out

    def _advance(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = states << 9 | symbols
        found = self._look_up(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            for key in np.unique(keys[missing]).tolist():
                self._compile(key >> 9, key & 511)
            found[missing] = self._look_up(keys[missing])
        return found >> 16, (found & 0xFFFF) - 0x8000

    def emissions(self, stream: np.ndarray) -> np.ndarray:
        """The change of the token count at every symbol of a stream that ends with a word end.

        Raises ``_Full`` if there are too many states.
        """
        count = -(-len(stream) // CHUNK)
        padded = np.full(count * CHUNK, _END, np.int64)  # at the start state a word end changes nothing
        padded[:len(stream)] = stream
        symbols = padded.reshape(count, CHUNK)
        out = np.zeros((count, CHUNK), np.int16)
        is_end = symbols == _END
        closed = is_end.any(axis=1)
        first = np.where(closed, is_end.argmax(axis=1), CHUNK)  # a chunk's head goes up to its first word end
        # What follows the head is the same for every entry state.
        exits = np.zeros(count, np.int64)
        for t in range(CHUNK):
            lanes = np.flatnonzero(first < t)
            if len(lanes):
                exits[lanes], out[lanes, t] = self._advance(exits[lanes], symbols[lanes, t])
        # A chunk is entered in the state in which the one before is left.
        if not closed[:-1].all():
            raise ValueError(f"a word has more than {CHUNK} symbols")
        state, lanes = np.concatenate([[0], exits[:-1]]), np.arange(count)
        for t in range(int(min(CHUNK, first.max(initial=0) + 1))):
            lanes = lanes[first[lanes] >= t]
            state[lanes], out[lanes, t] = self._advance(state[lanes], symbols[lanes, t])
        return out.reshape(-1)[:len(stream)]

    def _within_bound(self, stream: np.ndarray, run: Callable, join: Callable):
        """``run(stream)``; if it needs too many states, again with none, and then in two halves, cut at a word end."""
        if 4 * len(self.states) > 3 * MOST_STATES:  # sooner than in the middle of a stream
            self.clear()
        for _ in range(2):
            try:
                return run(stream)
            except _Full:
                self.clear()
        ends = np.flatnonzero(stream == _END) + 1
        if len(ends) < 2:
            raise RuntimeError("one word needs more states than there may be")
        cut = int(ends[len(ends) // 2 - 1])
        return join(*(self._within_bound(half, run, join) for half in (stream[:cut], stream[cut:])))

    def totals(self, stream: np.ndarray) -> np.ndarray:
        """How many tokens there are up to each symbol of a stream."""
        return self._within_bound(stream, lambda x: np.cumsum(self.emissions(x), dtype=np.int64),
                                  lambda one, two: np.concatenate([one, one[-1] + two]))


class Words:
    """Token numbers of words; each is asked from the vocabulary's own model when it is first met.

    A word is encoded for itself, so its numbers are the same wherever it stands. At most ``MOST_WORDS`` are held, and those
    of one call; then all are dropped.
    """

    def __init__(self, model):
        self.model = model
        self.symbols = {b: c for b, c in byte_symbols().items() if b != 10}
        self.clear()

    def clear(self):
        self.place: dict[bytes, int] = {}
        self.ids, self.edges = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def tokens(self, data: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words in order, and how many of them come up to the end of each word.

        ``data`` holds the bytes of the words, ``opens`` where each begins.
        """
        if len(self.place) > MOST_WORDS:
            self.clear()
        bounds = np.append(opens, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(opens), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        fresh = [w for w in distinct if w not in self.place]
        if fresh:
            # No word holds a line feed.
            written = b"\n".join(fresh).decode("latin-1").translate(self.symbols).split("\n")
            ids, edges, read = [], [], self.model.tokenize
            for word in written:
                ids += [t.id for t in read(word)]
                edges.append(len(ids))
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh)), strict=True))
            self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])
            self.edges = np.concatenate([self.edges, self.edges[-1] + np.array(edges, np.int64)])
        at = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        low = self.edges[at]
        size = self.edges[at + 1] - low
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        return self.ids[np.arange(total) + np.repeat(low - after + size, size)], after


class Counter:
    """Token counts, and ids, of texts by the transducer."""

    def __init__(self, path: str, classes: bytes, odd: str = ""):
        from tokenizers import Tokenizer

        self.path = path
        self.whole = Tokenizer.from_file(path)
        self.words = Words(self.whole.model)
        self.odd = np.zeros(0x110000, bool)
        self.odd[[ord(c) for c in odd]] = True
        self.classes = np.frombuffer(classes, np.uint8)
        special = [t for t in json.load(open(path, encoding="utf-8"))["added_tokens"]]
        self.special = [t["content"] for t in special]

    @cached_property
    def transducer(self) -> Transducer:
        """Made when it is first used: ids do not need it."""
        return Transducer(self.path)

    def counts(self, texts: list[str]) -> np.ndarray:
        """One number per text. Special strings split a text and count one each; the library counts pieces with a long word."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            pieces = [text]
            if "<|" in text:
                for s in self.special:
                    split = [p.split(s) for p in pieces]
                    extra[k] += sum(len(p) - 1 for p in split)
                    pieces = [x for p in split for x in p]
            for p in pieces:
                parts.append(p)
                owner.append(k)
        stream, edges, long = self._stream(parts)
        for k in long:
            extra[owner[k]] += len(self._by_library(parts[k]))
        if not len(stream):
            return extra
        total = np.concatenate([[0], self.transducer.totals(stream)])
        each = np.diff(np.concatenate([[0], total[edges]]))
        return extra + np.bincount(owner, each, len(texts)).astype(np.int64)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the positions behind words that begin with a full stop, ``!`` or ``?``.

        Texts with a special string or a long word are left to the library.
        """
        plain = ["" if "<|" in t else t for t in texts]
        out = [(np.empty(0, np.uint32), np.empty(0, np.int64))] * len(texts)
        data, opens, edges, long = self._short_words(plain)
        ids, after = self.words.tokens(data, opens)
        stops = np.isin(data[opens], [46, 33, 63])
        low, first = 0, 0
        for k, word in enumerate(np.searchsorted(opens, edges).tolist()):  # words up to each text's end
            high = int(after[word - 1]) if word else 0
            out[k] = ids[low:high], after[first:word][stops[first:word]] - low
            low, first = high, word
        for k in [*long, *(k for k, t in enumerate(texts) if "<|" in t)]:
            out[k] = np.array(self._by_library(texts[k]), np.uint32), np.empty(0, np.int64)
        return out

    def _by_library(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _normalized(self, text: str) -> str:
        if not text.isascii() and self.odd[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            return self.whole.normalizer.normalize_str(text)
        return normalized(text)

    def _stream(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The symbols of all parts with word ends, for each part the place behind its last one, and the parts with a word
        above ``LONG`` bytes, which are left out."""
        data, opens, edges, long = self._short_words(parts)
        if not len(data):
            return np.empty(0, np.int64), np.zeros(len(parts), np.int64), long
        begins = np.zeros(len(data), np.int64)
        begins[opens] = 1
        place = np.arange(len(data)) + np.cumsum(begins) - 1
        stream = np.full(place[-1] + 2, _END, np.int64)
        stream[place] = data
        return stream, np.where(edges < len(data), place[np.minimum(edges, len(data) - 1)], len(stream)), long

    def _short_words(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """``_split`` of all parts without those with a word above ``LONG`` bytes, and the numbers of these."""
        data, opens, edges, long = self._split([self._normalized(p) for p in parts])
        if long:
            out = set(long)
            data, opens, edges, _ = self._split(["" if k in out else self._normalized(p) for k, p in enumerate(parts)])
        return data, opens, edges, long

    def _split(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """The bytes of all words, where each word begins, where each part ends, and the parts with a long word."""
        joined = " ".join(parts) + " "
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        raw = np.frombuffer(joined.encode("utf-8"), np.uint8)
        lead = (raw & 0xC0) != 0x80
        kind = self.classes[points]
        before = np.concatenate([[_SPACE], kind[:-1]])
        start = (kind == _NUMBER) | ((kind == _LETTER) & (before != _LETTER)) | ((kind == _OTHER) & (before != _OTHER))
        self._contractions(points, kind, start)
        char = np.cumsum(lead) - 1
        inside = kind[char] != _SPACE
        begins = (start[char] & lead)[inside]
        data = raw[inside]
        # Bytes of a part end where the next part begins.
        held = np.concatenate([[0], np.cumsum(inside)])
        edges = held[np.cumsum([len(p.encode("utf-8")) + 1 for p in parts])]
        opens = np.flatnonzero(begins)
        long = opens[np.diff(np.append(opens, len(data))) > LONG]
        owners = np.unique(np.searchsorted(edges, long, "right")).tolist()
        return data, opens, edges, owners

    @staticmethod
    def _contractions(points: np.ndarray, kind: np.ndarray, start: np.ndarray):
        """An apostrophe that begins a word takes s, t, m, d, re, ve or ll with it; a word begins behind them."""
        marks = np.flatnonzero((points == 39) & start)
        if not len(marks):
            return
        more = np.concatenate([points, np.zeros(3, np.uint32)])
        one, two = more[marks + 1], more[marks + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for found, size in ((marks[short], 2), (marks[long & ~short], 3)):
            start[found + 1] = False
            behind = found + size
            behind = behind[behind < len(kind)]
            start[behind[kind[behind] == _LETTER]] = True


_COUNTERS: dict[str, Counter] = {}


def counter_of(path: str, classes, odd: str) -> Counter:
    """The worker's counter for a vocabulary, with what earlier tasks of the worker compiled."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path, classes.value, odd)
    return _COUNTERS[path]


def normalized(text: str) -> str:
    """Composed form and lower case, letter by letter: a final sigma is not told apart."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ")
    return text.lower()


def _count(path: str, classes, odd: str):
    def run(batches):
        counter = counter_of(path, classes, odd)
        for batch in batches:
            for start, stop in slices(batch, "text", 2 << 20):
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in part.column("text").to_pylist()]
                n = counter.counts(texts)
                sizes = [len(t.encode("utf-8")) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sizes, pa.int64()), pa.array(n), pa.array(n > LIMIT)],
                                                 ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``, repeated keys included.

    A null text counts as empty and has no token. Special strings inside a text count one token each. Other columns are
    not looked at.
    """
    classes = docs.sparkSession.sparkContext.broadcast(character_classes(tokenizer))  # one byte per code point
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_count(tokenizer, classes, odd_characters(tokenizer)), f"doc_id {dict(rows.dtypes)['id']}, n_bytes long, n_tokens long, over_limit boolean")


@query("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
