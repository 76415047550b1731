"""Periodic runs of words by grammar compression.

The word numbers of a document are compressed by Re-Pair: the most frequent pair of neighbouring symbols becomes a new
symbol, until no pair stands twice. Pairs are replaced in rounds: in one round every pair is taken where it is more
frequent than both pairs that it overlaps (the shorter one at equal frequency), so many documents are compressed side by
side in arrays. What is left of a document is joined to a balanced tree.

A run lies in the expansion of exactly one node of that tree whose halves it crosses. So each symbol's boundary is looked
at once, in its first expansion: a run of exponent four has two periods on one side of it, which begin (or end) with the
word at the boundary; a hash of both periods picks the periods to look at, the words themselves decide. A run of a symbol
is carried to all its places in the derivation; there, stretches of one period that overlap by a period are one run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, slices, table

#: A run holds its period so many times, and so many words.
EXPONENT, WORDS = 4, 6
#: Boundaries and periods that are looked at in one go: they bound the memory of a long text.
_NODES, _CANDIDATES = 1 << 18, 1 << 20
_BASE = np.uint64(0xD6E8FEB86659FD93)
_POWERS = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        factors = np.full(max(n, 1 << 16), _BASE, np.uint64)
        factors[0] = 1
        _POWERS[0] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS[0][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all documents in a row, no number in two of them, and where each document begins."""
    sizes = np.array([len(words) for words in documents], np.int64)
    ids, base, at = np.empty(int(sizes.sum()), np.int64), 0, 0
    for words in documents:
        known = dict.fromkeys(words)
        known = dict(zip(known, range(base, base + len(known)), strict=True))
        ids[at:at + len(words)] = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        base, at = base + len(known), at + len(words)
    return ids, np.concatenate([[0], np.cumsum(sizes)])


class Grammar:
    """Derivation trees of all documents: ``rule`` of each inner node, and its expansion ``[begin:middle:end]``.

    Nodes of one rule expand to the same words.
    """

    def __init__(self, ids: np.ndarray, starts: np.ndarray):
        self.nodes: list[tuple[np.ndarray, ...]] = []
        self.next = int(ids.max()) + 1 if len(ids) else 0
        symbols, begin = ids.copy(), np.arange(len(ids))
        size = np.ones(len(ids), np.int64)
        last = np.zeros(len(ids), bool)
        last[starts[1:][starts[1:] > starts[:-1]] - 1] = True
        symbols, begin, size, last = self._pairs(symbols, begin, size, last)
        self._balance(begin, size, last)
        self.rule, self.begin, self.middle, self.end = (
            np.concatenate(x) if self.nodes else np.empty(0, np.int64) for x in (list(zip(*self.nodes, strict=True)) or [()] * 4))

    def _join(self, chosen: np.ndarray, rules: np.ndarray, symbols, begin, size, last, *more):
        """Replace the symbols at ``chosen`` and behind them by ``rules``."""
        self.nodes.append((rules, begin[chosen], begin[chosen + 1], begin[chosen] + size[chosen] + size[chosen + 1]))
        symbols[chosen] = rules
        size[chosen] += size[chosen + 1]
        last[chosen] = last[chosen + 1]
        kept = np.ones(len(symbols), bool)
        kept[chosen + 1] = False
        return [x[kept] for x in (symbols, begin, size, last, *more)]

    def _pairs(self, symbols, begin, size, last):
        # A pair that stands once stays alone, as replacing others takes pairs away; only pairs with a new symbol are new.
        fresh = ~last
        while True:
            at = np.flatnonzero(fresh)
            if len(at) < 2:
                return symbols, begin, size, last
            key = symbols[at] * (self.next + 1) + symbols[at + 1]
            order = np.argsort(key, kind="stable")
            bounds = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
            counts = np.diff(np.append(bounds, len(order)))
            kinds = np.repeat(np.arange(len(bounds)), counts)
            often = counts > 1
            if not often.any():
                return symbols, begin, size, last
            # Rank of each pair: frequent ones first, then short ones, then by a hash: in any other order a repeated
            # passage could have one best pair only, and take a round for each of its words.
            heads = order[bounds[often]]
            first = np.full(len(bounds), len(bounds), np.int64)
            by = np.lexsort((_mixed(key[heads]), size[at[heads]] + size[at[heads] + 1], -counts[often]))
            first[np.flatnonzero(often)[by]] = np.arange(len(by))
            none = len(bounds)
            rank = np.full(len(symbols) + 2, none, np.int64)  # one more on either side
            rank[at[order] + 1] = first[kinds]
            fresh[at[order[~often[kinds]]]] = False
            here, before, behind = rank[1:-1], rank[:-2], rank[2:]
            # Pairs of equal symbols overlap themselves: of such a stretch every second one is taken.
            opens = (here < none) & (here != before)
            stretch = np.flatnonzero(opens)
            index = np.cumsum(opens) - 1
            inside = np.flatnonzero(here < none)
            good = here[stretch] < before[stretch]
            closing = np.flatnonzero((here < none) & (here != behind))
            good &= here[closing] < behind[closing]
            place = inside - stretch[index[inside]]
            chosen = inside[good[index[inside]] & (place % 2 == 0)]
            kind = here[chosen]
            used = np.unique(kind)
            rules = self.next + np.searchsorted(used, kind)
            self.next += len(used)
            fresh[chosen] = True
            fresh[np.maximum(chosen - 1, 0)] = True
            symbols, begin, size, last, fresh = self._join(chosen, rules, symbols, begin, size, last, fresh)
            fresh &= ~last

    def _balance(self, begin, size, last):
        symbols = np.zeros(len(begin), np.int64)
        while len(begin):
            opens = np.concatenate([[True], last[:-1]])
            place = np.arange(len(begin)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]
            chosen = np.flatnonzero((place % 2 == 0) & ~last)
            if not len(chosen):
                return
            rules = self.next + np.arange(len(chosen))
            self.next += len(chosen)
            symbols, begin, size, last = self._join(chosen, rules, symbols, begin, size, last)


def _same(ids: np.ndarray, x: int, y: int, most: int, step: int) -> int:
    """How many words from ``x`` and ``y`` on (back, if ``step`` is -1) are the same, ``most`` at the most."""
    done, width = 0, 32
    while done < most:
        n = min(width, most - done)
        if step > 0:
            other = ids[x + done:x + done + n] != ids[y + done:y + done + n]
        else:
            other = ids[x - done - n + 1:x - done + 1][::-1] != ids[y - done - n + 1:y - done + 1][::-1]
        if other.any():
            return done + int(other.argmax())
        done, width = done + n, width * 2
    return done


def crossing_runs(ids: np.ndarray, begin: np.ndarray, middle: np.ndarray, end: np.ndarray, exponent: int = EXPONENT,
                  least: int = WORDS) -> list[tuple[int, int, int, int]]:
    """(node, start, end, period) of the stretches within ``[begin:end]`` that cross ``middle`` and have the length of a run."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    keys = ids[order] * n + order  # ascending: places of each word
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    power = _powers(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(ids) * power[:n], dtype=np.uint64)])
    # Periods that fit: two of them on the one side, ``exponent`` of them in all.
    half = np.maximum((exponent + 1) // 2, 2)
    whole = (end - begin) // exponent
    found: dict[tuple[int, int, int], int] = {}

    def look(side: int):
        word = middle if side > 0 else middle - 1
        most = np.minimum((end - middle if side > 0 else middle - begin) // half, whole)
        if side > 0:
            low = place[word] + 1
            high = np.searchsorted(keys, ids[word] * n + word + most, "right")
        else:
            low = np.searchsorted(keys, ids[word] * n + word - most)
            high = place[word]
        counts = np.maximum(high - low, 0)
        nodes = np.flatnonzero(counts)
        edges = np.cumsum(counts[nodes])
        at = 0
        while at < len(nodes):
            stop = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + _CANDIDATES, "right")))
            some = nodes[at:stop]
            many = counts[some]
            owner = np.repeat(some, many)
            index = np.repeat(low[some] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(len(owner))
            period = np.abs(order[index] - word[owner])
            x = middle[owner] if side > 0 else middle[owner] - 2 * period
            y = x + period
            same = (sums[y] - sums[x]) * power[period] == sums[y + period] - sums[y]
            owner, period = owner[same], period[same]
            by = np.lexsort((period, owner))
            owner, period = owner[by], period[by]
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0, [True]])) if len(owner) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                one(int(owner[a]), period[a:b], side)
            at = stop

    def one(node: int, periods: np.ndarray, side: int):
        s, b, e = int(begin[node]), int(middle[node]), int(end[node])
        while len(periods):
            q = int(periods[0])
            periods = periods[1:]
            if side > 0:
                right = _same(ids, b, b + q, e - b - q, 1)
                if right < q:  # a false hit of the hash
                    continue
                i, j = b - _same(ids, b - 1, b - 1 + q, b - s, -1), b + q + right
                # What is periodic as far as that has q as its least period, the others there are multiples of it.
                periods = periods[b + 2 * periods > j]
            else:
                left = _same(ids, b - 1, b - 1 - q, b - q - s, -1)
                if left < q:
                    continue
                i, j = b - q - left, b + _same(ids, b, b - q, e - b, 1)
                periods = periods[b - 2 * periods < i]
            if i < b < j and j - i >= max(least, exponent * q):
                found[node, i, j] = min(q, found.get((node, i, j), q))

    look(1)
    look(-1)
    return [(node, i, j, q) for (node, i, j), q in found.items()]


def find_runs(ids: np.ndarray, starts: np.ndarray, exponent: int = EXPONENT, least: int = WORDS) -> tuple[np.ndarray, ...]:
    """Start and end in ``ids``, and period, of all runs of all documents, by start and then period.

    A run is a maximal stretch of one document with the least period q that holds at least ``exponent`` (4 or more) times
    q words and ``least`` words.
    """
    none = np.empty(0, np.int64)
    if exponent < 4:
        raise ValueError("a run has to hold its period four times, so that one side of any boundary holds it twice")
    grammar = Grammar(ids, starts)
    long = np.flatnonzero(grammar.end - grammar.begin >= max(least, exponent))
    rules, first = np.unique(grammar.rule[long], return_index=True)
    heads = long[first]
    pieces = []
    for at in range(0, len(heads), _NODES):
        some = heads[at:at + _NODES]
        pieces += [(at + k, i, j, q) for k, i, j, q in crossing_runs(
            ids, grammar.begin[some], grammar.middle[some], grammar.end[some], exponent, least)]
    if not pieces:
        return none, none, none
    node, i, j, q = np.array(pieces, np.int64).T
    # To all places of the rule in the derivation: the nodes of a rule follow one another in ``by``.
    by = long[np.argsort(grammar.rule[long], kind="stable")]
    low = np.searchsorted(grammar.rule[by], rules[node])
    times = np.searchsorted(grammar.rule[by], rules[node], "right") - low
    piece = np.repeat(np.arange(len(node)), times)
    where = by[np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(len(piece))]
    shift = grammar.begin[where] - grammar.begin[heads[node[piece]]]
    i, j, q = i[piece] + shift, j[piece] + shift, q[piece]
    # Stretches of one period that overlap by a period are one.
    by = np.lexsort((i, q))
    i, j, q = i[by], j[by], q[by]
    floor = np.cumsum(np.concatenate([[False], np.diff(q) != 0])) * (len(ids) + 1)
    reach = np.maximum.accumulate(j + floor) - floor
    new = np.concatenate([[True], (np.diff(q) != 0) | (i[1:] > reach[:-1] - q[1:])])
    opens = np.flatnonzero(new)
    i, j, q = i[opens], np.maximum.reduceat(j, opens), q[opens]
    by = np.lexsort((q, i))
    return i[by], j[by], q[by]


_SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(exponent: int, least: int, change):
    def run(batches):
        for batch in batches:
            for low, high in slices(batch, "text", 2 << 20):
                part = batch.slice(low, high - low)
                documents = [(t or b"").split() for t in part.column("text").cast(pa.binary()).to_pylist()]
                if change:
                    documents = [change(k, w) for k, w in zip(part.column("key").to_pylist(), documents, strict=True)]
                ids, starts = numbered(documents)
                i, j, q = find_runs(ids, starts, exponent, least)
                # Words that a run repeats.
                depth = np.zeros(len(ids) + 1, np.int32)
                np.add.at(depth, i + q, 1)
                np.add.at(depth, j, -1)
                kept = np.cumsum(depth[:-1]) == 0
                edges = np.searchsorted(i, starts)
                collapsed = []
                for k, words in enumerate(documents):
                    if edges[k + 1] > edges[k]:
                        words = [words[x] for x in np.flatnonzero(kept[starts[k]:starts[k + 1]]).tolist()]
                    collapsed.append(b" ".join(words))
                runs = pa.StructArray.from_arrays(
                    [pa.array(i - np.repeat(starts[:-1], np.diff(edges))), pa.array(j - i), pa.array(q)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(starts)), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", exponent: int = EXPONENT, least: int = WORDS,
                  change: Callable[[str | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed: one row per row of ``docs``.

    Words are what stands between space and the controls from tab to carriage return; ``collapsed`` has those that no run
    repeats, with one space between them. A null or empty text has no word and no run. ``change`` may alter the words of
    a document, given its key as text, before runs are looked for. Rows that repeat a key are looked at each by itself;
    other columns are not looked at.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_found(exponent, least, change), f"doc_id {dict(rows.dtypes)['id']}, {_SCHEMA}")


def with_repeated_tail(key: str | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten, by a hash of its key, end in a piece of their own, over and over."""
    g, rest = divmod(zlib.crc32((key or "").encode()), 10)
    n = len(words)
    if rest or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), change=with_repeated_tail)
    # Of two runs the one with the greater exponent; the earlier one, in the order of the list, of equal exponents.
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
