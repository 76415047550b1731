"""Packing documents into sequences by order-preserving dynamic programming.

The documents of a task are one stream of token ids in scan order. Window cuts are chosen at document and sentence
boundaries so that padding plus the penalties of cut documents is least: ``cost(j) = min over i of cost(i) + padding(j - i)
+ penalty(j)`` with i at most a window before j; every window also has a small price. Padding falls by one with every token, so the best i of a sliding range
is kept by a monotone queue; lengths that are powers of two need no padding and are tried beside it.

A stream is cut in stretches of bounded length; the last, unfilled window of a stretch is carried into the next. Nothing
is shuffled, and a lost task is made again from its own input split with the same result.

Ids are those of the tokenizer's library, which is asked for each distinct word once, as far as a worker holds them.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, slices, table
from tidemark.llm.token_counts import character_classes, counter_of, odd_characters

#: Tokens of a sequence.
WINDOW = 2048
#: Id that ends every document.
END = 1
#: Penalty, in tokens of padding, of a cut at a sentence boundary and of one inside a sentence.
SENTENCE, INSIDE = 4.0, 64.0
#: Price of a sequence: padding is free at powers of two, and a sequence of a few tokens is still not worth it.
OPEN = 48.0
#: A sentence longer than this may also be cut inside, at every so many tokens.
STRIDE = 512
#: Tokens of one stretch of the stream.
STRETCH = 1 << 19

def choose_cuts(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Indexes into ``at`` of the cuts of least cost; the first and last entry are always cuts.

    ``at`` holds ascending positions whose neighbours are at most ``window`` apart. Ties go to the earliest start.
    """
    place, fine = at.tolist(), penalty.tolist()
    exact: dict[int, list[int]] = {}  # starts that are a power of two before a cut
    for k in range(6, window.bit_length()):  # OPEN is more than a shorter sequence saves
        source = np.minimum(np.searchsorted(at, at - (1 << k)), len(at) - 1)
        for j in np.flatnonzero(at[source] == at - (1 << k)).tolist():
            exact.setdefault(j, []).append(int(source[j]))
    cost, back = [0.0] * len(place), [0] * len(place)
    queue: deque[int] = deque([0])
    for j in range(1, len(place)):
        here = place[j]
        while here - place[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        best, source = cost[i] + window - (here - place[i]), i
        for i in exact.get(j, ()):
            if cost[i] < best:
                best, source = cost[i], i
        cost[j], back[j] = best + fine[j] + OPEN, source
        # The value of a start, without what depends on the end.
        value = cost[j] + here
        while queue and cost[queue[-1]] + place[queue[-1]] > value:
            queue.pop()
        queue.append(j)
    cuts = [len(place) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class Packer:
    """Takes documents in order and gives rows (document fields, piece, place in its sequence)."""

    def __init__(self, first: int, window: int = WINDOW):
        self.window, self.next = window, first
        self.held: list = []  # [fields, ids, start of the piece, tokens of the document, sentence ends]
        self.tokens = 0

    def add(self, fields, ids: np.ndarray, ends: np.ndarray) -> list[tuple]:
        rows = []
        for start in range(0, len(ids), STRETCH):
            part = ids[start:start + STRETCH]
            inner = ends[(ends > start) & (ends < start + len(part))] - start
            self.held.append([fields, part, start, len(ids), inner, start + len(part) == len(ids)])
            self.tokens += len(part)
            if self.tokens >= STRETCH:
                rows += self.cut(last=False)
        return rows

    def cut(self, last: bool) -> list[tuple]:
        if not self.tokens:
            return []
        at, fine, base = [0], [0.0], 0
        for _, ids, _, _, inner, closes in self.held:
            marks = np.concatenate([[0], inner, [len(ids)]])
            gaps = np.flatnonzero(np.diff(marks) > STRIDE)
            extra = np.concatenate([np.arange(marks[g] + STRIDE, marks[g + 1], STRIDE) for g in gaps] or [np.empty(0, np.int64)])
            points = np.concatenate([inner, extra, [len(ids)]])
            cost = np.concatenate([np.full(len(inner), SENTENCE), np.full(len(extra), INSIDE), [0.0 if closes else INSIDE]])
            order = np.argsort(points, kind="stable")
            at += (points[order] + base).tolist()
            fine += cost[order].tolist()
            base += len(ids)
        places, first = np.unique(np.array(at, np.int64), return_index=True)
        cuts = places[choose_cuts(places, np.array(fine)[first], self.window)]
        if not last and len(cuts) > 2:
            cuts = cuts[:-1]  # the last window may still be filled
        rows, base, k = [], 0, 0
        rest = []
        for fields, ids, start, total, inner, closes in self.held:
            low = 0
            while low < len(ids) and k < len(cuts) - 1:
                high = min(len(ids), int(cuts[k + 1]) - base)
                rows.append((fields, ids[low:high], start + low, total, self.next, base + low - int(cuts[k])))
                low = high
                if base + low == cuts[k + 1]:
                    k, self.next = k + 1, self.next + 1
            if low < len(ids):
                rest.append([fields, ids[low:], start + low, total, inner[inner > low] - low, closes])
            base += len(ids)
        self.held, self.tokens = rest, sum(len(x[1]) for x in rest)
        return rows


_PIECES = ("key long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _pack(path: str, with_ids: bool, classes, odd: str):
    def run(batches):
        encoder, packer = counter_of(path, classes, odd), Packer(TaskContext.get().partitionId() << 40)

        def table_of(rows):
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                pa.array([len(r[1]) for r in rows], pa.int64()),
                pa.array([r[1].astype("<u4").tobytes() if with_ids else None for r in rows], pa.binary()),
                pa.array([zlib.crc32(r[1].astype("<u4").tobytes()) for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64()),
                pa.array([r[5] for r in rows], pa.int64())],
                ["key", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for start, stop in slices(batch, "text", 2 << 20):
                rows, part = [], batch.slice(start, stop - start)
                found = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                for key, (ids, ends) in zip(part.column("key").to_pylist(), found, strict=True):
                    rows += packer.add(key, np.append(ids, np.uint32(END)), ends)
                if rows:
                    yield table_of(rows)
        rows = packer.cut(last=True)
        if rows:
            yield table_of(rows)

    return run


def pack(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian 32-bit), ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is a document, also without a key and also if it repeats one. A null or empty text is the end
    id alone. Other columns are not looked at. A sequence holds at most 2048 tokens.
    """
    classes = docs.sparkSession.sparkContext.broadcast(character_classes(tokenizer))  # one byte per code point
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        _pack(tokenizer, with_ids, classes, odd_characters(tokenizer)), _PIECES)
    return rows.withColumnRenamed("key", "doc_id")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op6_packing")
def op6_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), default_tokenizer(), with_ids=False).drop("ids")


def packing_stage(spark, docs, sf_dir):
    """Pieces with their ids; the last stage."""
    return pack(docs, default_tokenizer())
