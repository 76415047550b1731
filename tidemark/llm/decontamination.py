"""Benchmark decontamination by template windows.

Texts become templates: numbers, names and units turn into typed placeholders, all else into lower-case words. Windows
of five template tokens are hashed and joined with the windows of the benchmark. A benchmark item that was given other
numbers or names keeps its template, so it is still found; the slot check then asks that along one alignment every
value of the item stands for one value of the document and the other way round.

An item with few or no windows of enough words (a short one, or one full of numbers or names) is also looked for as a
whole: its tokens as written, and its template if that says enough. Letters of scripts without spaces are tokens each.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, query, slices, table
from tidemark.session import cut_lineage

#: Template tokens of a window, and how many of them have to be words.
WIDTH, LEAST_WORDS = 5, 3
#: A document holds an item if it has this share of the item's windows, and this many (all, if the item has fewer).
SHARE, LEAST_HITS = 0.3, 4
#: ... or this many windows whatever the share, which is a run of 13 tokens.
SURE_HITS = 9
#: A window of more items than this is looked up only where an item was found by other windows.
COMMON = 8
#: Bits of the filter that is sent to all tasks: 1 MB whatever the benchmark's size. What passes it is joined exactly.
FILTER_BITS = 1 << 23

#: Unit words, read as such only after a number.
UNITS = frozenset(
    "km m cm mm mile miles foot feet inch inches yard yards kg g mg lb lbs pound pounds ounce ounces ton tons l ml liter "
    "liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year "
    "years dollar dollars euro euros cent cents percent degree degrees mph kph watt watts volt volts hz mb gb tb".split())
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[$€£]?\d+(?:[.,:/]\d+)*%?|[.!?:;\n]")
#: Thai to Khmer, kana and Han are written without spaces.
_DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_HAS_DENSE = re.compile(f"[{_DENSE}]")
_DENSE_TOKEN = re.compile(rf"[$€£]?\d+(?:[.,:/]\d+)*%?|(?=[^\W\d_])[{_DENSE}]|[^\W\d_{_DENSE}]+(?:['’][^\W\d_{_DENSE}]+)*|[.!?:;\n。！？：；]")
_ENDS = ".!?:;\n。！？：；"
_WORD, _CAPITAL, _NUMBER, _UNIT, _END = range(5)
_NUM, _NAME, _UNITS = (np.uint64(xxhash.xxh64_intdigest(x)) for x in ("<number>", "<name>", "<unit>"))
#: Tokens whose codes a worker holds, some 30 MB.
TOKENS_HELD = 150_000


class _Codes(dict):
    """For each token met its hash, without the three lowest bits, which hold its kind."""

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token in _ENDS:
            kind = _END
        elif not token.isalpha() and any(c.isdigit() for c in token):
            kind = _NUMBER
        elif low in UNITS:
            kind = _UNIT
        else:
            kind = _CAPITAL if token[0].isupper() and not (len(token) > 1 and token.isupper()) else _WORD
        found = self[token] = xxhash.xxh64_intdigest(low) & -8 | kind
        return found

    def of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Kind and hash of each token."""
        if len(self) > TOKENS_HELD:
            self.clear()
        codes = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        return (codes & np.uint64(7)).astype(np.int8), codes & ~np.uint64(7)


_CODES = _Codes()


class _Text:
    """The template tokens of a text: ``h`` and ``plain`` hash them as placeholders or words and as written, ``slot`` marks
    the placeholders, ``words`` are the tokens as written."""

    def __init__(self, text: str | None):
        text = text or ""
        dense = not text.isascii() and _HAS_DENSE.search(text)
        tokens = (_DENSE_TOKEN if dense else _TOKEN).findall(text)
        kind, plain = _CODES.of(tokens)
        before = np.concatenate([[_END], kind])[:-1] if len(kind) else kind
        name = (kind == _CAPITAL) & (before != _END)
        number, unit = kind == _NUMBER, (kind == _UNIT) & (before == _NUMBER)
        h = plain.copy()
        h[number], h[name], h[unit] = _NUM, _NAME, _UNITS
        self.real = np.flatnonzero(kind != _END)
        self.whole_kind, self.kind = kind, kind[self.real]
        self.h, self.plain, self.slot = h[self.real], plain[self.real], (number | name | unit)[self.real]
        self.words = [tokens[i] for i in self.real] if self.slot.any() else []
        self.sums: dict[int, tuple] = {}

    def alone(self, n: int) -> np.ndarray:
        """Starts of the runs of ``n`` tokens that are whole sentences or lines."""
        end = np.concatenate([[True], self.whole_kind == _END, [True]])
        begins, stops = end[self.real], end[self.real + 2]
        return np.flatnonzero(begins[:len(begins) - n + 1] & stops[n - 1:]) if len(begins) >= n else np.empty(0, np.int64)

    def runs(self, form: int, start: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
        """Hash of the ``n`` tokens from each start, as written or as a template. What stands before a run has no part."""
        if form not in self.sums:
            h = self.plain if form == _LITERAL else self.h
            first = self.plain if form == _LITERAL else np.where(self.kind == _NUMBER, _NUM, self.plain)
            self.sums[form] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(len(h))[0], dtype=np.uint64)]), first
        sums, first = self.sums[form]
        out = (sums[start + n] - sums[start + 1]) * _powers(len(self.h))[1][start] + first[start]
        out = (out ^ (out >> np.uint64(31))) + np.uint64((n * 8 + salt * 2 + form) * 0x9E3779B97F4A7C15 % 2**64)
        out = (out ^ (out >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return (out ^ (out >> np.uint64(33))).view(np.int64)

    def values(self, form: int, start: int, n: int) -> list[str]:
        """The values of a run's slots; none of a run as written."""
        if form == _LITERAL or not self.words:
            return []
        return [self.words[i].lower() for i in range(start, start + n) if (self.slot[i] if i > start else self.kind[i] == _NUMBER)]

    def forms(self) -> list[int]:
        """In which forms the text is looked for as a whole, if it is a benchmark item.

        Its template says enough if it has a word, and fewer names than words, numbers and units.
        """
        names = int((self.slot & (self.kind == _CAPITAL)).sum())
        telling = 0 < self.slot.sum() < len(self.h) and 2 * names < len(self.h)
        return [_LITERAL, _TEMPLATE] if telling else [_LITERAL] if len(self.h) else []


_LITERAL, _TEMPLATE = range(2)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64, ``n`` or more."""
    if len(_POWERS[0]) < n:
        base = 0xD6E8FEB86659FD93
        for k, x in enumerate((base, pow(base, -1, 2**64))):
            factors = np.full(2 * n, x, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors, dtype=np.uint64)
    return [p[:n] for p in _POWERS]


def template(text: str | None) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Hash of every template token, whether it is a placeholder, and, if any is, the tokens as written.

    A capitalised word is a name unless it begins a sentence; a word all in capitals is a plain word.
    """
    found = _Text(text)
    return found.h, found.slot, found.words


def windows(h: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window with enough words."""
    n = len(h) - WIDTH + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        out = (out ^ h[k:n + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    held = np.concatenate([[0], np.cumsum(slot)])
    good = np.flatnonzero(held[WIDTH:] - held[:-WIDTH] <= WIDTH - LEAST_WORDS)
    return good, out[good].view(np.int64)


_HITS = "key long, at long, hash long, slots array<string>"


def _passed(w: np.ndarray, bits: np.ndarray) -> np.ndarray:
    cell = w & (FILTER_BITS - 1)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0


def _shapes(batches):
    """form, n and, for WIDTH tokens and more, the hash of the first WIDTH: of the items that are looked for as a whole."""
    for batch in batches:
        found = []
        for text in batch.column("text"):
            read = _Text(text.as_py())
            n = len(read.h)
            if len(windows(read.h, read.slot)[0]) < LEAST_HITS:
                found += [(form, n, int(read.runs(form, np.zeros(1, np.int64), WIDTH, 1)[0]) if n >= WIDTH else None) for form in read.forms()]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["form", "n", "anchor"])


def _whole_runs(read: _Text, bits: np.ndarray, shapes: dict[int, list[int]]):
    """(form, n, starts, hashes) of the runs that may be whole items.

    A run of fewer than WIDTH tokens has to be a sentence or line of its own.
    """
    size = len(read.h)
    for form, sizes in shapes.items():
        near = None
        for n in sizes:
            if n > size:
                continue
            if n < WIDTH:
                p = read.alone(n)
            else:
                if near is None:
                    near = np.arange(size - WIDTH + 1)
                    near = near[_passed(read.runs(form, near, WIDTH, 1), bits)]
                p = near[near <= size - n]
            if len(p):
                w = read.runs(form, p, n)
                hit = _passed(w, bits)
                if hit.any():
                    yield form, n, p[hit], w[hit]


def _window_rows(batches, bits=None, shapes=None):
    """Rows of ``_HITS``; with ``bits`` only windows that the filter lets through.

    An item that is looked for as a whole stands at -1, and a run of a document one before its start.
    """
    for batch in batches:
        for start, stop in slices(batch, "text"):
            keys, at, hashes, slots = [], [], [], []
            for key, text in zip(batch.column("key").slice(start, stop - start), batch.column("text").slice(start, stop - start), strict=True):
                read = _Text(text.as_py())
                h, slot, words = read.h, read.slot, read.words
                p, w = windows(h, slot)
                whole = []
                if bits is None and len(p) < LEAST_HITS:
                    whole = [(f, len(h), np.zeros(1, np.int64), read.runs(f, np.zeros(1, np.int64), len(h))) for f in read.forms()]
                elif bits is not None:
                    if len(w):
                        hit = _passed(w, bits)
                        p, w = p[hit], w[hit]
                    if shapes:
                        whole = list(_whole_runs(read, bits, shapes))
                if len(p):
                    keys += [key.as_py()] * len(p)
                    at += p.tolist()
                    hashes.append(w)
                    slots += [[words[i].lower() for i in range(x, x + WIDTH) if slot[i]] if slot[x:x + WIDTH].any() else [] for x in p]
                for form, n, p, w in whole:
                    keys += [key.as_py()] * len(p)
                    at += (p - 1).tolist()
                    hashes.append(w)
                    slots += [read.values(form, x, n) for x in p]
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(at, pa.int64()), pa.array(np.concatenate(hashes)),
                     pa.array(slots, pa.list_(pa.string()))], ["key", "at", "hash", "slots"])
    _CODES.clear()  # the worker goes on with other work
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _needed():
    """Windows of an item that a document has to hold."""
    enough = F.greatest(F.least(F.lit(LEAST_HITS), F.col("n_windows")), F.ceil(F.col("n_windows") * SHARE))
    return F.least(enough, F.lit(SURE_HITS))


def _met(hits: DataFrame, known: DataFrame, sizes: DataFrame) -> DataFrame:
    """Windows of documents with the equal windows of items, for every pair of them that holds enough.

    A window of many items (a stock phrase of the benchmark) would meet all its documents with all its items. Of each
    item such windows are put off, the most frequent first, as long as a document that holds none but these has too few
    of them. The other windows find the pairs; for these alone the ones put off are looked up, by document and hash.
    """
    frequent = known.where("item_at >= 0").groupBy("hash").agg(F.countDistinct("item").alias("items")).where(
        F.col("items") > COMMON).withColumnRenamed("hash", "of")
    if frequent.isEmpty():
        return hits.join(known, "hash")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc_nulls_last("items"), "item_at"))
    # An item that is looked for as a whole is found by its row at -1, which has no count and comes last.
    ranked = known.join(frequent, (F.col("hash") == F.col("of")) & (F.col("item_at") >= 0), "left").withColumn("place", place).join(sizes, "item")
    late = F.col("items").isNotNull() & (F.col("place") < _needed())
    ranked = cut_lineage(ranked.select(*known.columns, late.alias("late")))
    hits = cut_lineage(hits)
    found = hits.join(ranked.where(~F.col("late")).drop("late"), "hash")
    rest = found.select("key", "item").distinct().join(ranked.where("late").drop("late"), "item").join(hits, ["key", "hash"])
    return found.unionByName(rest)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """doc_id, item_id, n_windows (of the item), n_hits, n_slots: one row per document and item that it holds.

    Null and short texts hold nothing, and a key or item id that is null finds nothing either. An item with fewer than
    LEAST_HITS windows is found by these and by its whole run of tokens, which counts as all of its windows, and as one
    if it has none; with fewer than five tokens it has to be a sentence or line of its own. Rows that repeat a key count
    as one document, items that repeat an id as one item. Other columns are not looked at.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("long").alias("key"), F.col(item_text).cast("string").alias("text")).dropna()
    known = items.mapInArrow(_window_rows, _HITS).select(
        F.col("key").alias("item"), F.col("at").alias("item_at"), "hash", F.col("slots").alias("item_slots")).distinct()
    short = items.mapInArrow(_shapes, "form long, n long, anchor long")
    # At most FILTER_BITS cells, and one row for every length of an item that is looked for as a whole.
    cells = known.select("hash").union(short.where("anchor IS NOT NULL").select("anchor")).select(
        F.pmod("hash", F.lit(FILTER_BITS)).alias("cell")).distinct().toPandas()["cell"].to_numpy()
    sizes = short.select("form", "n").distinct().collect()
    shapes = {f: sorted({r["n"] for r in sizes if r["form"] == f}) for f in sorted({r["form"] for r in sizes})}
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    np.bitwise_or.at(bits, cells >> 3, np.uint8(1) << (cells & 7).astype(np.uint8))
    shared = spark.sparkContext.broadcast(bits)
    hits = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).dropna().mapInArrow(
        lambda batches: _window_rows(batches, shared.value, shapes), _HITS)
    sizes = known.groupBy("item").agg(F.greatest(F.lit(1), F.countDistinct(F.when(F.col("item_at") >= 0, F.col("item_at")))).alias("n_windows"))
    pairs = _met(hits, known, sizes).select(
        "key", "item", "item_at", (F.col("at") - F.col("item_at")).alias("shift"), F.arrays_zip(
            F.col("item_slots").alias("i"), F.col("slots").alias("d")).alias("values"))
    # One alignment of one document with one item: at most as many rows as the item has windows.
    lines = pairs.groupBy("key", "item", "shift").agg(
        F.collect_set("item_at").alias("hit"), F.array_distinct(F.flatten(F.collect_set("values"))).alias("values"))
    one_to_one = (F.size("values") == F.size(F.array_distinct(F.transform("values", lambda v: v["i"])))) & (
        F.size("values") == F.size(F.array_distinct(F.transform("values", lambda v: v["d"]))))
    good = lines.where(one_to_one).select("key", "item", F.explode("hit").alias("at"), F.size("values").alias("slots"))
    found = good.groupBy("key", "item").agg(
        F.countDistinct(F.when(F.col("at") >= 0, F.col("at"))).alias("n_hits"), F.max("slots").cast("long").alias("n_slots"),
        F.max(F.col("at") < 0).alias("whole"))
    found = found.join(sizes, "item").withColumn("n_hits", F.when(F.col("whole"), F.col("n_windows")).otherwise(F.col("n_hits")))
    return found.where(F.col("n_hits") >= _needed()).select(
        F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "n_windows", "n_hits", "n_slots")


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold no benchmark item. Rows without a doc_id pass."""
    name = free_name(docs, "held_id")
    held = contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(held, docs["doc_id"].cast("long") == held[name], "left_anti")
