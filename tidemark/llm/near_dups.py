"""Near duplicates by MinHash with tensored banding.

Two small collections of hash groups, A and B, are computed for a document: ``SIDE`` groups of ``ROWS`` minhashes each.
A table key combines one group of A with one of B, so ``2 * SIDE * ROWS`` minhashes give ``SIDE * SIDE`` tables, each
keyed by ``2 * ROWS`` minhashes. Candidates are confirmed on the full shingle sets.

Work is done on classes of documents with the same shingle set, so thousands of copies are one row. A class enters the
tables only with groups that another class has too. In a bucket all classes are compared with one pivot; what is still
split is compared block by block in ``rest_pairs``, so a bucket of any size is finished without writing all of its pairs.
Blocks are compared on sketches; the full sets that a block needs then go to it once, however many pairs they are in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, query, release, slices, table
from tidemark.session import cut_lineage

#: Words of a shingle.
SHINGLE = 5
#: Hash groups in either collection, and minhashes in a group. At similarity 0.75 a pair misses all tables with a
#: probability of 1e-4; every further group costs two keys a document.
SIDE, ROWS = 12, 2
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Words whose hashes a worker holds, some 10 MB; most words of a text are among the frequent ones.
WORDS_HELD = 1 << 16
#: Rows of one block of the comparison of a split bucket.
BLOCK = 512
#: Minhashes of the sketch by which blocks are compared. Pairs that agree in a share of SURE or more are linked for the
#: block at hand, which spares the pairs between their components; pairs below MAYBE (4 deviations under 0.75, a miss of
#: 3e-5) are dropped; all others are confirmed on sets. If one that was sure is not, the rest is compared once more.
SKETCH, MAYBE, SURE = 256, 0.64, 0.86

_SEEDS = np.random.default_rng(20240901).integers(1, 2**63, (2, 2 * SIDE * ROWS), dtype=np.uint64) | np.uint64(1)
_SKETCH_SEEDS = np.random.default_rng(20240902).integers(1, 2**63, (2, SKETCH), dtype=np.uint64) | np.uint64(1)
_WORD_HASHES: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    A-Z are lower-cased; words are runs without space and the controls from tab to carriage return. Fewer words than
    ``size`` make one shingle; no word, no shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = _WORD_HASHES
    if len(known) > WORDS_HELD:
        known.clear()
    hashes = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh64_intdigest(w)
        hashes[i] = h
    width = min(size, len(words))
    h = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(words) - width + 1 + k])
    return np.unique(h)


def minhashes(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    least = np.full(seeds.shape[1], np.uint64(2**64 - 1))
    for start in range(0, len(shingles), 4096):
        part = shingles[start:start + 4096]
        mixed = part[None, :] * seeds[0][:, None] + seeds[1][:, None]
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, (mixed * np.uint64(0x9E3779B97F4A7C15)).min(axis=1))
    return least


def group_keys(shingles: np.ndarray) -> np.ndarray:
    """The ``2 * SIDE`` group keys: each mixes ``ROWS`` minhashes and its own number. Keys of A are even, of B odd."""
    least = minhashes(shingles, _SEEDS)
    keys = np.arange(1, 2 * SIDE + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + least[r::ROWS])
    side = (np.arange(2 * SIDE) >= SIDE).astype(np.uint64)
    return ((keys & ~np.uint64(1)) | side).view(np.int64)


def class_of(shingles: np.ndarray) -> int:
    """64-bit name of a set; two of a billion different sets share one with a probability of 3 %."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2**63


_SKETCH = "id long, n_shingles long, cls long, bands array<long>"


def _sketches(batches):
    for batch in batches:
        for start, stop in slices(batch, "text", 16 << 20):
            part = batch.slice(start, stop - start)
            counts, classes, keys = [], [], []
            for text in part.column("text"):
                s = shingle_set(text.as_py())
                counts.append(len(s))
                classes.append(class_of(s) if len(s) else None)
                keys.append(group_keys(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(counts, pa.int64()), pa.array(classes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "n_shingles", "cls", "bands"])
    _WORD_HASHES.clear()  # the worker goes on with other work


def sketches(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """id, n_shingles, cls (hash of the set; null for an empty one), bands: one row per row of ``docs``."""
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _sketches, _SKETCH)


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key also stands with another class."""
    more = rows.groupBy(key).agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi").select(key)
    return rows.join(more, key)


def table_rows(classes: DataFrame) -> DataFrame:
    """bucket, cls: rows of the tensored tables, only of buckets with two classes or more.

    A bucket's classes share its group of A and its group of B, so classes are first reduced to groups that are shared.
    """
    groups = classes.select("cls", F.explode("bands").alias("key"))
    held = _shared(groups, "key").groupBy("cls").agg(  # at most 2 * SIDE keys of a class
        F.array_sort(F.collect_list(F.when(F.col("key") % 2 == 0, F.col("key")))).alias("a"),
        F.array_sort(F.collect_list(F.when(F.col("key") % 2 != 0, F.col("key")))).alias("b"))
    pairs = held.select("cls", F.explode("a").alias("x"), "b").select("cls", "x", F.explode("b").alias("y"))
    return _shared(pairs.select("cls", F.xxhash64("x", "y").alias("bucket"), "x", "y"), "bucket").select("bucket", "x", "y", "cls")


def _linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    small, large = sorted((len(x), len(y)))
    if 100 * small < percent * large:
        return False
    same = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * same >= percent * (small + large - same)


def _confirm(batches):
    for batch in batches:
        hits = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
        kept = batch.filter(pa.array(hits, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v")], ["u", "v"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    x = sets.select(F.col("cls").alias("u"), F.col("shingles").alias("x"))
    y = sets.select(F.col("cls").alias("v"), F.col("shingles").alias("y"))
    return pairs.join(x, "u").join(y, "v").select("u", "v", "x", "y").mapInArrow(_confirm, "u long, v long")


def pivot_pairs(rows: DataFrame) -> DataFrame:
    """u, v: every class of a bucket with the bucket's pivot, the class that stands in most shared buckets."""
    weight = rows.groupBy("cls").agg(F.count(F.lit(1)).alias("weight"))
    pivots = rows.join(weight, "cls").groupBy("bucket").agg(F.max(F.struct("weight", "cls")).alias("p"))
    found = rows.join(pivots.select("bucket", F.col("p.cls").alias("pivot")), "bucket").where("cls <> pivot")
    return found.select(F.least("cls", "pivot").alias("u"), F.greatest("cls", "pivot").alias("v")).distinct()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """node, root: the least node that links (u, v) lead to, by alternating large and small stars.

    Each round is written to the shared folder; only a count and a checksum come to the driver. Raises if the links are
    not settled after ``rounds`` rounds, which would take chains of 2 ** rounds links.
    """
    edges = cut_lineage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        small = small.select("u", F.col("m").alias("v")).unionAll(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        edges = cut_lineage(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(now)
    raise RuntimeError("components are not settled")


_FOUND = "bucket long, i long, o long, us array<long>, vs array<long>, sure array<boolean>"


def _compare_blocks(least_sure: float):
    """Candidate pairs between classes of different components, one row a block; the rows of a block follow one another."""

    def parts(held: list[pa.RecordBatch], last: bool):
        whole = pa.Table.from_batches(held).combine_chunks()
        names = np.column_stack([whole.column(c).to_numpy() for c in ("bucket", "i", "o")])
        bounds = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
        edges = [0, *bounds.tolist(), len(names)]
        done = edges[-1] if last else edges[-2]
        held[:] = [] if last else whole.slice(done).to_batches()
        cls, root = whole.column("cls").to_numpy(), whole.column("root").to_numpy()
        outer = whole.column("outer").to_numpy(zero_copy_only=False)
        marks = np.frombuffer(b"".join(whole.column("sketch").slice(0, done).to_pylist()), np.uint8).reshape(-1, SKETCH)
        bands = np.frombuffer(b"".join(whole.column("bands").slice(0, done).to_pylist()), np.uint32).reshape(-1, 2 * SIDE)
        x, y = whole.column("x").to_numpy(), whole.column("y").to_numpy()
        rows = []
        for a, b in zip(edges, edges[1:], strict=False):
            if b <= done:
                found = _candidates(cls[a:b], root[a:b], outer[a:b], marks[a:b], bands[a:b], (int(x[a]), int(y[a])), least_sure)
                if found:
                    rows.append((*names[a].tolist(), *map(list, zip(*found, strict=True))))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        types = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.bool_())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "i", "o", "us", "vs", "sure"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if len(batch):
                held.append(batch)
                if sum(map(len, held)) >= 8 * BLOCK:
                    yield parts(held, last=False)
        if held:
            yield parts(held, last=True)

    return run


def _candidates(cls: np.ndarray, root: np.ndarray, outer: np.ndarray, marks: np.ndarray, bands: np.ndarray,
                table_key: tuple[int, int], least_sure: float = SURE) -> list[tuple[int, int, bool]]:
    """Pairs with like sketches, each only in the first table that the two share, and none that surer pairs make needless."""
    rows, others = np.flatnonzero(outer), np.flatnonzero(~outer)
    if not len(rows) or not len(others):
        return []
    share = np.array([(marks[others] == marks[i]).mean(axis=1) for i in rows])
    share[root[rows][:, None] == root[others][None, :]] = 0
    merged: dict = {}

    def find(r):
        while r in merged:
            r = merged[r]
        return r

    found = []
    hits = np.argwhere(share >= MAYBE)
    same = bands[rows[hits[:, 0]]] == bands[others[hits[:, 1]]]
    one = bands[rows[hits[:, 0]]]
    at = np.arange(len(hits))
    low = [k & 0xFFFFFFFF for k in table_key]  # the half of a group key that rows carry
    first = (one[at, same[:, :SIDE].argmax(axis=1)] == low[0]) & (one[at, SIDE + same[:, SIDE:].argmax(axis=1)] == low[1])
    hits = hits[first]
    for a, b in hits[np.argsort(-share[hits[:, 0], hits[:, 1]], kind="stable")]:
        x, y = find(root[rows[a]]), find(root[others[b]])
        if x != y:
            sure = bool(share[a, b] >= least_sure)
            found.append((int(min(cls[rows[a]], cls[others[b]])), int(max(cls[rows[a]], cls[others[b]])), sure))
            if sure:
                merged[max(x, y)] = min(x, y)
    return found


def confirmed_blocks(found: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v, linked: the candidate pairs of blocks that are links, and those that were sure and are none.

    A block gets each set it needs once, ahead of its pairs; it needs those of two blocks of rows at the most.
    """
    block = ["bucket", "i", "o"]
    members = found.select(*block, F.explode(F.array_distinct(F.concat("us", "vs"))).alias("cls"))
    held = members.join(sets.select("cls", "shingles"), "cls").select(
        *block, F.lit(0).alias("kind"), "cls", "shingles", *[F.lit(None).cast(t).alias(c) for c, t in found.dtypes[3:]])
    asked = found.select(*block, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("cls"),
                         F.lit(None).cast("binary").alias("shingles"), "us", "vs", "sure")
    return held.unionByName(asked).repartition(*block).sortWithinPartitions(*block, "kind").mapInArrow(
        _confirm_blocks, "u long, v long, linked boolean")


def _confirm_blocks(batches):
    sets: dict[int, np.ndarray] = {}
    answered = False
    for batch in batches:
        out = []
        kinds, names = batch.column("kind").to_pylist(), batch.column("cls").to_pylist()
        for k, kind in enumerate(kinds):
            if not kind:
                if answered:  # the next block begins
                    sets, answered = {}, False
                sets[names[k]] = np.frombuffer(batch.column("shingles")[k].as_py(), np.uint64)
                continue
            for u, v, sure in zip(*(batch.column(c)[k].as_py() for c in ("us", "vs", "sure")), strict=True):
                linked = _linked(sets[u], sets[v])
                if linked or sure:
                    out.append((u, v, linked))
            answered = True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["u", "v", "linked"])


def split_rows(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of buckets with several components: with root, outside (not in the largest one), all and outsiders.

    A bucket of two has been compared with its pivot and is left out.
    """
    state = rows.join(roots, rows["cls"] == roots["node"], "left").select(
        "bucket", "x", "y", "cls", F.coalesce("root", "cls").alias("root"))
    sizes = state.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts")).where(
        "parts > 1 and all > 2").select("bucket", "top", "all", (F.col("all") - F.col("top.n")).alias("outsiders"))
    return state.join(split, "bucket").select(
        "bucket", "x", "y", "cls", "root", (F.col("root") != F.col("top.root")).alias("outside"), "all", "outsiders")


def rest_pairs(rows: DataFrame, sets: DataFrame, block: int = BLOCK, least_sure: float = SURE) -> DataFrame:
    """The pairs that pivots left out: classes of one bucket that are in different components and have like sketches.

    One row for each block that has any: bucket, i, o, us, vs, sure.

    Blocks of outsiders meet blocks of all rows of their bucket, so a task holds two blocks of sketches however large the
    bucket is. ``rows`` are those of ``split_rows``.
    """
    placed_by = lambda n: F.pmod(F.xxhash64("cls"), F.ceil(F.col(n) / block))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(n) / block) - 1))
    names = ["bucket", "x", "y", "cls", "root"]
    placed = rows.select(*names, F.lit(False).alias("outer"), placed_by("all").alias("i"), every("outsiders").alias("o")).unionByName(
        rows.where("outside").select(*names, F.lit(True).alias("outer"), placed_by("outsiders").alias("o"), every("all").alias("i")))
    return placed.join(sets.select("cls", "sketch", "bands"), "cls").repartition("bucket", "i", "o").sortWithinPartitions(
        "bucket", "i", "o").mapInArrow(_compare_blocks(least_sure), _FOUND)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the least key that links lead to. Null and wordless texts have no shingle and stay alone, equal
    sets (fewer words than a shingle included) are linked, rows that repeat a key share nothing but their sets. A row
    without a key takes no part: its component is null, it is kept. Other columns are not looked at.
    """
    rows = cut_lineage(sketches(docs, text, key))
    keyed = rows.where("cls is not null and id is not null")
    classes = keyed.groupBy("cls").agg(F.min("id").alias("first"), F.first("bands").alias("bands"))
    buckets = cut_lineage(table_rows(classes))
    wanted = buckets.select("cls").distinct()
    # One text for each wanted class; copies stay behind before anything moves.
    chosen = keyed.groupBy("cls").agg(F.min("id").alias("id")).join(wanted, "cls")
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    found = texts.join(chosen.select("id").distinct(), "id").mapInArrow(
        _named_sets, "cls long, shingles binary, sketch binary, bands binary").dropDuplicates(["cls"])
    sets = cut_lineage(found.join(wanted, "cls", "left_semi"))
    del found, chosen, wanted, texts
    release(docs.sparkSession)
    links = cut_lineage(confirmed(pivot_pairs(buckets), sets))
    for least_sure in (SURE, 2.0):  # the second time no pair is sure before it is confirmed
        split = cut_lineage(split_rows(buckets, components(links)))
        release(docs.sparkSession)
        found = cut_lineage(rest_pairs(split, sets, least_sure=least_sure))
        del split
        release(docs.sparkSession)
        rest = cut_lineage(confirmed_blocks(found, sets))
        del found
        links = links.unionAll(rest.where("linked").select("u", "v"))
        if rest.where("not linked").isEmpty():
            break
    del sets, buckets
    release(docs.sparkSession)
    roots = components(links)
    named = classes.select("cls", "first").join(roots, F.col("cls") == F.col("node"), "left").select(
        "cls", "first", F.coalesce("root", "cls").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = named.join(least, "root").select(F.col("cls").alias("class"), "component_id")
    found = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return rows.join(of_class, F.col("cls") == F.col("class"), "left").select(
        F.col("id").alias("doc_id"), "n_shingles", found.alias("component_id"), F.coalesce(found == F.col("id"), F.lit(True)).alias("kept"))


def _named_sets(batches):
    for batch in batches:
        for start, stop in slices(batch, "text", 16 << 20):
            found = [shingle_set(t.as_py()) for t in batch.column("text").slice(start, stop - start)]
            found = [s for s in found if len(s)]
            yield pa.RecordBatch.from_arrays([
                pa.array([class_of(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary()),
                pa.array([(_mix(minhashes(s, _SKETCH_SEEDS)) & np.uint64(255)).astype(np.uint8).tobytes() for s in found], pa.binary()),
                pa.array([group_keys(s).astype(np.uint32).tobytes() for s in found], pa.binary())], ["cls", "shingles", "sketch", "bands"])
    _WORD_HASHES.clear()


OP9_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
  range(0, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i + 1:i + 5], ' '))) END AS s FROM words),
sizes AS MATERIALIZED (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
items AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM sets),
links AS MATERIALIZED (SELECT p.a, p.b FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS same FROM items l JOIN items r
  ON l.x = r.x AND l.doc_id <> r.doc_id GROUP BY ALL) p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
  WHERE 100 * same >= 75 * (x.n + y.n - same)),
reach(a, b) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least ON doc_id = a
"""


@query("op9_near_duplicates", OP9_SQL)
def op9_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def near_duplicate_stage(spark, docs, sf_dir):
    """One document of each group of near duplicates: the one with the least doc_id. Rows without a doc_id pass.

    Of rows that repeat both doc_id and text one stays.
    """
    name, times = free_name(docs, "kept_id"), free_name(docs, "times")
    kept = near_duplicates(docs).where("kept").groupBy(F.col("doc_id").alias(name)).agg(F.count(F.lit(1)).alias(times))
    joined = docs.join(kept.where(F.col(name).isNotNull()), F.col("doc_id").cast("long") == F.col(name))
    once, more = joined.where(F.col(times) == 1), joined.where(F.col(times) > 1)
    return once.select(*docs.columns).unionByName(
        more.select(*docs.columns).dropDuplicates(["doc_id", "text"])).unionByName(docs.where(F.col("doc_id").isNull()))
