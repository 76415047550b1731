"""Exact duplicates by two-pass Bloom filtering, in DataFrame expressions only.

Texts are read once: what goes on is a narrow table of (key, digest), written to the shared folder. The first pass turns
every digest into a word of a blocked Bloom filter and a mask of a few bits in it, and keeps of each word the bits that
at least two rows set. The second pass probes all rows: a row with a bit that no other row has set is the only one of its
digest and passes straight through. The rest, repeated digests and a few false hits, is grouped exactly.

A filter word is computed from the counts of equal masks, which are combined before they move, so a text that a third of
all rows share is one row a task. Digests held by many rows are few by definition; they are looked up by broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, query, table
from tidemark.session import cut_lineage

#: Filter bits for each row, and bits that a row sets within its word of 64.
BITS_A_ROW, BITS_SET = 16, 3
#: Bound on the words of the filter (32 MB of bits): it is broadcast. With more rows than it is made for, more of them
#: are grouped without need, all in the end, as rows of a key and a digest; results stay exact.
MOST_WORDS = 1 << 22
#: A digest held by more than this share of the rows is looked up by broadcast, so there are at most so many of these.
HOT_SHARE = 1e-3
#: Runs of white space that are not one space already.
_ODD_SPACE = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _ODD_SPACE, " ")


def filter_words(rows: int, bits_a_row: int = BITS_A_ROW, most: int = MOST_WORDS) -> int:
    """Words of the filter for a table of so many rows: a power of two."""
    return min(most, 1 << max(0, (rows * bits_a_row // 64).bit_length()))


def placed(digests: DataFrame, words: int) -> DataFrame:
    """``digests`` with ``word`` and ``mask``: where a row stands in the filter."""
    place = F.xxhash64("digest")
    bits = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(place, {6 * k}) & 63 as int))") for k in range(BITS_SET)]
    spread = F.expr(f"cast(shiftrightunsigned(place, {6 * BITS_SET}) & {words - 1}L as int)")
    return digests.withColumn("place", place).withColumn("word", spread).withColumn(
        "mask", reduce(lambda a, b: a.bitwiseOR(b), bits)).drop("place")


def repeated_bits(places: DataFrame) -> DataFrame:
    """word, twice: for each filter word the bits that two rows or more have set, if there are any.

    A word holds few different masks, at most as many as three of 64 bits can make.
    """
    masks = places.groupBy("word", "mask").agg(F.count(F.lit(1)).alias("n"))
    empty = F.struct(F.lit(0).cast("bigint").alias("once"), F.lit(0).cast("bigint").alias("twice"))
    add = lambda a, m: F.struct(
        a["once"].bitwiseOR(m["mask"]).alias("once"),
        a["twice"].bitwiseOR(F.when(m["n"] > 1, m["mask"]).otherwise(a["once"].bitwiseAND(m["mask"]))).alias("twice"))
    return masks.groupBy("word").agg(F.collect_list(F.struct("mask", "n")).alias("masks")).select(
        F.col("word").alias("filter_word"), F.aggregate("masks", empty, add, lambda a: a["twice"]).alias("twice")).where("twice <> 0")


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", most_words: int = MOST_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after every run of space and of the controls from tab to carriage return is one space; a
    null text is an empty one. Of a group the row with the least key stays; a row without a key only if no other has one.
    Of rows that repeat the key as well one stays. ``keep_id`` is the key of the row that stays. Other columns are not
    looked at, so clashing names do no harm; an empty table gives an empty one.
    """
    digests = cut_lineage(docs.select(
        F.col(key).alias("id"), F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row")))
    rows = digests.count()
    places = placed(digests, filter_words(rows, most=most_words))
    bits = repeated_bits(places)
    # At most most_words rows of two numbers.
    probed = places.join(F.broadcast(bits), F.col("word") == F.col("filter_word"), "left").withColumn(
        "maybe", F.coalesce(F.col("twice").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))).select(
        "id", "digest", "row", "maybe")
    alone = probed.where("not maybe").select(
        "id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"))
    maybe = probed.where("maybe")
    groups = cut_lineage(maybe.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("row"))).alias("first")).select(
        F.col("digest").alias("group"), "group_size", F.col("first.id").alias("keep_id"), F.col("first.row").alias("first_row")))
    least = max(1000.0, rows * HOT_SHARE)
    hot, others = groups.where(F.col("group_size") > least), groups.where(F.col("group_size") <= least)
    names = ["group", "group_size", "keep_id", "first_row"]
    found = maybe.join(F.broadcast(hot.toDF(*[f"hot_{c}" for c in names])), F.col("digest") == F.col("hot_group"), "left")
    columns = ["id", "digest", "row"]
    of_hot = found.where("hot_group is not null").select(*columns, *[F.col(f"hot_{c}").alias(c) for c in names])
    of_others = found.where("hot_group is null").select(*columns).join(others, F.col("digest") == F.col("group"))
    grouped = of_hot.unionByName(of_others).select(
        "id", "digest", "keep_id", "group_size", (F.col("row") == F.col("first_row")).alias("kept"))
    return alone.unionByName(grouped).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP11_SQL = rf"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""


@query("op11_exact_duplicates", OP11_SQL)
def op11_exact_duplicates(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))
