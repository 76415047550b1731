"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

DataFrame expressions only. Every document becomes hashed word unigrams and bigrams. Two multinomials over the
buckets, one of trusted documents and one of all documents, give each bucket a log ratio; the ratio of a document is
the mean over its n-grams, so long documents are not favoured, and one fixed threshold decides.

Both multinomials count every document of theirs. The work on one text stays inside its row (sorted arrays instead of
exploded words), so the only shuffles are the bucket counts, at most ``buckets`` rows a task, and, with more trusted keys
than are broadcast, one of the texts by their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, free_name, query, table

#: n-gram buckets of both multinomials.
BUCKETS = 1 << 13
#: Pseudo counts a bucket on average; the target is smoothed towards the raw corpus.
SMOOTHING = 10.0
#: Mean log ratio from which a document is kept.
THRESHOLD = -0.04
#: So many trusted keys are looked up by broadcast (one number each), more by a shuffle of the texts.
BROADCAST_ROWS = 500_000
#: Symbols that are counted, as given by the rule.
SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\x0b\f\r"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _ngrams(words: Column, buckets: int) -> Column:
    """Bucket of every word, then of every pair of neighbours."""
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)))
    n = F.size(words)
    pair = F.transform(F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>")),
                       lambda i: F.pmod(F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(buckets)))
    return F.concat(single, pair)


def bucket_counts(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id",
                  buckets: int = BUCKETS) -> DataFrame:
    """bucket, raw, target: n-grams of all documents, and of all those whose key is in ``trusted``.

    Null keys are never trusted. A key that stands in several rows marks all of them.
    """
    ids = trusted.select(F.col(key).alias("trusted_id")).dropna().distinct()
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("content"))
    if few:
        marked = rows.join(F.broadcast(ids), F.col("id") == F.col("trusted_id"), "left")
    else:
        # Rows without a key are spread by a key of their own.
        spread = F.when(F.col("id").isNull(), F.xxhash64("content")).otherwise(F.lit(0).cast("bigint"))
        marked = rows.withColumn("spread", spread).join(
            ids.withColumn("trusted_spread", F.lit(0).cast("bigint")),
            (F.col("id") == F.col("trusted_id")) & (F.col("spread") == F.col("trusted_spread")), "left")
    return marked.withColumn("words", _words(F.col("content"))).select(
        F.col("trusted_id").isNotNull().cast("long").alias("hit"),
        F.explode(_ngrams(F.col("words"), buckets)).alias("bucket")
    ).groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("hit").alias("target"))


def weight_vector(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row, column ``vector``: log p(bucket | target) - log p(bucket | raw) for bucket 0, 1, ...

    The target is smoothed with the raw distribution, so a bucket that it never saw is judged by how surely it should
    have been seen. Without trusted documents all weights are 0; so is the weight of a bucket without n-grams.
    """
    every = counts.sparkSession.range(buckets).select(
        F.col("id").alias("bucket"), F.lit(0).cast("bigint").alias("raw"), F.lit(0).cast("bigint").alias("target"))
    row = counts.unionByName(every).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"),
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("cells"))
    mass = smoothing * buckets
    share = lambda x: x["raw"] / F.col("raw")
    return row.select(F.transform("cells", lambda x: F.when(x["raw"] > 0, F.log(
        (x["target"] + mass * share(x)) / (F.col("target") + mass) / share(x))).otherwise(0.0)).alias("vector"))


def quality_facts(docs: DataFrame, weights: DataFrame, text: str = "text", buckets: int = BUCKETS,
                  threshold: float = THRESHOLD) -> tuple[DataFrame, str]:
    """``docs`` with one struct column of facts, and the name of that column.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept. A null text has no
    word, so it fails the base rule. A document without n-grams scores 0.
    """
    held = free_name(docs, "quality_facts")
    words, grams, spans, firsts, table_of = (
        free_name(docs, c) for c in ("q_words", "q_grams", "q_spans", "q_firsts", "q_weights"))
    content = F.coalesce(F.col(text), F.lit(""))
    n = F.size(words)
    window = lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p"))
    out = docs.withColumn(words, _words(F.col(text)))
    out = out.withColumn(spans, F.sort_array(F.transform(
        F.when(n > 2, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")), window)))
    # Positions of windows that have an equal one beside them in hash order, ascending.
    out = out.withColumn(firsts, _repeated(spans))
    out = out.withColumn(grams, _ngrams(F.col(words), buckets)).withColumn(
        table_of, weights.scalar())  # made once and handed to every task
    lines = F.filter(F.split(content, "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    m = F.size(firsts)
    # A window covers three words; the part that the next one covers too is counted there.
    covered = F.aggregate(
        F.when(m > 0, F.sequence(F.lit(0), m - 1)).otherwise(F.array().cast("array<int>")), F.lit(0).cast("bigint"),
        lambda a, k: a + F.coalesce(F.least(F.lit(3), F.get(firsts, k + 1) - F.get(firsts, k)), F.lit(3)).cast("bigint"))
    total = F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(table_of, b.cast("int")))
    facts = out.withColumn(held, F.struct(
        n.cast("bigint").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        (F.char_length(content) - F.char_length(F.translate(content, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.size(F.array_distinct(lines)).cast("bigint").alias("n_distinct"),
        covered.alias("n_repeat_words"),
        F.when(F.size(grams) > 0, total / F.size(grams)).otherwise(0.0).alias("score")))
    f = F.col(held)
    failed = (f["n_words"] < 50) | (f["n_repeat_words"] * 100 > f["n_words"] * 50)
    facts = facts.withColumn(held, F.struct(
        f["n_words"].alias("n_words"), f["word_chars"].alias("word_chars"), f["n_symbols"].alias("n_symbols"),
        (f["n_lines"] - f["n_distinct"]).alias("n_dup_lines"), f["n_repeat_words"].alias("n_repeat_words"),
        f["score"].alias("score"), failed.alias("base_failed"), (~failed & (f["score"] >= threshold)).alias("kept")))
    return facts.drop(words, spans, firsts, grams, table_of), held


def _repeated(spans: str) -> Column:
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    marked = F.transform(spans, lambda x, i: F.when(
        same(x, F.get(spans, i - 1)) | same(x, F.get(spans, i + 1)), x["p"]))
    return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))


def trusted_keys(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    return labels.where(F.col("quality") == 1).select(key)


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **rule) -> tuple[DataFrame, str]:
    """Fit the weights on ``docs`` and judge every row of ``docs``; see ``quality_facts``."""
    weights = weight_vector(bucket_counts(docs, trusted_keys(labels, key), text, key))
    return quality_facts(docs, weights, text, **rule)


@query("op3_quality_rules")
def op3_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    facts, held = quality_rules(docs, table(spark, sf_dir, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return facts.select("doc_id", *[F.col(held)[c].alias(c) for c in names])


def quality_stage(spark, docs, sf_dir):
    """Documents that pass the rules."""
    facts, held = quality_rules(docs, table(spark, sf_dir, "labels"))
    # A plain filter would be pushed below the projections that it is made by, and evaluate them within each other. It
    # stays where it is if it also needs a column that must not be computed twice.
    mark = free_name(facts, "row_mark")
    marked = facts.withColumn(mark, F.monotonically_increasing_id())
    return marked.where(F.col(held)["kept"] & (F.col(mark) >= 0)).select(*docs.columns)
