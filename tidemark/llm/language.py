"""Language of texts: a linear-chain conditional random field labels every word, and the words decide for the text.

Features of a word are affixes, letter n-grams and lexicon entries; learned transitions favour runs of one language, so
a text that switches between languages gets a label for each word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, fold, query, sample_order, slices, table
from tidemark.llm.crf import WORD, Chain, associated, fit_chain, letters, tagger_of

#: Bound on the labelled rows that the field is fitted on, shared by the labels; each may have LEAST_ROWS whatever their number.
SAMPLE_ROWS, LEAST_ROWS = 1_200, 30
#: Fold of the key that is never learned from.
FOLDS, HELD_OUT = 4, 2


def words_of(text: str | None) -> list[str]:
    return WORD.findall(letters(text))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, text: str, key: str, rows: int, of_each: bool = False) -> list:
    """(id, text, sample_label) of at most ``rows`` keys; only keys and labels are sorted, texts are fetched for the chosen.

    With ``of_each``, of every label the same share of ``rows`` at most, but LEAST_ROWS of each that has them.
    """
    known = labels.select(F.col(key).alias("sample_id"), F.col(label).alias("sample_label")).dropna().dropDuplicates(
        ["sample_id", "sample_label"] if of_each else ["sample_id"])
    if of_each:
        sizes = {r["sample_label"]: r["count"] for r in known.groupBy("sample_label").count().collect()}
        most = max(LEAST_ROWS, rows // max(1, len(sizes)))
        order = sample_order("sample_id")
        # Of a large label only its first rows by hash meet in one task: eight times as many as are wanted.
        bounds = [F.lit(x) for label, n in sizes.items() if n > 8 * most for x in (label, 2**35 * most // n)]
        if bounds:
            known = known.where(order <= F.coalesce(F.create_map(bounds)[F.col("sample_label")], F.lit(2**32)))
        place = F.row_number().over(Window.partitionBy("sample_label").orderBy(order, "sample_id"))
        # Spark keeps ``most`` rows of a label per task before the shuffle.
        ids = known.withColumn("place", place).where(F.col("place") <= most).drop("place").dropDuplicates(["sample_id"])
    else:
        ids = bounded_sample(known, "sample_id", rows)
    chosen = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).dropna().join(
        F.broadcast(ids), F.col("id") == F.col("sample_id"))  # at most ``rows`` keys
    return chosen.select("id", "text", "sample_label").collect()


def learn_languages(docs: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id", rows: int = SAMPLE_ROWS) -> Chain | None:
    """None if no labelled text has a letter. Every word of a text is taught the text's label; every label has its rows."""
    rows = sorted(labelled_sample(docs, docs, label, text, key, rows, of_each=True), key=lambda r: (str(r["id"]), r["text"]))
    rows = [(words_of(r["text"]), str(r["sample_label"])) for r in rows]
    rows = [r for r in rows if r[0]]
    if not rows:
        return None
    labels = sorted({r[1] for r in rows})
    classes = [labels.index(r[1]) for r in rows]
    texts = [r[0] for r in rows]
    lexicon = associated(texts, classes, len(labels))
    return fit_chain(texts, [np.full(len(t), c) for t, c in zip(texts, classes, strict=True)], labels, lexicon)


def _label(chain: Chain | None):
    def run(batches):
        tagger = tagger_of(chain) if chain else None
        for batch in batches:
            for start, stop in slices(batch, "text"):
                part = batch.slice(start, stop - start)
                texts = [words_of(t.as_py()) for t in part.column("text")]
                names, scores, runs = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
                listed = [""] * len(texts)
                if tagger:
                    marginal, sizes = tagger.marginals(texts)
                    full = np.flatnonzero(sizes)
                    if len(full):
                        at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                        mean = np.add.reduceat(marginal, at, axis=0) / sizes[full][:, None]
                        best = marginal.argmax(axis=1)
                        turn = np.concatenate([[False], best[1:] != best[:-1]])
                        turn[at] = False
                        runs[full] = np.add.reduceat(turn.astype(np.int64), at) + 1
                        scores[full] = mean.max(axis=1).clip(0, 1)
                        starts = np.flatnonzero(turn | np.isin(np.arange(len(turn)), at))
                        ends = np.append(starts[1:], len(turn))
                        run = np.concatenate([[0], np.cumsum(runs[full])])
                        for i, (k, c) in enumerate(zip(full, mean.argmax(axis=1), strict=True)):
                            names[k] = chain.labels[c]
                            listed[k] = ",".join(f"{chain.labels[best[a]]}:{a - at[i]}:{b - at[i]}" for a, b in zip(
                                starts[run[i]:run[i + 1]].tolist(), ends[run[i]:run[i + 1]].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), pa.array(names), pa.array(scores), pa.array(runs), pa.array(listed)],
                                                 ["doc_id", "held_out", "lang_pred", "score", "n_runs", "runs"])

    return run


def label_languages(docs: DataFrame, chain: Chain | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score (mean marginal of that language), n_runs and runs (stretches of one language).

    ``runs`` lists them as language:first:end, comma-joined, in words of the text, the end exclusive; empty without a word.
    One row per row of ``docs``, repeated keys included. ``und`` with score 0 for a null text, one without a letter, or
    without a model. ``held_out`` is false for a null key. Other columns are not looked at.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(fold(F.col(key), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(_label(chain), f"doc_id {kind}, held_out boolean, lang_pred string, score double, n_runs long, runs string")


@query("op2_language")
def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    chain = learn_languages(docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    return label_languages(docs, chain)
