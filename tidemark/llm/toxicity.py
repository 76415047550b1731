"""Toxic spans: a linear-chain conditional random field tags words, marginals add up to a score of the text.

Word tags for learning come from the labels of texts: in a toxic text, words that almost only toxic texts hold are the
toxic ones. The score is a logistic function, fitted on a part of the sample that the field did not see, of the number
of toxic words to be expected and of the surest one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, fold_of, query, slices, table
from tidemark.llm.crf import WORD, Tagger, fit_chain, letters, tagger_of
from tidemark.llm.language import labelled_sample, words_of

#: Bound on the labelled rows of either label that the field is fitted on.
SAMPLE_ROWS = 1_500
FOLDS, HELD_OUT = 5, 0
#: A toxic unit stands in so many toxic texts, adds this share of them, and of all its texts so many are toxic ones.
LEAST_TEXTS, LEAST_ADDED, LEAST_SHARE = 3, 0.015, 0.9


def _facts(marginal: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For every text: log of the expected toxic words and one, the greatest marginal, and the log of their share."""
    expected, surest = np.zeros(len(sizes)), np.zeros(len(sizes))
    full = np.flatnonzero(sizes)
    if len(full):
        at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        expected[full] = np.add.reduceat(np.where(marginal[:, 1] > 0.05, marginal[:, 1], 0), at)
        surest[full] = np.maximum.reduceat(marginal[:, 1], at)
    return np.column_stack([np.log1p(expected), surest, np.log((expected + 0.1) / (sizes + 20))])


def fit_toxicity(sample: list[tuple]) -> tuple | None:
    """(chain, logistic weights) from (key, text, 0 or 1) rows; None without texts of both labels."""
    texts, y = [words_of(t) for _, t, _ in sample], [int(v) for _, _, v in sample]
    if len(set(y)) < 2:
        return None
    units = toxic_units(texts, y)
    hit = {w: any(u in units for u in units_of(w)) for t in texts for w in set(t)}
    lexicon = {w: 1 for w, h in hit.items() if h}
    tags = [np.array([y[k] and hit[w] for w in texts[k]], np.int64) for k in range(len(texts))]
    part = np.array([fold_of(key, 3) for key, _, _ in sample])
    alone = len(texts) < 60  # too few to leave some out
    fit = [k for k in range(len(texts)) if part[k] or alone]
    chain = fit_chain([texts[k] for k in fit], [tags[k] for k in fit], ["clean", "toxic"], lexicon, weight=np.array([1.0, 20.0]))
    rest = [k for k in range(len(texts)) if not part[k] or alone]
    x = np.column_stack([_facts(*Tagger(chain).marginals([texts[k] for k in rest])), np.ones(len(rest))])
    return chain, _logistic(x, np.array([y[k] for k in rest], float))


def learn_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", rows: int = SAMPLE_ROWS):
    """``fit_toxicity`` on a bounded sample of either label. ``labels``: key, toxic."""
    known = labels.select(F.col(key).alias("label_id"), "toxic").dropna().dropDuplicates(["label_id"])
    sample = [(r["id"], r["text"], r["sample_label"]) for v in (0, 1) for r in labelled_sample(
        docs.select(key, text), known.where(F.col("toxic") == v).select(F.col("label_id").alias(key), "toxic"), "toxic", text, key, rows)]
    return fit_toxicity(sorted(sample, key=lambda r: (str(r[0]), r[1])))


def units_of(word: str) -> list[str]:
    """The word, and its beginnings of four to eight letters."""
    return [word + ">"] + [word[:k] for k in range(4, min(len(word), 9))]


def toxic_units(texts: list, y: list[int]) -> set[str]:
    """Words and beginnings of words that stand almost only in toxic texts, chosen one by one.

    Each has to add texts that the ones before it left unexplained: a word of a rare subject stands in a few toxic texts
    by chance as well. A shorter beginning goes before a longer one that explains as much.
    """
    clean: dict[str, int] = {}
    holds: dict[str, set] = {}
    for k, (text, c) in enumerate(zip(texts, y, strict=True)):
        for u in {u for w in set(text) for u in units_of(w)}:
            if c:
                holds.setdefault(u, set()).add(k)
            else:
                clean[u] = clean.get(u, 0) + 1
    toxic = sum(y)
    per_clean = toxic / max(1, len(y) - toxic)
    least = max(LEAST_TEXTS, LEAST_ADDED * toxic)
    # Expected clean texts at equal class sizes, smoothed by one text.
    holds = {u: h for u, h in holds.items() if len(h) >= least and len(h) >= LEAST_SHARE * (len(h) + (clean.get(u, 0) + 0.5) * per_clean)}
    chosen, covered = set(), set()
    while holds:
        u = min(holds, key=lambda u: (-len(holds[u] - covered), clean.get(u, 0), len(u), u))
        if len(holds[u] - covered) < least:
            break
        chosen.add(u)
        covered |= holds.pop(u)
    # What stands beside the chosen ones at the same purity and as often is of the same kind.
    most = max((len(v) for v in holds.values()), default=0)
    return chosen | {u for u, h in holds.items() if len(h) >= 0.25 * most and not any(u.startswith(c) for c in chosen)}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _score(model):
    def run(batches):
        chain, w = model or (None, np.array([0.0, 0.0, 0.0, -30.0]))
        tagger = tagger_of(chain) if chain else None
        for batch in batches:
            for start, stop in slices(batch, "text"):
                part = batch.slice(start, stop - start)
                whole = [t.as_py() or "" for t in part.column("text")]
                texts = [words_of(t) for t in whole]
                spans = [""] * len(texts)
                facts = np.zeros((len(texts), 3))
                if tagger:
                    marginal, sizes = tagger.marginals(texts)
                    facts = _facts(marginal, sizes)
                    at = np.concatenate([[0], np.cumsum(sizes)])
                    for k in np.flatnonzero(facts[:, 1] >= 0.5):
                        spans[k] = _spans(whole[k], marginal[at[k]:at[k + 1], 1] >= 0.5)
                score = 1 / (1 + np.exp(-np.clip(np.column_stack([facts, np.ones(len(texts))]) @ w, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(spans)],
                    ["doc_id", "held_out", "score", "predicted", "spans"])

    return run


def _spans(text: str, hit: np.ndarray) -> str:
    """start:end of the tagged words, neighbours joined; where lower case is longer, offsets are of that form."""
    out: list[list[int]] = []
    for k, m in enumerate(WORD.finditer(letters(text))):
        if hit[k]:
            if out and k and hit[k - 1]:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
    return ",".join(f"{a}:{b}" for a, b in out)


def score_toxicity(docs: DataFrame, model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted, spans (start:end in code points, comma-joined): one row per row of ``docs``.

    A text without words has the score of no toxic word; without a model that holds for every text. ``held_out`` is
    false for a null key. Other columns are not looked at.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(fold(F.col(key), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(_score(model), f"doc_id {kind}, held_out boolean, score double, predicted int, spans string")


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    learn = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    return score_toxicity(docs, learn_toxicity(docs.where(learn), table(spark, sf_dir, "labels").where(learn)))
