"""The registered text queries over whole tables: against SQL where there is any, and held-out accuracy."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_queries import compare, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = QUERIES["op2_language"](spark, "/root/testdata/sf0.01").where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.98 * len(out)
    out = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.01").where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in out) >= 0.9 * len(out)


def test_pipeline_keeps_columns_and_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() > 50
