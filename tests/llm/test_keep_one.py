"""Operator 1's filter: one row of each class, whatever is null or repeated; the texts move once."""

import re

from pyspark.sql import functions as F

from rulecheck.llm import near_dedup


def test_one_row_of_each_class(spark):
    a, b = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    rows = [(1, a), (1, a), (2, a), (1, b), (3, None), (3, None), (4, None), (None, b), (None, None), (5, ""), (6, ""), (7, a + " tail")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _row int")
    kept = sorted(((r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (3, None), (4, None), (None, None), (5, "")], key=str)
    assert near_dedup.keep_one(docs).columns == docs.columns and near_dedup.keep_one(docs.limit(0)).count() == 0


def test_texts_are_exchanged_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(F.col("doc_id") >= 0)
    plan = near_dedup.keep_one(docs)._jdf.queryExecution().sparkPlan().toString()
    prepared = near_dedup.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "HashJoin" in plan
    # the rows with texts are dealt by their key alone; the keys of the rows that stay on the other side
    assert len(re.findall(r"Exchange hashpartitioning\(_row#", prepared)) == 1
