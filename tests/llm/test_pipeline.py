"""The pipeline: each stage's decisions against the operators and brute force, and on edge rows."""

import re

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from rulecheck.llm import langid, near_dedup, quality

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before, docs)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    before, after = seen["language"]
    assert ids(after) == ids(langid.predict(before, langid.fit(before)).filter("NOT lang_rejected"))
    before, after = seen["quality"]
    assert ids(after) == ids(quality.judge(before, labels).filter("kept"))
    before, after = seen["near_duplicates"]
    classes = near_dedup.duplicate_classes(before).collect()
    assert ids(after) == {r["class_id"] for r in classes} and after.count() == after.select("text").distinct().count()
    before, after = seen["secrets"]
    assert ids(after) == ids(before)
    assert not [r for r in after.collect() if re.search(r"[0-9a-f]{32,}|AKIA[A-Z0-9]{12,}", r["text"])]
    assert after.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    before, after = seen["packing"]
    assert ids(after) == ids(before) and after.filter("padded_length < n_tokens").count() == 0


def test_edges(spark, edge, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing names; then an empty table."""
    for docs, n in ((edge, "rows"), (edge.limit(0), "none")):
        for k, (name, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert k == 4 or out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{n}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}-{name}"))
        assert {r["doc_id"] for r in docs.collect()} == ({1} if n == "rows" else set())
