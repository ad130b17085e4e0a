"""Operator 9 in the pipeline: the junk of sf0.1 goes, and the certified rules keep their word."""

import math

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from rulecheck.llm import quality

SF = "/root/testdata/sf0.1"


def test_junk_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    quality_of = {r["doc_id"]: r["q"] for r in labels.groupBy("doc_id").agg(F.min("quality").alias("q")).collect()}
    counted = quality.signals(docs).filter(~quality.base_failed()).select("doc_id", quality.signal("symbols").alias("s")).collect()
    kept = {r["doc_id"] for r in pipeline.rules(spark, docs, SF).select("doc_id").collect()}
    junk = {r["doc_id"] for r in counted if r["s"] > 100}
    assert sum(quality_of.get(i) == 0 for i in junk) == 270 and not junk & kept
    good = [r["doc_id"] for r in counted if quality_of.get(r["doc_id"]) == 1]
    assert sum(i not in kept for i in good) <= 0.01 * len(good)


def test_pools_and_tail():
    assert quality.pools([739, 1408, 897, 199], 0.01, 0.05) == [[0], [1], [2, 3]]
    assert quality.pools([74, 141, 90, 20], 0.01, 0.05) == [[0, 1, 2, 3]] == quality.pools([0, 0, 0, 0], 0.01, 0.05)
    assert math.isclose(quality.tail(500, 2, 0.01), sum(math.comb(500, i) * 0.01**i * 0.99**(500 - i) for i in range(3)))


def test_joint_rule_stops_at_the_first_failure(spark):
    """500 good texts: none has symbols over 10 %, 20 have repeated lines as the bad ones do: only symbols get a cutoff."""
    text = lambda k, junk, lines: " ".join(f"a{k}b{j}" for j in range(60)) + "#" * junk + "\nx y\nx y\nx y" * lines
    rows = [(i, text(i, 0, i < 20), 1) for i in range(500)] + [(500 + i, text(i, 200, i < 8), 0) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    found = quality.joint_cuts(quality.signals(df.drop("quality")), df.select("doc_id", "quality"))
    assert [(own, n, k) for own, n, k, _ in found] == [([0, 1, 2, 3], 500, 0)] and set(found[0][3]) == {"symbols"} and found[0][3]["symbols"] >= 100


def test_the_query_rejects_by_its_certified_rule(spark):
    """On sf0.01 the certified cutoff decides rows: all labelled bad documents go, at most a hundredth of the good ones beyond the base rules."""
    sf = "/root/testdata/sf0.01"
    told = spark.read.parquet(f"{sf}/labels.parquet").filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"))
    rows = quality.op9_risk_controlled_rules(spark, sf).join(told, "doc_id", "left").collect()
    by_method = [r for r in rows if not r["base_failed"] and not r["kept"]]
    assert len(by_method) > 0 and not any(r["kept"] for r in rows if r["q"] == 0 or r["base_failed"])
    good = [r for r in rows if r["q"] == 1 and not r["base_failed"]]
    assert sum(not r["kept"] for r in good) <= 0.01 * len(good)
