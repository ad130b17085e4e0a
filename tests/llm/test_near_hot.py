"""Operator 1 with a bucket that many texts share: no window over buckets, and dealing hot keys changes nothing."""

from rulecheck.llm import near_dedup


def test_hot_buckets(spark, monkeypatch):
    texts = [" ".join([*(f"p{i}" for i in range(40)), *(f"t{k // 2}u{i}" for i in range(60 - k % 2))]) for k in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plans, write = [], near_dedup.materialize
    monkeypatch.setattr(near_dedup, "materialize", lambda d, label: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or write(d, label))
    for hot in (20_000, 4):
        monkeypatch.setattr(near_dedup, "HOT_KEY", hot, raising=False)
        monkeypatch.setattr(near_dedup, "BLOCK", 16, raising=False)
        got = {r["doc_id"]: r["class_id"] for r in near_dedup.duplicate_classes(df).collect()}
        assert got == {k: k - k % 2 for k in range(60)}
    assert not [p for p in plans if "Window" in p]
