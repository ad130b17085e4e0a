"""Connected components of operator 1: right for any graph, few rounds, and no link goes through them twice."""

import random

import pytest

from rulecheck.llm import near_dedup


def least(edges):
    label = {x: x for e in edges for x in e}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        label[y] = x
    return {x: top(x) for x in label}


def as_edges(spark, edges):
    return spark.createDataFrame([(f"{a:04}".encode(), f"{b:04}".encode()) for a, b in edges], "a binary, b binary")


def told(labels):
    rows = [(int(r["node"]), int(r["label"])) for r in labels.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


rng = random.Random(3)
GRAPHS = {
    "chain": [(i, i + 1) for i in range(60)],
    "star": [(99, i) for i in range(40)],
    "hubs": [(h, i) for h in rng.sample(range(100), 5) for i in range(100) if i != h],
    "random": [tuple(rng.sample(range(120), 2)) for _ in range(100)] * 2,
    "none": [],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, monkeypatch, name):
    rounds, write = [], near_dedup.materialize
    monkeypatch.setattr(near_dedup, "materialize", lambda d, label: rounds.append(label) or write(d, label))
    assert told(near_dedup.components(as_edges(spark, GRAPHS[name]))) == least(GRAPHS[name])
    assert rounds.count("edges") <= 6


def test_grown(spark):
    first, more = GRAPHS["random"][:50], [*GRAPHS["random"][50:90], (200, 201), (201, 3)]
    labels = near_dedup.grown(near_dedup.components(as_edges(spark, first)), as_edges(spark, more))
    assert told(labels) == least(first + more)


def test_no_link_goes_through_twice(spark, monkeypatch):
    """A group of near copies and texts that share a passage with it: the classes are grown, not found anew."""
    base, passage = [f"b{i}" for i in range(60)], [f"p{i}" for i in range(60)]
    texts = [base[:i] + [f"x{i}"] + base[i + 1:] for i in range(40)]
    texts += [passage + [f"t{k // 2}u{i}" for i in range(60 - k % 2)] for k in range(30)]
    sent, own = [], near_dedup.components
    pairs = lambda edges: {frozenset((r["a"], r["b"])) for r in edges.collect() if r["a"] != r["b"]}
    monkeypatch.setattr(near_dedup, "components", lambda edges: sent.append(len(pairs(edges))) or own(edges))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = near_dedup.duplicate_classes(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == {i: 0 if i < 40 else i - i % 2 for i in range(70)}
    assert 0 < sum(sent) <= sum(r["n_links"] for r in rows) / 2
