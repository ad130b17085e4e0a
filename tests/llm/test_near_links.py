"""Operator 1 on texts that share a passage, and a large group of near copies: no link between texts that share a bucket is lost."""

import collections
import random

import numpy as np
import pytest

from rulecheck.llm import near_dedup


def words_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def planted():
    rng = random.Random(11)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, texts = new(80), []
    for k in range(260):
        tail = new(60)
        texts.append(passage + tail)
        if k < 30:  # every fifth word of the tail changed: near copies that share k-mers of the passage only
            texts.append(passage + [w if i % 5 else f"x{k}y{i}" for i, w in enumerate(tail)])
    base = new(60)
    for _ in range(120):
        at = set(rng.sample(range(60), 8))
        texts.append([f"z{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(base)])
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [1024, 24])
def test_no_link_is_lost(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block, raising=False)
    texts, known = planted(), {}
    buckets = collections.defaultdict(list)
    for i, t in enumerate(texts):
        for key in near_dedup.vectors(near_dedup.word_hashes([w.encode() for w in t], known)).tolist():
            buckets[key].append(i)
    met = sorted({(i, j) for own in buckets.values() for n, i in enumerate(own) for j in own[n + 1:] if i != j})
    counts = [collections.Counter(t) for t in texts]
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    passage_only = 0
    for i, j in met:
        longest = max(len(texts[i]), len(texts[j]))
        if longest - (counts[i] & counts[j]).total() <= longest // 5 and words_distance(texts[i], texts[j]) <= longest // 5:
            passage_only += longest == 140
            a, b = sorted((top(i), top(j)))
            label[b] = a
    assert passage_only >= 10
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.duplicate_classes(df).collect()} == {i: top(i) for i in range(len(texts))}


def test_length_classes():
    least = near_dedup.length_classes(5000)
    for n in range(1, 5000, 7):
        for m in range(n, min(5000, 2 * n)):
            if m - n <= near_dedup.threshold(m):
                assert np.searchsorted(least, m, "right") - np.searchsorted(least, n, "right") <= 1


def test_possible_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a = rng.integers(0, 9, rng.integers(1, 40)).astype(np.uint32)
        b = np.delete(a, rng.integers(0, len(a)))
        b = np.append(b, rng.integers(0, 9, 2)).astype(np.uint32)
        d = words_distance(a.tolist(), b.tolist())
        count = lambda x: np.bincount(x % near_dedup.BINS, minlength=near_dedup.BINS).astype(np.uint16)
        got = near_dedup.possible(count(a), len(a), count(b)[None, :], np.array([len(b)]))[0]
        assert got <= d if got >= 0 else d > near_dedup.threshold(max(len(a), len(b)))
