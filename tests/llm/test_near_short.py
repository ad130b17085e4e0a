"""Operator 1 on short texts: every link between texts of at most near_dedup.SHORT words shares a bucket."""

import random

from rulecheck.llm import near_dedup


def keys(words):
    got = near_dedup.word_hashes([w.encode() for w in words], {})
    return {*near_dedup.vectors(got).tolist(), *near_dedup.short_keys(got).tolist()}


def test_short_links_share_a_bucket():
    rng = random.Random(2)
    for n in range(4, 10):
        for _ in range(20):
            words = [rng.choice("abcdefgh") for _ in range(n)]
            for i in range(n):
                others = [words[:i] + ["x"] + words[i + 1:], words[:i] + words[i + 1:], words[:i] + ["x"] + words[i:]]
                for other in others:
                    if max(n, len(other)) <= near_dedup.SHORT and near_dedup.threshold(max(n, len(other))):
                        assert keys(words) & keys(other)
    assert not near_dedup.short_keys(near_dedup.word_hashes([b"a"] * 10, {})).size


def test_short_links_are_found(spark):
    texts = ["a b c d e f g", "a b c d e f x", "p q r s t u", "p q r s t u v", "k l m n", "k l m n o", "a b c", "a b"]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.duplicate_classes(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, 6: 6, 7: 7}
