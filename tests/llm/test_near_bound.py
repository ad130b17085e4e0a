"""The lower bound by binned word counts: it rules out unlike texts of many words, and never a link."""

import zlib

import numpy as np

from rulecheck.llm import near_dedup


def packed(words):
    return zlib.compress(np.asarray(words, np.uint32).tobytes(), 1)


def test_unlike_texts_of_many_words_are_ruled_out():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, b = (rng.integers(0, 2**32, 780, np.uint32) for _ in range(2))
        b[:500] = a[:500]  # a passage that both share
        assert near_dedup.possible(near_dedup.bins(packed(a)), 780, near_dedup.bins(packed(b))[None, :], np.array([780]))[0] == -1


def test_counts_that_are_cut_rule_out_no_link():
    rng = np.random.default_rng(6)
    for often in (200, 255, 256, 700, 70_000):
        a = rng.permutation(np.concatenate([np.full(often, 7), rng.integers(0, 50, 90)]))
        b = np.delete(a, rng.integers(0, len(a), 9))
        d = len(a) - len(b)
        got = near_dedup.possible(near_dedup.bins(packed(a)), len(a), near_dedup.bins(packed(b))[None, :], np.array([len(b)]))[0]
        assert 0 <= got <= d


def test_a_pair_of_several_buckets_is_told_once(spark, monkeypatch):
    """open_pairs before its last step: as many rows as pairs, though the texts share every bucket."""
    import pyspark.sql.classic.dataframe as classic

    rng, n = np.random.default_rng(7), 12
    own = rng.integers(0, 2**32, 90, np.uint32)
    nodes = [bytes([k]) * 16 for k in range(n)]
    words = spark.createDataFrame([(x, packed(np.append(own, k)), 91) for k, x in enumerate(nodes)], "node binary, words binary, n_words int")
    members = spark.createDataFrame([(key, x, n) for key in (-5, 3, 9) for x in nodes], "key long, node binary, size long")
    labels = spark.createDataFrame([], "node binary, label binary")
    for block in (1024, 5):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        assert near_dedup.open_pairs(members, labels, words).count() == n * (n - 1) // 2
        with monkeypatch.context() as m:
            m.setattr(classic.DataFrame, "dropDuplicates", lambda self, subset=None: self)
            assert near_dedup.open_pairs(members, labels, words).count() == n * (n - 1) // 2
