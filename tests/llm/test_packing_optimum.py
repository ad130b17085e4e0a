"""Operator 8: the padding of rows of thousands of bytes is the least there is, not the least among coarse cells."""

import random

import numpy as np

from rulecheck.llm import packing


def least_padding(lengths, buckets):
    xs = np.array(sorted(lengths), np.int64)
    sums = np.concatenate([[0], xs.cumsum()])
    best = np.array([x * (j + 1) - sums[j + 1] for j, x in enumerate(xs)])
    for _ in range(1, buckets):
        best = np.array([min([best[j], *(best[:j] + xs[j] * (j - np.arange(j)) - (sums[j + 1] - sums[1:j + 1]))]) for j in range(len(xs))])
    return int(best[-1])


def test_padding_is_the_optimum(spark, tmp_path):
    rng = random.Random(3)
    lengths = [int(rng.lognormvariate(8, 1)) + 100 for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_tokens long")
    df.write.parquet(str(tmp_path / "lengths"))
    df = spark.read.parquet(str(tmp_path / "lengths"))
    for buckets in (2, 5, 16):
        out = packing.pack(df, "n_tokens", "doc_id", buckets=buckets).collect()
        assert sum(r["padded_length"] - r["n_tokens"] for r in out) == least_padding(lengths, buckets)
