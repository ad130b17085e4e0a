"""Periodic runs against brute force: every period, every maximal stretch; and the query against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulecheck.llm import periodic

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """(start, length, period) of all maximal stretches of smallest period q and max(24, 3 q) words or more."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(24, 3 * q):
                found.setdefault((start, length), q)  # the smallest comes first
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def samples():
    rng = random.Random(11)
    for k in range(400):
        words = []
        for _ in range(rng.randrange(1, 6)):
            kind, alphabet = rng.random(), rng.choice((1, 2, 3, 50))
            if kind < 0.5:
                unit = [rng.randrange(alphabet) for _ in range(rng.randrange(1, 41))]
                words += (unit * 12)[:rng.randrange(1, 7 * len(unit) + 20)]
            else:
                words += [rng.randrange(alphabet) for _ in range(rng.randrange(60))]
        yield words
    yield [0] * 700
    yield ([1] * 30 + [2]) * 9
    yield ([1] * 30 + [2] * 25) * 5 + [1] * 29


def test_runs_against_brute_force():
    for words in samples():
        assert periodic.find_runs(np.array(words, np.int64)) == brute_runs(words), words


def test_long_periods_and_degenerate_texts():
    rng = random.Random(5)
    unit = [rng.randrange(5000) for _ in range(9_001)]
    words = [7] * 50 + unit * 3 + unit[:17] + [6_000]
    end = 50 + 3 * 9_001 + 17
    assert periodic.find_runs(np.array(words)) == [(0, 50, 1), (50, end - 50, 9_001)]
    assert periodic.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert periodic.find_runs(np.tile([1, 2, 3], 50_000)) == [(0, 150_000, 3)]
    assert periodic.find_runs(np.arange(30)) == [] == periodic.find_runs(np.zeros(0, np.int64))


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 40])
def test_zero_lags_are_exact(top):
    """Large numbers need a second or third prime; every zero is one, and none is missed."""
    rng = np.random.default_rng(4)
    windows = rng.integers(0, top, (40, 63))
    blocks = rng.integers(0, top, (40, 32))
    for k in range(0, 40, 3):
        blocks[k] = windows[k, k % 32:k % 32 + 32]
    blocks[1] = windows[1, 4:36]
    blocks[1, 5] += periodic.PRIMES[0][0]  # equal only by the first prime
    row, lag = periodic.zero_lags(blocks, windows, 32)
    want = [(r, i) for r in range(40) for i in range(32) if (blocks[r] == windows[r, i:i + 32]).all()]
    assert list(zip(row.tolist(), lag.tolist(), strict=True)) == want


def test_edge_rows(spark, edge):
    got = [r.asDict() for r in periodic.periodic_runs(edge, "text").collect()]
    assert len(got) == edge.count() and {"bucket", "secrets", "_rest"} <= set(got[0])
    for r in got:
        words = re.findall(periodic.WORD, r["text"] or "")
        runs = [tuple(x) for x in r["runs"]]
        assert r["n_words"] == len(words)
        assert runs == ([(0, 60_000, 977)] if r["doc_id"] == 7 else brute_runs(words))
        assert r["collapsed"] == brute_collapse(words, runs)
    assert periodic.periodic_runs(edge.limit(0), "text").count() == 0


def test_runs_stay_inside_their_text(spark):
    texts = ["a " * 20, "a " * 20, "b a " * 9, "b a " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.periodic_runs(df, "text").collect()}
    assert got == {0: [], 1: [], 2: [], 3: [(0, 60, 2)]}


def test_query_against_plain_python(spark):
    got = {r["doc_id"]: r.asDict() for r in periodic.op12_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    with_runs = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 4_000:
            continue  # the brute force takes the square of the length
        runs = brute_runs(words)
        with_runs += bool(runs)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[d["doc_id"]] == {
            "doc_id": d["doc_id"], "n_runs": len(runs), **dict(zip(("start", "length", "period"), best or (None,) * 3, strict=True)),
            "exponent_milli": 1000 * best[1] // best[2] if best else None,
            "runs_sha256": digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            "collapsed_sha256": digest(brute_collapse(words, runs))}
    assert with_runs >= 10


def test_planted_text(spark):
    rows = [(None, "a b"), (4, None), (4, ""), (4, "  \n ")] + [(i, "a b  c") for i in range(40)]
    got = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", periodic.planted(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert [r["t"] for r in got[:4]] == ["a b", None, "", "  \n "]
    for r in got[4:]:
        h = zlib.crc32(str(r["doc_id"]).encode())
        a = h // 10 % 3
        p = 1 + (3 - a) // (3 + h // 10 % 8)
        want = " ".join("abc"[i] if i < a else "abc"[a + (i - a) % p] for i in range(3)) if h % 10 == 0 else r["text"]
        assert r["t"] == want
