"""Cover-tree Lloyd against plain loops over all entries, the trees' own laws, and the query."""

import hashlib
import math

import numpy as np
import pytest

from rulecheck.llm import vector_codes as vc

SF = "/root/testdata/sf0.001"


def brute(rows, parts, entries, rounds):
    """rows of (key, vector or None) -> (usable rows, codes, errors, codebooks) by comparing every part with every entry."""
    kept = [(k, [math.floor(256 * x) for x in v]) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v: [tuple(v[p * width:(p + 1) * width]) for p in range(parts)]
    books = list(map(list, zip(*[cut(v) for _, v in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]], strict=True)))
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, x: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            met = {}
            for _, v in kept:
                x = cut(v)[p]
                met.setdefault(nearest(p, x), []).append(x)
            for e, xs in met.items():
                books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    codes = [[nearest(p, x) for p, x in enumerate(cut(v))] for _, v in kept]
    errors = [sum(far(x, books[p][c[p]]) for p, x in enumerate(cut(v))) for c, (_, v) in zip(codes, kept, strict=True)]
    return kept, ["".join(f"{c:02x}" for c in code) for code in codes], errors, books


def clouds(rng, n, parts, width, top):
    centres = rng.integers(-top, top + 1, (5, width))
    return centres[rng.integers(0, 5, (parts, n))] + rng.integers(-top // 4 - 1, top // 4 + 2, (parts, n, width))


@pytest.mark.parametrize("top,n", [(0, 50), (1, 200), (60, 400), (100_000, 300)])
def test_trees_keep_their_laws(top, n):
    """Every node's points lie within its radius of its first point; children part their parent's range, siblings lie
    farther apart than they reach; leaves hold equal points; every row appears once in each part."""
    points = clouds(np.random.default_rng(7), n, 3, 4, top)
    tree = vc.build(points)
    assert [sorted(o) for o in tree.order.tolist()] == [list(range(n))] * 3
    assert all((tree.points[p] == points[p][tree.order[p]]).all() for p in range(3))
    flat = tree.points.reshape(-1, 4)
    square = lambda a, b: ((a - b) ** 2).sum(axis=-1)
    for start, end, radius, first, kids in tree.nodes.tolist():
        assert square(flat[start:end], flat[start]).max() == radius
        if radius == 0:
            assert kids == 0
            continue
        below = tree.nodes[first:first + kids]
        assert below[0, 0] == start and below[-1, 1] == end and (below[1:, 0] == below[:-1, 1]).all() and kids > 1
        centres = flat[below[:, 0]]
        for k in range(1, kids):
            assert square(centres[:k], centres[k]).min() > below[:, 2].max() - 1e-9


@pytest.mark.parametrize("top", [0, 1, 5, 60, 100_000])
def test_walk_against_all_entries(top):
    """Ties, equal entries and far entries: the lowest of the nearest, by subtree sums as by single points."""
    rng = np.random.default_rng(top)
    points = clouds(rng, 500, 4, 3, top)
    books = np.ascontiguousarray(points[:, rng.integers(0, 500, 16)])
    own, tree = vc.distinct_entries(books), vc.build(points)
    far = ((points[:, :, None] - books[:, None]) ** 2).sum(axis=3)
    want, least = far.argmin(axis=2), far.min(axis=2)
    codes, error = vc.codes_of(tree, books, own)
    assert (codes.T == want).all() and (error == least.sum(axis=0)).all()
    counts, sums = vc.sums_of(tree, books, own)
    for p in range(4):
        for e in range(16):
            assert counts[p, e] == (want[p] == e).sum() and (sums[p, e] == points[p][want[p] == e].sum(axis=0)).all()


def test_subtrees_are_assigned_whole():
    points = np.repeat(np.array([[[0, 0], [1000, 1000]]]), 500, axis=1) + np.random.default_rng(1).integers(0, 9, (1, 1000, 2))
    tree = vc.build(points)
    start, _, _ = vc.walk(tree, np.array([[[0, 0], [1000, 1000]]]), np.ones((1, 2), bool))
    assert len(start) < 10


def rows_with_faults(rng, n, width):
    rows = [(int(k), [float(x) for x in rng.normal(0, 0.2, width)]) for k in rng.permutation(n)]
    nan, inf = float("nan"), float("inf")
    rows += [(n, None), (n + 1, [nan] * width), (n + 2, [0.1] * (width - 1) + [None]), (n + 3, [inf] + [0.0] * (width - 1))]
    rows += [rows[5]] * 4 + [(None, rows[6][1]), (rows[7][0], rows[8][1]), (-1, [0.0] * width), (-2, [-0.0] * width)]
    return rows


def test_compress_against_brute_force(spark):
    rows = rows_with_faults(np.random.default_rng(2), 150, 8)
    df = spark.createDataFrame([(k, v, "x", 1, "y") for k, v in rows], "id long, v array<double>, code string, _rest int, error string").repartition(5)
    told, books = vc.compress(df, "v", "id", parts=4, entries=9, rounds=3)
    kept, codes, errors, want = brute(rows, 4, 9, 3)
    assert books.entries.tolist() == [[list(e) for e in book] for book in want]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r["id"], r["code"], r["error"]) for r in told.collect()], key=key) == sorted(
        [(k, c, e) for (k, _), c, e in zip(kept, codes, errors, strict=True)], key=key)
    assert told.columns == ["id", "_rest", "code", "error"]


def test_few_rows_and_none(spark):
    empty = spark.createDataFrame([], "id long, v array<float>")
    told, books = vc.compress(empty, "v", "id")
    assert books is None and told.count() == 0 and told.columns == ["id", "code", "error"]
    told, books = vc.compress(spark.createDataFrame([(1, [0.5] * 16), (1, [0.5] * 16), (2, None)], "id long, v array<float>"), "v", "id")
    assert [tuple(r) for r in told.collect()] == [(1, "00" * 16, 0)] * 2 and books.entries.shape == (16, 2, 1)
    back = told.select(vc.decode(told["code"], books).alias("x")).first()["x"]
    assert back == [(128 + 0.5) / 256] * 16
    with pytest.raises(ValueError):
        vc.compress(spark.createDataFrame([(1, [0.5] * 16), (2, [0.5] * 32)], "id long, v array<float>"), "v", "id")


def test_query_against_brute_force(spark):
    got = sorted(
        tuple(r) for r in vc.op13_cover_tree_codes(spark, SF).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    source = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    labels = {r["vec_id"]: r["label"] for r in source}
    kept, codes, errors, books = brute([(r["vec_id"], r["embedding"]) for r in source], 16, 64, 2)
    by_label = {}
    for (k, _), e in zip(kept, errors, strict=True):
        by_label[labels[k]] = by_label.get(labels[k], 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    assert got == sorted((k, c, e, by_label[labels[k]], digest) for (k, _), c, e in zip(kept, codes, errors, strict=True))
