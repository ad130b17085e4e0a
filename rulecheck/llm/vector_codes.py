"""Vector compression: product codes learnt by Lloyd rounds over cover trees.

Every component x becomes the integer floor(256 x); vectors are cut into equal parts, each with a codebook of its own.
The rows are dealt to batches inside their partitions, and each batch gets one cover tree for each part position: the
children of a node at level l cover its points within 2^(l-1) and lie more than 2^(l-1) apart; a node is a range of the
batch's points in tree order, so that sums over a subtree are differences of cumulative sums. The trees are
written once (shared folder) and serve all rounds.

A round walks each tree from its root with the whole codebook. By the triangle inequality an entry farther from a
node's centre than the nearest one by more than twice the node's radius cannot be the nearest of any point below: where
one entry is left, the whole subtree is assigned by its sums; only ambiguous nodes are opened, down to single points,
whose distances are compared exactly (integers; ties go to the lower index). A task returns one row of sums for each
entry, so a round brings parts x entries rows to the driver, however large the table is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulecheck.llm import arrow  # noqa: F401 - sends this subpackage's code with the tasks
from rulecheck.llm.common import attach, free_name, materialize, restore, shield, table

SCALE = 256
BATCH_ROWS, BATCH_BYTES = 4_096, 8_000_000
NODE = 5  # numbers of a node: start, end, squared radius, first child, number of children
MOST = 1 << 27  # magnitudes below this keep every squared distance of up to 64 components inside a long

TREE = T.StructType([T.StructField("order", T.ArrayType(T.IntegerType())), T.StructField("points", T.ArrayType(T.IntegerType())),
                     T.StructField("nodes", T.ArrayType(T.LongType())), T.StructField("node_counts", T.ArrayType(T.IntegerType()))])


def whole_numbers(vector: Column) -> Column:
    """Component-wise floor(256 x) as longs; null for a vector that is null or holds null or non-finite components."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & usable, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint")))


# ---------------------------------------------------------------------------- trees
@dataclass
class Tree:
    """The cover trees of one batch: ``order`` (parts, n) names the row at each place of the tree order, ``points``
    (parts, n, width) holds the points in that order, ``nodes`` (k, NODE) has ranges over all parts (part * n + place)
    and ``roots`` the node of each part."""

    order: np.ndarray
    points: np.ndarray
    nodes: np.ndarray
    roots: np.ndarray


def build(parts: np.ndarray) -> Tree:
    """Cover trees of points (parts, n, width), all parts level by level at once."""
    count, n, width = parts.shape
    flat = parts.reshape(count * n, width)
    order = np.arange(count * n)
    far = _squares(flat, np.repeat(np.arange(count) * n, n), flat)
    nodes = np.zeros((count, NODE), np.int64)
    nodes[:, 0], nodes[:, 1] = np.arange(count) * n, (np.arange(count) + 1) * n
    nodes[:, 2] = np.maximum.reduceat(far, nodes[:, 0])
    made, live = [nodes], np.arange(count)  # nodes that still hold different points
    done, level = count, max(1, int(nodes[:, 2].max()).bit_length() // 2 + 1)
    while True:
        reach = 4 ** (level - 1) if level else 0  # the square of 2^(level - 1); below one, only equal points are covered
        every = np.concatenate(made)
        live = live[every[live, 2] > 0]
        if not len(live):
            break
        split = live[every[live, 2] > reach]
        if len(split):
            start, end = every[split, 0], every[split, 1]
            places, group = _ranges(start, end)
            child, squared = _net(flat, order, places, group, reach)
            turn = np.lexsort((child, group))  # stable: the centre of a child is its first point
            order[places], child, squared = order[places[turn]], child[turn], squared[turn]
            new = np.flatnonzero(np.r_[True, (child[1:] != child[:-1]) | (group[1:] != group[:-1])])
            kids = np.zeros((len(new), NODE), np.int64)
            kids[:, 0], kids[:, 1] = places[new], places[np.r_[new[1:] - 1, len(places) - 1]] + 1
            kids[:, 2] = np.maximum.reduceat(squared, new)
            sizes = np.bincount(group[new], minlength=len(split))
            every[split, 3], every[split, 4] = done + np.r_[0, sizes.cumsum()[:-1]], sizes
            live = np.concatenate([live[every[live, 2] <= reach], np.arange(done, done + len(new))])
            done += len(new)
            made = [every, kids]
        level -= 1
    nodes = np.concatenate(made)
    return Tree((order % n).reshape(count, n), flat[order].reshape(count, n, width), nodes, np.arange(count))


def _squares(flat: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = flat[a] - b
    return np.einsum("ij,ij->i", gap, gap)


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges one after another, and the number of the range of each."""
    sizes = end - start
    group = np.repeat(np.arange(len(start)), sizes)
    return np.arange(int(sizes.sum())) - np.repeat(sizes.cumsum() - sizes, sizes) + start[group], group


def _net(flat: np.ndarray, order: np.ndarray, places: np.ndarray, group: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each point the number of the child of its group that covers it, and its squared distance to that child's
    centre: in each group the first uncovered point becomes a centre until all are covered."""
    child, squared = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    left, k = np.arange(len(places)), 0
    points = flat[order[places]]
    while len(left):
        g = group[left]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        centre = np.repeat(left[first], np.diff(np.r_[first, len(left)]))
        gap = points[left] - points[centre]
        d = np.einsum("ij,ij->i", gap, gap)
        near = d <= reach
        child[left[near]], squared[left[near]] = k, d[near]
        left, k = left[~near], k + 1
    return child, squared


def walk(tree: Tree, books: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, entry) of ranges that together cover all points of all parts, each range with one nearest entry.

    books (parts, entries, width); own (parts, entries): entries not equal to an earlier one of their part.
    """
    parts, n, width = tree.points.shape
    flat = tree.points.reshape(parts * n, width)
    at, open_to = tree.roots, own
    starts, ends, entries = [], [], []
    while len(at):
        step = max(1, 2_000_000 // (books.shape[1] * width))
        nexts, masks = [], []
        for k in range(0, len(at), step):
            node, may = tree.nodes[at[k:k + step]], open_to[k:k + step]
            gap = flat[node[:, 0], None, :] - books[node[:, 0] // n]
            squared = np.einsum("ijk,ijk->ij", gap, gap)
            away = np.where(may, np.sqrt(squared.astype(np.float64)), np.inf)
            radius = np.sqrt(node[:, 2].astype(np.float64))
            bound = (away.min(axis=1) + 2 * radius) * (1 + 1e-9) + 1e-6
            may = may & (away <= bound[:, None])
            sure = (may.sum(axis=1) == 1) | (node[:, 2] == 0)
            nearest = np.where(may, squared, np.iinfo(np.int64).max).argmin(axis=1)
            starts.append(node[sure, 0])
            ends.append(node[sure, 1])
            entries.append(nearest[sure])
            rest = node[~sure]
            kids, parent = _ranges(rest[:, 3], rest[:, 3] + rest[:, 4])
            nexts.append(kids)
            masks.append(may[~sure][parent])
        at, open_to = np.concatenate(nexts), np.concatenate(masks)
    start, end, entry = (np.concatenate(x) for x in (starts, ends, entries))
    turn = start.argsort()
    return start[turn], end[turn], entry[turn]


def sums_of(tree: Tree, books: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts, entries) counts and (parts, entries, width) sums of the points nearest to each entry."""
    parts, n, width = tree.points.shape
    start, end, entry = walk(tree, books, own)
    cumulative = np.zeros((parts * n + 1, width), np.int64)
    tree.points.reshape(parts * n, width).cumsum(axis=0, out=cumulative[1:])
    counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
    np.add.at(counts, (start // n, entry), end - start)
    np.add.at(sums, (start // n, entry), cumulative[end] - cumulative[start])
    return counts, sums


def codes_of(tree: Tree, books: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, parts) nearest entries and (n,) squared distances summed over the parts, in the order of the batch's rows."""
    parts, n, width = tree.points.shape
    start, end, entry = walk(tree, books, own)
    placed = np.repeat(entry, end - start).reshape(parts, n)
    gap = tree.points - np.take_along_axis(books, placed[:, :, None], axis=1)
    squared = np.einsum("ijk,ijk->ij", gap, gap)
    codes, error = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
    for p in range(parts):
        codes[tree.order[p], p] = placed[p]
        error[tree.order[p]] += squared[p]
    return codes, error


def distinct_entries(books: np.ndarray) -> np.ndarray:
    """(parts, entries): whether an entry differs from all earlier ones of its part."""
    out = np.zeros(books.shape[:2], bool)
    for p, book in enumerate(books):
        out[p, np.unique(book, axis=0, return_index=True)[1]] = True
    return out


# ---------------------------------------------------------------------------- tables
def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = max(1, min(BATCH_ROWS, BATCH_ROWS if not batch.nbytes else BATCH_BYTES * batch.num_rows // batch.nbytes))
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def tree_table(rows: DataFrame, vector: str, parts: int) -> DataFrame:
    """One row for each batch of rows(.., vector): the batch's rows without the vector, as an array, and its trees."""
    kept = [f for f in rows.schema.fields if f.name != vector]
    at = rows.columns.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            n, column = batch.num_rows, batch.column(at)
            numbers = column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            if numbers.size and np.abs(numbers).max() >= MOST:
                raise ValueError(f"a component lies outside +-{MOST // SCALE}")
            tree = build(np.ascontiguousarray(numbers.reshape(n, parts, -1).transpose(1, 0, 2)))
            inside = pa.StructArray.from_arrays([c for k, c in enumerate(batch.columns) if k != at], [f.name for f in kept])
            one = lambda x, kind: pa.array([x.ravel()], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays([0, n], inside), one(tree.order, pa.int32()), one(tree.points, pa.int32()),
                 one(tree.nodes, pa.int64()), pa.array([[parts]], pa.list_(pa.int32()))], names=schema.names)

    schema = T.StructType([T.StructField("rows", T.ArrayType(T.StructType(kept))), *TREE.fields])
    return rows.mapInArrow(run, schema)


def _trees(batch: pa.RecordBatch) -> Iterator[Tree]:
    for k in range(batch.num_rows):
        order, points, nodes, counts = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in TREE.names)
        parts = int(counts[0])
        order = order.reshape(parts, -1)
        yield Tree(order, points.astype(np.int64).reshape(*order.shape, -1), nodes.reshape(-1, NODE), np.arange(parts))


@dataclass(frozen=True)
class Codebooks:
    """``entries`` (parts, entries, width) of whole numbers."""

    entries: np.ndarray

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def one_round(trees: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by the floor of the mean of the points nearest to it; unused entries stay."""
    parts, k, width = books.entries.shape
    names = [f"s{j}" for j in range(width)]
    entries, own = books.entries, distinct_entries(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for batch in batches:
            for tree in _trees(batch):
                c, s = sums_of(tree, entries, own)
                counts, sums = counts + c, sums + s
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["part", "entry", "n", *names])

    told = trees.select(*TREE.names).mapInArrow(run, ", ".join(f"{c} long" for c in ("part", "entry", "n", *names)))
    new = entries.copy()
    for r in told.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect():  # parts x entries rows at most
        new[r["part"], r["entry"]] = [r[c] // r["n"] for c in names]
    return Codebooks(new)


def first_codebooks(rows: DataFrame, vector: str, key: str, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors of the least keys (equal keys: of the least vectors; null keys come last). None without rows."""
    first = rows.select(key, vector).orderBy(F.col(key).asc_nulls_last(), vector).limit(entries).collect()
    if not first:
        return None
    numbers = np.array([r[vector] for r in first], np.int64)
    return Codebooks(np.ascontiguousarray(numbers.reshape(len(first), parts, -1).transpose(1, 0, 2)))


def compress(df: DataFrame, vector: str, key: str, parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, Codebooks | None]:
    """(rows with a usable vector, codebooks). The rows have all columns of df but the vector, and code (the entry of each
    part in two hex digits) and error (squared distance of the whole numbers to the coded ones).

    Rows whose vector is null, or holds null or non-finite components, are left out; so are empty vectors. Vectors must
    have one length, a multiple of ``parts``, and components within +-2^19: a ValueError tells otherwise. Repeated rows
    count as often as they occur; ties go to the lower index; an empty table gives no rows and no codebooks. A column
    named code or error is replaced; other names cannot clash. At most 256 entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits names at most 256 entries")
    columns = [c for c in df.columns if c != vector]
    work = shield(df, vector, key)
    whole, held = free_name(work, "_whole"), free_name(work, "_key")
    work = work.select("_rest", F.col(key).alias(held), whole_numbers(F.col(vector)).alias(whole)).filter(F.size(whole) > 0)
    lengths = work.agg(F.min(F.size(whole)).alias("least"), F.max(F.size(whole)).alias("most")).first()
    if lengths["least"] != lengths["most"] or (lengths["least"] or 0) % parts:
        raise ValueError(f"vectors of {lengths['least']} to {lengths['most']} components cannot be cut into {parts} equal parts")
    books = first_codebooks(work, whole, held, parts, entries)
    trees = materialize(tree_table(work, whole, parts), "cover-trees")
    for _ in range(rounds if books else 0):
        books = one_round(trees, books)
    final = books.entries if books else np.zeros((parts, 1, 1), np.int64)
    own = distinct_entries(final)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, tree in enumerate(_trees(batch)):
                codes, error = codes_of(tree, final, own)
                digits = [bytes(c).hex() for c in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([digits], pa.list_(pa.string())),
                                                  pa.array([error], pa.list_(pa.int64()))], names=["rows", "code", "error"])

    schema = T.StructType([trees.schema["rows"], T.StructField("code", T.ArrayType(T.StringType())), T.StructField("error", T.ArrayType(T.LongType()))])
    told = trees.mapInArrow(run, schema).select(F.inline(F.arrays_zip("rows", "code", "error")))
    told = told.select("rows.*", "code", "error").withColumnRenamed(held, key)
    return told.select(*restore(told, columns, ["code", "error"])), books


def decode(code: Column, books: Codebooks) -> Column:
    """The coded vector as array<double>: entry values / 256, in the middle of their unit."""
    tables = F.array(*[F.array(*[F.array(*[F.lit((x + 0.5) / SCALE) for x in e]) for e in book]) for book in books.entries.tolist()])
    parts = books.entries.shape[0]
    at = lambda p: F.conv(F.substring(code, p * 2 + 1, 2), 16, 10).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: tables[p][at(p)]))


def op13_cover_tree_codes(spark, sf_dir: str) -> DataFrame:
    """The product code of every usable embedding, its error, the error summed over equal labels (nulls together) and the
    digest of the codebooks."""
    told, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), "embedding", "vec_id")
    told = materialize(told, "vector-codes")
    totals = told.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("error").alias("label_error"))
    out = attach(told, totals, "label", "n", ["label_error"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest if books else Codebooks(np.zeros(0, np.int64)).digest).alias("codebooks_sha256"))
