"""Near-duplicate classes by order MinHash, verified by banded alignment.

A text is its sequence of (lower-case) words, its k-mers are runs of K words labelled with their occurrence number. Each
of VECTORS hash functions picks the PICKS least labelled k-mers and keeps them in text order; texts that agree in one
such vector share a bucket. Two texts are linked if their edit distance over words is at most (1 - SIMILARITY) of the
longer one's length; classes are the connected components of the links, named by their least doc_id.

Every two texts that share a bucket are settled. Equal texts are one node from the start (by digest, after a partial
aggregate). In each bucket the leader, the member with the most company in all its buckets and so the most central one,
is aligned with every member. Buckets that still hold several classes (their texts may share no more than a common
passage) are then gone through pair by pair, in blocks of at most BLOCK members of like length: pairs of one class are
settled, and pairs whose lengths or word counts (binned, a lower bound of the edit distance) rule a link out are no
links. The rest is aligned, first the nearest pair of each text and class, then all that are still in two classes. So
the classes are exact among texts that share a bucket; what the buckets miss is stated in the README.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulecheck.llm.arrow import with_columns
from rulecheck.llm.common import free_name, materialize, table

K, PICKS, VECTORS, SIMILARITY = 5, 3, 24, 0.8
KNOWN_WORDS = 300_000
PAIRS_PER_TASK = 256  # of one leader, before it is sent to several tasks
HOT_KEY = 20_000  # members of a bucket, above which they are dealt to several tasks
SHORT = 9  # words of a text up to which a link is one edit at most
BLOCK = 1024  # members of a bucket that are compared with each other at once
BINS = 1024  # word counts of a text, for the lower bound of an edit distance: more than the words of most texts, so few share one
_C = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(33))


SEEDS = _mix(np.arange(1, VECTORS + 1, dtype=np.uint64) * _C)


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > KNOWN_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter((known[w] for w in words), np.uint64, len(words))


def vectors(hashes: np.ndarray) -> np.ndarray:
    """The bucket keys of a text's word hashes; a text of fewer than K words is one k-mer, one without words has none."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    width = min(K, n)
    grams = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        grams = grams * _C + hashes[i:n - width + 1 + i]
    grams = _mix(grams)
    order = grams.argsort(kind="stable")  # equal k-mers side by side, in text order: their occurrence numbers
    ranked = grams[order]
    begins = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.arange(len(grams))
    occurrence = np.empty(len(grams), np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(begins, at, 0))
    labelled = _mix(grams + occurrence * _C)
    picks = min(PICKS, len(labelled))
    keys = np.zeros(VECTORS, np.uint64)
    step = max(1, 1_000_000 // len(labelled))
    for s in range(0, VECTORS, step):
        seeds = SEEDS[s:s + step]
        mixed = _mix(labelled[None, :] ^ seeds[:, None])
        least = np.sort(mixed.argpartition(picks - 1, axis=1)[:, :picks], axis=1)  # back in text order
        key = seeds.copy()
        for i in range(picks):
            key = _mix(key * _C + labelled[least[:, i]])
        keys[s:s + step] = key
    return keys.view(np.int64)


def short_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of a text of at most SHORT words, which has few k-mers or none that an edit leaves: the whole and, where one
    edit makes a link, all but one word. Texts of at most SHORT words that are a link share one of them."""
    n = len(hashes)
    if not 0 < n <= SHORT:
        return np.zeros(0, np.int64)
    keys = []
    for sequence in [hashes, *(np.delete(hashes, i) for i in range(n) if threshold(n))]:
        key = np.array([_C])
        for w in sequence:
            key = _mix(key * _C + w)
        keys.append(key[0])
    return np.unique(np.array(keys, np.uint64)).view(np.int64)


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs(doc_id, text) -> doc_id, node (digest of the text, null for null), n_words, words (packed), keys."""
    fields = [T.StructField("node", T.BinaryType()), T.StructField("n_words", T.IntegerType()),
              T.StructField("words", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))]

    def make():
        known: dict[bytes, int] = {}

        def work(texts: list[str]) -> list[pa.Array]:
            hashes = [word_hashes(t.lower().encode().split(), known) for t in texts]
            return [pa.array([hashlib.md5(t.encode()).digest() for t in texts], pa.binary()), pa.array([len(h) for h in hashes], pa.int32()),
                    pa.array([zlib.compress(h.astype(np.uint32).tobytes(), 1) for h in hashes], pa.binary()),
                    pa.array([np.concatenate([vectors(h), short_keys(h)]) for h in hashes], pa.list_(pa.int64()))]

        return work

    made = with_columns(docs.select("doc_id", F.col(text).alias("text")), "text", fields, make)
    there = F.col("text").isNotNull()
    return made.select("doc_id", F.when(there, F.col("node")).alias("node"), "n_words", "words", "keys")


def threshold(longest):
    """The largest edit distance of a link, in exact integers (a fifth of the longer text, rounded down)."""
    return longest * round(1000 * (1 - SIMILARITY)) // 1000


def banded_distance(a: list, b: list, bound: int) -> int | None:
    """Edit distance of two sequences, or None if it is above ``bound``.

    A bit-parallel table of which only a diagonal band of 2 * bound + 1 rows is kept (column j: rows j - bound to
    j + bound, the lowest bit on top); the band slides down one row with each column.
    """
    if len(a) < len(b):
        a, b = b, a
    skew = len(a) - len(b)
    if skew > bound:
        return None
    if not b:
        return skew
    rows = {}
    for i, w in enumerate(a):
        rows.setdefault(w, []).append(i)
    where = {}
    for w in set(b):
        bits = bytearray(len(a) // 8 + 1)
        for i in rows.get(w, ()):
            bits[i >> 3] |= 1 << (i & 7)
        where[w] = int.from_bytes(bits, "little")
    mask, end = (1 << (2 * bound + 1)) - 1, 1 << (bound + skew)
    up, down, distance = mask & ~((1 << bound) - 1), 0, skew
    for j, w in enumerate(b, 1):
        first = j - bound - 1  # the place in a of the band's top row
        equal = (where[w] >> first if first >= 0 else where[w] << -first) & mask
        still = ((((equal & up) + up) ^ up) | equal | down) & mask
        right, left = (down | ~(still | up)) & mask, still & up
        if not still & end:
            distance += 1
            if distance > bound:
                return None
        shifted = still >> 1
        up, down = (left | ~(shifted | right)) & mask, shifted & right
    return distance


def distance(a: np.ndarray, b: np.ndarray, bound: int) -> int | None:
    """banded_distance after a bound by common words and without the common ends; the band widens until it suffices."""
    if abs(len(a) - len(b)) > bound:
        return None
    short = min(len(a), len(b))
    same = a[:short] == b[:short]
    head = short if same.all() else int(same.argmin())
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    if short:
        same = a[len(a) - short:][::-1] == b[len(b) - short:][::-1]
        tail = short if same.all() else int(same.argmin())
        a, b = a[:len(a) - tail], b[:len(b) - tail]
    longest = max(len(a), len(b))
    words, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    common = np.minimum(np.bincount(inverse[:len(a)], minlength=len(words)), np.bincount(inverse[len(a):], minlength=len(words))).sum()
    if longest - common > bound:
        return None
    bound, band = min(bound, longest), 64
    a, b = inverse[:len(a)].tolist(), inverse[len(a):].tolist()
    while band < bound:
        found = banded_distance(a, b, band)
        if found is not None:
            return found
        band *= 8
    return banded_distance(a, b, bound)


def verify(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """pairs(hub, node) -> hub, node, n_hub, n_node, d: their edit distance, null if above the threshold of a link.

    ``words``: node, words, n_words. Rows of a leader lie together, the leader first; a leader of many pairs is sent to
    several tasks, so neither a task nor memory grows with it.
    """
    counts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_TASK).cast("int").alias("parts"))
    led = counts.join(words, counts.hub == words.node).select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("binary").alias("node"), "n_words", "words")
    dealt = pairs.join(counts, "hub").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).select("hub", "part", "node")
    followers = dealt.join(words, "node").select("hub", "part", "node", "n_words", "words")
    rows = led.unionByName(followers).repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("node").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, its = None, np.zeros(0, np.uint32)
        for batch in batches:
            found = []
            for hub, node, packed in zip(*(batch.column(c).to_pylist() for c in ("hub", "node", "words")), strict=True):
                seq = np.frombuffer(zlib.decompress(packed), np.uint32)
                if node is None:
                    leader, its = hub, seq
                elif hub == leader:
                    found.append((hub, node, len(its), len(seq), distance(its, seq, threshold(max(len(its), len(seq))))))
                else:
                    raise ValueError("a follower came before its leader")
            columns = zip(*found, strict=True) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32()), strict=True)],
                                             names=["hub", "node", "n_hub", "n_node", "d"])

    return rows.mapInArrow(run, "hub binary, node binary, n_hub int, n_node int, d int")


def _limit(n: Column, m: Column) -> Column:
    return F.floor(F.greatest(n, m).cast("bigint") * round(1000 * (1 - SIMILARITY)) / 1000)


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> node, label: the least node of its connected component.

    In each round every node hooks onto its least neighbour, if that is less than itself; the trees that arise are
    followed to their roots (doubling the steps), and the edges between roots are the next round's. So an edge is read
    in later rounds only while its ends are in two trees, and the nodes at least halve in two rounds: a root that no
    neighbour hooks onto has a lesser root beside it in the next round.
    """
    left, labels = edges.select("a", "b"), None
    while True:
        left = materialize(left.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if labels is not None and left.isEmpty():
            return labels
        # the greater end of an edge may hook, its other neighbours may be still less; the lesser end is a node, too
        hooks = left.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(left.select(F.col("a").alias("node"), F.col("a").alias("label")))
        trees = _rooted(materialize(hooks.groupBy("node").agg(F.min("label").alias("label")), "hooks"))
        labels = trees if labels is None else materialize(_renamed(labels, "label", trees), "labels")
        left = _renamed(_renamed(left, "a", trees), "b", trees)


def _renamed(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """rows with the nodes of a column replaced by their labels, where they have one."""
    own = labels.select(F.col("node").alias("own_"), F.col("label").alias("to_"))
    return rows.join(own, F.col(column) == F.col("own_"), "left").withColumn(column, F.coalesce("to_", column)).select(*rows.columns)


def _rooted(trees: DataFrame) -> DataFrame:
    """trees(node, label), label the parent (a root's is itself) -> the same with the roots: every step jumps twice as far."""
    while True:
        up = trees.select(F.col("node").alias("up"), F.col("label").alias("further"))
        jumped = materialize(trees.join(up, trees.label == up.up).select("node", F.col("further").alias("label"), F.col("label").alias("old")), "trees")
        trees = jumped.select("node", "label")
        if jumped.filter("label <> old").isEmpty():
            return trees


def grown(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels of components with further edges: these are joined between the components, not the ones within them."""
    joined = components(_renamed(_renamed(edges.select("a", "b"), "a", labels), "b", labels))
    new = joined.join(labels.select(F.col("node").alias("own_")), F.col("node") == F.col("own_"), "left_anti")
    return materialize(_renamed(labels, "label", joined).unionByName(new), "labels")


def _close(verified: DataFrame) -> DataFrame:
    return verified.filter(F.col("d") <= _limit(F.col("n_hub"), F.col("n_node"))).select(F.col("hub").alias("a"), F.col("node").alias("b"))


def _settled(verified: DataFrame) -> DataFrame:
    return verified.select(F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("node")).distinct()


def length_classes(most: int = 2**31 - 1) -> list[int]:
    """The least length of each class: texts that are two classes apart differ in length by more than a link may."""
    least = [1]
    while least[-1] <= most:
        n = least[-1] + 1
        n = max(n, least[-1] * 1000 // round(1000 * SIMILARITY))
        while n - threshold(n) <= least[-1]:
            n += 1
        least.append(n)
    return least[:-1]


def bins(packed: bytes) -> np.ndarray:
    counts = np.bincount(np.frombuffer(zlib.decompress(packed), np.uint32) % BINS, minlength=BINS)
    return np.minimum(counts, 255).astype(np.uint8)  # a cut count only lowers the bound


def possible(a: np.ndarray, n: int, others: np.ndarray, ns: np.ndarray) -> np.ndarray:
    """A lower bound of the edit distance of a text (bins, words) from others; -1 where it rules a link out."""
    limit = threshold(np.maximum(n, ns))
    least = np.abs(ns - n)
    at = np.flatnonzero(least <= limit)
    common = np.minimum(a[None, :], others[at]).sum(axis=1, dtype=np.int64)
    least[at] = np.maximum(least[at], np.maximum(a.sum(dtype=np.int64), others[at].sum(axis=1, dtype=np.int64)) - common)
    return np.where(least <= limit, least, -1)


def by_key(rows: DataFrame, facts: DataFrame, columns: list[str], *also: str) -> DataFrame:
    """rows(key, size, node, ..) with ``columns`` of facts(key, size, ..), one row for each key (and ``also``).

    Rows of a key of more than HOT_KEY are dealt to several tasks, to each of which its fact is copied.
    """
    parts = F.ceil(F.col("size") / HOT_KEY).cast("int")
    copies = facts.select(F.col("key").alias("k_"), *[F.col(c).alias(f"{c}_k") for c in also], F.explode(F.sequence(F.lit(0), parts - 1)).alias("p_"), *columns)
    dealt = rows.withColumn("part_", F.pmod(F.xxhash64("node"), parts).cast("int"))
    same = (F.col("key") == F.col("k_")) & (F.col("part_") == F.col("p_"))
    for c in also:
        same &= F.col(c) == F.col(f"{c}_k")
    return dealt.join(copies, same).select(*rows.columns, *columns)


def open_pairs(members: DataFrame, labels: DataFrame, words: DataFrame) -> DataFrame:
    """members(key, node, size) -> hub, node, label (of node), least: the pairs of a bucket that are of two classes and may be links.

    A bucket of up to BLOCK members is one block. A larger one is cut by classes of length, and those by a hash into
    blocks; each block meets itself and the blocks of its own and the next class, so no task holds a whole bucket.
    """
    named = members.join(labels.select(F.col("node").alias("n_"), "label"), F.col("node") == F.col("n_"), "left").select(
        "key", "node", "size", F.coalesce("label", "node").alias("label"))
    counts = named.groupBy("key", "size").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    several = by_key(named, counts, [])
    lengths = words.select(F.col("node").alias("w_"), F.col("n_words").alias("n"))
    classes = F.size(F.filter(F.array(*map(F.lit, length_classes())), lambda least: least <= F.col("n")))
    cells = materialize(several.join(lengths, F.col("node") == F.col("w_")).select(
        "key", "node", "size", "label", F.when(F.col("size") <= BLOCK, 0).otherwise(classes).alias("cell")), "cells")
    parts = materialize(cells.groupBy("key", "size", "cell").agg(F.count(F.lit(1)).alias("members"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")), "parts")
    beside = lambda by, name: parts.select(F.col("key").alias(f"{name}_k"), (F.col("cell") - by).alias(f"{name}_c"), F.col("parts").alias(name)).filter(F.col(f"{name}_c") + by > 0)
    around = parts
    for by, name in ((1, "after"), (-1, "before")):
        around = around.join(beside(by, name), (F.col("key") == F.col(f"{name}_k")) & (F.col("cell") == F.col(f"{name}_c")) & (F.col("cell") > 0), "left")
    around = around.select("key", "size", "cell", "members", "parts", "after", "before")
    sub = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")

    def meet(n: Column, block) -> Column:
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), block)).otherwise(F.array().cast("array<struct<place:bigint,side:int>>"))

    def place(cell: Column, kind: int, s: Column, t: Column, side: Column) -> Column:
        return F.struct((((cell * 2 + kind).cast("bigint") * 2**20 + s) * 2**20 + t).alias("place"), side.cast("int").alias("side"))

    cell, own = F.col("cell"), F.col("sub")
    met = F.concat(meet(F.when(F.col("members") > 1, F.col("parts")), lambda t: place(cell, 0, F.least(own, t), F.greatest(own, t), own > t)),
                   meet(F.col("after"), lambda t: place(cell, 1, own, t, F.lit(0))), meet(F.col("before"), lambda t: place(cell - 1, 1, t, own, F.lit(1))))
    dealt = (by_key(cells, around, ["members", "parts", "after", "before"], "cell").withColumn("sub", sub)
             .select("key", "node", "label", F.explode(met).alias("m")).select("key", "node", "label", "m.place", "m.side"))

    def make():
        return lambda packed: [pa.array([bins(p).tobytes() for p in packed], pa.binary())]

    binned = with_columns(words, "words", [T.StructField("bins", T.BinaryType())], make).select(F.col("node").alias("b_"), "n_words", "bins")
    # texts that share several buckets meet in each, but are one pair: it is told by the least key that both have
    keys = cells.groupBy("node").agg(F.collect_set("key").alias("keys")).withColumnRenamed("node", "o_")
    binned = binned.join(keys, F.col("b_") == F.col("o_")).drop("o_")
    rows = (dealt.join(binned, F.col("node") == F.col("b_")).drop("b_").repartition("key", "place").sortWithinPartitions("key", "place"))

    def settle(block: pa.Table) -> Iterator[pa.RecordBatch]:
        nodes, labels, ns, side = (block.column(c).to_numpy() for c in ("node", "label", "n_words", "side"))
        counts = np.frombuffer(b"".join(block.column("bins").to_pylist()), np.uint8).reshape(len(ns), BINS)
        ns, right, key = ns.astype(np.int64), np.flatnonzero(side == 1), block.column("key")[0].as_py()
        keys = [frozenset(k) for k in block.column("keys").to_pylist()]
        for i in range(len(ns)):
            if side[i]:
                continue
            others = right if len(right) else np.arange(i + 1, len(ns))
            others = others[labels[others] != labels[i]]
            if block.column("place")[0].as_py() >> 40 & 1 and not len(right) or not len(others):
                continue
            least = possible(counts[i], ns[i], counts[others], ns[others])
            told = [k for k in np.flatnonzero(least >= 0).tolist() if min(keys[i] & keys[others[k]]) == key]
            if told:
                others, least = others[told], least[told]
                first = [(nodes[i], nodes[j], labels[j]) if nodes[i] < nodes[j] else (nodes[j], nodes[i], labels[i]) for j in others]
                yield pa.RecordBatch.from_arrays([*(pa.array(list(c), pa.binary()) for c in zip(*first, strict=True)), pa.array(least, pa.int64())],
                                                 names=["hub", "node", "label", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table_ = pa.Table.from_batches([batch])
            held = table_ if held is None else pa.concat_tables([held, table_]).combine_chunks()
            keys, places = held.column("key").to_numpy(), held.column("place").to_numpy()
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (places[1:] != places[:-1])) + 1).tolist()]
            for x, y in zip(starts[:-1], starts[1:], strict=True):
                yield from settle(held.slice(x, y - x))
            held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield from settle(held)

    found = rows.mapInArrow(run, "hub binary, node binary, label binary, least bigint")
    return found.dropDuplicates(["hub", "node"])


def links(sketched: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The verified links (a, b) of a materialised table of sketches and their components (node, label); None if no two texts
    share a bucket."""
    nodes = sketched.filter("n_words > 0 AND node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"))
    # one row of each text: joined on both keys, so the copies of a frequent text are spread
    one = sketched.select("doc_id", "node", "keys").join(
        nodes.select(F.col("node").alias("n"), "rep"), (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    held = one.select("node", F.explode("keys").alias("key")).distinct()
    sizes = materialize(held.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
    # each hot key stands for more than HOT_KEY rows, so the broadcast is a small part of the table
    hot = F.broadcast(sizes.filter(F.col("size") > HOT_KEY).select(F.col("key").alias("h_"), F.col("size").alias("hot")))
    marked = held.join(hot, F.col("key") == F.col("h_"), "left").withColumn("size", F.coalesce("hot", F.lit(1)))
    shared = materialize(by_key(marked, sizes.withColumn("bucket", F.col("size")), ["bucket"]).select("key", "node", F.col("bucket").alias("size")), "buckets")
    company = shared.groupBy("node").agg(F.sum("size").alias("company"))
    members = materialize(shared.join(company, "node").select("key", "node", "size", "company"), "members")
    if members.isEmpty():
        return None
    wanted = members.select("node").distinct().join(nodes, "node").select(F.col("node").alias("n"), "rep")
    words = materialize(sketched.select("doc_id", "node", "n_words", "words").join(
        wanted, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
        .select("node", "n_words", "words").dropDuplicates(["node"]), "words")
    hubs = members.groupBy("key", "size").agg(F.min_by("node", F.struct(-F.col("company"), "node")).alias("hub"))
    led = by_key(members, hubs, ["hub"]).filter("hub <> node")
    known = materialize(verify(led.select("hub", "node").distinct(), words), "verified")
    labels = components(_close(known))
    rest = materialize(open_pairs(members.select("key", "node", "size"), labels, words), "open")
    if not rest.isEmpty():
        nearest = materialize(rest.groupBy("hub", "label").agg(F.min_by("node", F.struct("least", "node")).alias("node")).select("hub", "node"), "nearest")
        more = materialize(verify(nearest.join(_settled(known), ["hub", "node"], "left_anti"), words), "verified")
        known, labels = known.unionByName(more), grown(labels, _close(more))
        of = lambda c: labels.select(F.col("node").alias(f"{c}_"), F.col("label").alias(f"{c}_label"))
        named = rest.select("hub", "node").join(of("hub"), F.col("hub") == F.col("hub_"), "left").join(of("node"), F.col("node") == F.col("node_"), "left")
        apart = named.filter(F.coalesce("hub_label", "hub") != F.coalesce("node_label", "node")).select("hub", "node")
        more = materialize(verify(apart.join(_settled(known), ["hub", "node"], "left_anti"), words), "verified")
        known, labels = known.unionByName(more), grown(labels, _close(more))
    close = _close(known)  # a pair may have been led by either of its texts
    return close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), labels


def duplicate_classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, node (digest of the text), class_id, n_links.

    class_id is the least doc_id of the class (null if it has none); n_links counts the links of the row's text to
    other texts that were verified. Rows with null text are classes of their own (class_id = doc_id, node null); empty
    texts are copies of each other, as are all equal texts; texts without words are linked to nothing else. Other
    columns are ignored.
    """
    sketched = materialize(sketches(docs, text), "sketches")
    nodes = sketched.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"))
    found = links(sketched)
    rows = sketched.select("doc_id", "node")
    none = F.lit(0).cast("bigint")
    if found is None:
        each = nodes.select(F.col("node").alias("n"), F.col("rep").alias("class"), none.alias("links"))
    else:
        found, labels = materialize(found[0], "links"), found[1].withColumnRenamed("node", "l")
        degree = found.select(F.explode(F.array("a", "b")).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("links"))
        labelled = nodes.join(labels, nodes.node == labels.l, "left").withColumn("label", F.coalesce("label", "node"))
        first = labelled.groupBy("label").agg(F.min("rep").alias("class")).withColumnRenamed("label", "own")
        each = (labelled.join(first, F.col("label") == F.col("own")).join(degree, F.col("node") == F.col("g"), "left")
                .select(F.col("node").alias("n"), "class", F.coalesce("links", none).alias("links")))
    return rows.join(each, rows.node == each.n, "left").select(
        "doc_id", "node", F.when(F.col("n").isNotNull(), F.col("class")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("links", none).alias("n_links"))


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one row of each class: that of the least doc_id. Rows with null text stay, one for each doc_id."""
    classes = duplicate_classes(docs, text)
    key, own = free_name(docs, "_row"), free_name(docs, "_own")
    row = lambda node, doc_id: F.concat_ws("|", F.coalesce(node, F.lit("-")), F.when(doc_id.isNull(), "-").otherwise(
        F.concat(F.lit("="), doc_id.cast("string"))))
    first = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(row(F.lower(F.hex("node")), F.col("doc_id")).alias(own)).distinct()
    # one key that is never null for both steps: repeated rows go on the way into the one exchange of the texts, and the
    # rows that stay are joined where they lie
    keyed = docs.withColumn(key, row(F.md5(F.col(text).cast("binary")), F.col("doc_id")))
    return keyed.dropDuplicates([key]).join(first, F.col(key) == F.col(own), "left_semi").select(*docs.columns)


def op1_order_minhash(spark, sf_dir: str) -> DataFrame:
    """Every document's class of exact and near copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return duplicate_classes(docs).select("doc_id", "class_id", "n_links", (F.col("doc_id") == F.col("class_id")).alias("is_first"))


