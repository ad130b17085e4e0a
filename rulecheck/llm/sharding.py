"""Sharding by histogram sort: shards of near equal bytes, equal texts side by side, one exchange of the rows.

The sort key is (k1, k2): 62 bits of a hash of the text, then 62 bits of a hash of the row. Splitters are found by
counting, on all partitions at once, the exact bytes below candidate boundaries (probes): every round counts 1,024
equal cells inside each cell that still holds a splitter, until a boundary lies within ``tolerance`` of its target or
a single text is left. Only sums per cell reach the driver (at most 1,024 times the number of shards a round).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulecheck.llm.common import free_name, gapless_number, materialize, table, without

KEY_BITS, FIRST_BITS, STEP_BITS = 62, 12, 10


@dataclass(frozen=True)
class Splitters:
    """``at``: the shards - 1 boundaries (k1, k2), ascending; ``rows`` and ``size`` are totals of the input."""

    at: list[tuple[int, int]]
    rows: int
    size: int
    rounds: int


def key_column(*cols: Column | str, seed: int = 0) -> Column:
    """62 bits of a hash as a long of zero or more. Nulls are hashed as a value of their own."""
    parts = [p for c in cols for c2 in [F.col(c) if isinstance(c, str) else c] for p in (c2, c2.isNull())]
    return F.shiftrightunsigned(F.xxhash64(*parts, F.lit(seed)), 64 - KEY_BITS)


def _cell(bits: int) -> list[Column]:
    """The cell of a row among 2**bits equal cells of the key space."""
    if bits <= KEY_BITS:
        return [F.shiftright("k1", KEY_BITS - bits).alias("c1"), F.lit(0).cast("bigint").alias("c2")]
    return [F.col("k1").alias("c1"), F.shiftright("k2", 2 * KEY_BITS - bits).alias("c2")]


def _start(cell: tuple[int, int], bits: int) -> tuple[int, int]:
    return (cell[0] << KEY_BITS - bits, 0) if bits <= KEY_BITS else (cell[0], cell[1] << 2 * KEY_BITS - bits)


def _end(cell: tuple[int, int], bits: int) -> tuple[int, int]:
    """The first key after the cell. It may lie just above the key space: then no row follows."""
    if bits <= KEY_BITS:
        return (cell[0] + 1) << KEY_BITS - bits, 0
    c2 = (cell[1] + 1) << 2 * KEY_BITS - bits
    return (cell[0] + 1, 0) if c2 >> KEY_BITS else (cell[0], c2)


def find_splitters(keys: DataFrame, shards: int, tolerance: float = 0.001, group_tolerance: float = 0.02) -> Splitters:
    """Boundaries that cut keys(k1, k2, size) into shards of near equal size.

    A boundary between two texts is taken as soon as it is within ``tolerance`` of a shard's size from its target. Where
    the target falls inside the copies of one text, the nearer edge of that group is taken within ``group_tolerance``;
    a larger group is cut at the nearest of its rows.
    """
    bits = FIRST_BITS
    rows = keys.groupBy(*_cell(bits)).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    total, n_rows, rounds = sum(r["size"] for r in rows), sum(r["n"] for r in rows), 1
    share = total / shards
    cells = {None: sorted((r["c1"], r["c2"], r["size"]) for r in rows)}
    found: dict[int, tuple[int, int]] = {}
    wanted = {j: (None, 0) for j in range(1, shards)}  # splitter -> (its cell, bytes below that cell)
    while wanted:
        ahead = {}
        for j, (parent, below) in wanted.items():
            target = share * j
            for c1, c2, size in cells.get(parent, []):
                if below + size >= target:
                    break
                below += size
            else:  # no rows at all
                found[j] = _start((0, 0), bits)
                continue
            near = min(target - below, below + size - target)
            slack = tolerance if bits < KEY_BITS else group_tolerance if bits == KEY_BITS else 0
            if near <= slack * share or bits >= 2 * KEY_BITS:
                found[j] = _start((c1, c2), bits) if target - below <= below + size - target else _end((c1, c2), bits)
            else:
                ahead[j] = ((c1, c2), below)
        wanted = ahead
        if not wanted:
            break
        inside = sorted({cell for cell, _ in wanted.values()})
        old, bits = bits, min(bits + STEP_BITS, KEY_BITS if bits < KEY_BITS else 2 * KEY_BITS)
        if old <= KEY_BITS:
            within = F.shiftright("k1", KEY_BITS - old).isin([c for c, _ in inside])
        else:
            within = F.lit(False)
            for c1, c2 in inside:
                within |= (F.col("k1") == c1) & (F.shiftright("k2", 2 * KEY_BITS - old) == c2)
        cells = {cell: [] for cell in inside}
        for r in keys.filter(within).groupBy(*_cell(bits)).agg(F.sum("size").alias("size")).collect():
            start = _start((r["c1"], r["c2"]), bits)
            up = (start[0] >> KEY_BITS - old, 0) if old <= KEY_BITS else (start[0], start[1] >> 2 * KEY_BITS - old)
            cells[up].append((r["c1"], r["c2"], r["size"]))
        cells = {cell: sorted(x) for cell, x in cells.items()}
        rounds += 1
    at = [found[j] for j in range(1, shards)]
    for i in range(1, len(at)):
        at[i] = max(at[i], at[i - 1])
    return Splitters(at, n_rows, total, rounds)


def shard_of(k1: Column, k2: Column, splitters: Splitters) -> Column:
    if not splitters.at:
        return F.lit(0)
    at = F.array(*[F.struct(F.lit(a).cast("bigint").alias("k1"), F.lit(b).cast("bigint").alias("k2")) for a, b in splitters.at])
    return F.size(F.filter(at, lambda s: (k1 > s["k1"]) | ((k1 == s["k1"]) & (k2 >= s["k2"]))))


def histogram_shards(df: DataFrame, shards: int, group: str, row_key: str, size: str, tolerance: float = 0.001,
                     group_tolerance: float = 0.02, rows_per_task: int = 20_000) -> DataFrame:
    """df with shard (0 .. shards - 1, ascending in the key) and slot (0, 1, 2, .. inside the shard).

    ``group``: rows with equal values lie side by side; ``row_key`` orders the rows of a group; ``size``: long, null
    counts as 0. Rows equal in both keys stay in one shard. Null groups form one group; an empty table stays empty;
    shard and slot replace columns of these names, and no other column is touched.
    """
    df = without(df, ["shard", "slot"])
    k1, k2 = free_name(df, "_k1"), free_name(df, "_k2")
    keyed = df.withColumns({k1: key_column(group), k2: key_column(row_key, seed=7)})
    keys = materialize(keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"),
                                    F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size")), "shard-keys")
    splitters = find_splitters(keys, shards, tolerance, group_tolerance)
    tie = free_name(df, "_tie")
    dealt = keyed.withColumns({"shard": shard_of(F.col(k1), F.col(k2), splitters), tie: F.xxhash64(*df.columns)})
    out = gapless_number(dealt, ["shard"], [k1, k2, tie], "slot", splitters.rows // max(1, shards), rows_per_task)
    return out.drop(k1, k2, tie)


def op10_histogram_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes. Null text: size 8, crc32 of the empty text; null doc_id: as a value."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("text_sha"))
    out = histogram_shards(docs, 24, group="text_sha", row_key="doc_id", size="size")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
