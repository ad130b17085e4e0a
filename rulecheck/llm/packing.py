"""Packing: optimal length buckets by dynamic programming over the global length histogram, then token-budget batches.

The histogram holds every length under 2^17 by itself, each with its exact count and sum; longer ones lie in cells of
2^16 to an octave (0.0015 % wide), with their largest length. The dynamic program chooses, among these lengths, the
bucket boundaries with the least padding in total: the optimum where no row is longer than 2^17, the optimum among the
cells' largest lengths above. Inside a bucket every row is padded to the
boundary, so a batch of floor(budget / boundary) rows stays inside the token budget.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulecheck.llm.common import free_name, gapless_number, table, without

FINE = 16  # bits of a length that a histogram cell keeps below the leading one


def length_cell(n: Column) -> Column:
    """Cell of a length of zero or more; cells ascend with the length."""
    exponent = F.length(F.bin(n)) - 1
    shift = F.greatest(exponent - FINE, F.lit(0))
    return (shift * 2**FINE + F.call_function("shiftright", n, shift)).cast("bigint")


def length_histogram(lengths: DataFrame) -> list[tuple[int, int, int]]:
    """(largest length, rows, sum of lengths) for each cell of lengths(n), ascending. At most one row for each length there is."""
    rows = lengths.groupBy(length_cell(F.col("n")).alias("cell")).agg(
        F.max("n").alias("most"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total")).collect()
    return sorted((r["most"], r["rows"], r["total"]) for r in rows)


def best_boundaries(histogram: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """At most ``buckets`` boundaries, ascending, with the least total padding; among equals the fewest."""
    if not histogram:
        return []
    most, m = [h[0] for h in histogram], len(histogram)
    n_to, sum_to = ([0, *accumulate(h[k] for h in histogram)] for k in (1, 2))
    best = [most[j] * n_to[j + 1] - sum_to[j + 1] for j in range(m)]  # least padding of cells 0 .. j
    whole, back = best, []
    for _ in range(1, min(buckets, m)):
        # the last bucket begins at cell i + 1: best[i] + sum_to[i + 1] - most[j] * n_to[i + 1] is a line in most[j]; the
        # lower hull of the lines is kept, and most[j] only grows, so each line is entered and left once
        new, pick, hull, at = list(best), [-1] * m, [], 0
        for j in range(1, m):
            line = (n_to[j], best[j - 1] + sum_to[j], j - 1)
            while len(hull) > 1 and (line[1] - hull[-2][1]) * (hull[-1][0] - hull[-2][0]) <= (hull[-1][1] - hull[-2][1]) * (line[0] - hull[-2][0]):
                hull.pop()
            hull.append(line)
            at, x = min(at, len(hull) - 1), most[j]
            while at + 1 < len(hull) and hull[at + 1][1] - x * hull[at + 1][0] <= hull[at][1] - x * hull[at][0]:
                at += 1
            ways = whole[j] + hull[at][1] - x * hull[at][0]
            if ways < best[j]:
                new[j], pick[j] = ways, hull[at][2]
        back.append(pick)
        if new == best:
            break
        best = new
    ends, j = [m - 1], m - 1
    for pick in reversed(back):
        if pick[j] >= 0:
            j = pick[j]
            ends.append(j)
    return [int(most[e]) for e in reversed(ends)]


def pack(df: DataFrame, length: str, row_key: str, buckets: int = 16, budget: int = 65_536,
         rows_per_task: int = 20_000) -> DataFrame:
    """df with bucket, padded_length, batch (of the bucket, from 0) and place (inside the batch, from 0).

    Lengths may be null (0). A row longer than the budget forms a batch of its own; nothing is cut. Inside a bucket
    rows are dealt to batches in a fixed order of a hash of ``row_key``; equal rows keep separate places. An empty
    table stays empty. The four new columns replace others of their names; helper columns avoid every name of the input.
    """
    df = without(df, ["bucket", "padded_length", "batch", "place"])
    n, number, key, tie = (free_name(df, x) for x in ("_n", "_number", "_key", "_tie"))
    sized = df.withColumn(n, F.coalesce(F.col(length), F.lit(0)).cast("bigint"))
    histogram = length_histogram(sized.select(F.col(n).alias("n")))
    bounds = best_boundaries(histogram, buckets)
    if not bounds:
        bounds = [0]
    at = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    placed = sized.withColumns({"bucket": F.size(F.filter(at, lambda b: b < F.col(n))),
                                key: F.xxhash64(F.col(row_key)), tie: F.xxhash64(*df.columns)})
    placed = placed.withColumn("padded_length", at[F.col("bucket")])
    out = gapless_number(placed, ["bucket"], [key, tie], number, sum(r for _, r, _ in histogram), rows_per_task)
    fit = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(budget) / F.greatest(F.col("padded_length"), F.lit(1))))
    return out.select(*df.columns, "bucket", "padded_length", F.floor(F.col(number) / fit).cast("bigint").alias("batch"),
                      F.pmod(F.col(number), fit).cast("bigint").alias("place"))


def byte_length(text: Column) -> Column:
    """Tokens of a byte-level model with one end token: UTF-8 bytes and 1. Null text: the end token alone."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def op8_length_buckets(spark, sf_dir: str) -> DataFrame:
    """Every document's bucket, padded length, batch and place, by byte-level tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", byte_length(F.col("text")).alias("n_tokens"))
    return pack(docs, "n_tokens", "doc_id")
