"""Trend checks: period-over-period deviation of a metric.

Here the operator is the FAILING condition: ``abs(deviation %) <op> threshold``
fails. A previous value that is missing or 0 is skipped.

* aggregate: sum the metric per ``groupbycolumns`` (NULL keys dropped, values
  made numeric with unparsable -> 0), then compare each group with the
  previous group of the same first column, ordered by the other columns.
  Plan: partial aggregate + shuffle on all keys, then ``lag_by_range`` over
  the aggregated rows (ranges of keys + a carry between ranges), so no task
  ever holds a whole first-column group.
* two-column: sum the metric and its previous-period column per
  ``distinctcolumn`` (+ FiscalYear / FiscalMonth when present) and compare
  the two sums. One aggregate, no window.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import col, header_map, underscored
from ..functions.numbers import apply_operator, group_sum, pct_deviation
from ..sources.tables import FILE, TableSet
from .base import DATA_VALIDATION, TREND, Outcome, missing_columns, missing_table

# Period columns added to the grouping of a two-column trend.
PERIOD_COLUMNS = ("FiscalYear", "FiscalMonth")
DEFAULT_DISTINCT = "PracticeCode"


#: Keys drawn for each splitter of the ranges.
DRAWN = 16


def _range_number(agg: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``agg`` plus ``_pid``: the number of the range of ``keys`` that a row lies in, some ``parts`` ranges of like size.

    The splitters are part of the plan: of the unique keys those with the lowest
    hashes, about ``DRAWN * parts`` whatever the number of rows, are sorted in
    one scalar subquery and every ``DRAWN``-th is taken. They follow from the
    rows alone, so every evaluation gives the same ranges."""
    key = F.struct(*keys)
    rows = agg.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    drawn = agg.filter(F.pmod(F.xxhash64(*keys), rows) < DRAWN * parts).agg(F.sort_array(F.collect_list(key)).alias("k"))
    splitters = drawn.select(F.filter("k", lambda x, i: i % DRAWN == DRAWN - 1)).scalar()
    # how many splitters a key has reached: bits from the highest that the number of ranges can have
    steps = F.array(*[F.lit(1 << b) for b in reversed(range((2 * parts).bit_length()))])
    reached = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(F.col("_splitters"), at + s - 1) <= F.col("_key"), at + s).otherwise(at))
    return agg.select("*", key.alias("_key"), splitters.alias("_splitters")).select(*agg.columns, reached.alias("_pid"))


def lag_by_range(agg: DataFrame, first: str, order: list[str], value: str, parts: int) -> DataFrame:
    """``agg`` plus ``_prev``: ``lag(value)`` within ``first`` in ``order``
    order, without a window whose partition holds a whole ``first`` group.

    The (unique-keyed) rows are dealt to ranges of all keys, so a hot
    ``first`` value is spread over several contiguous ranges of like size.
    The lag is taken inside each (range, first) group; the only rows that
    may need a value from an earlier range are the first row of each
    range. A table with one row per range (its first key; its last key
    and value) gives them that value: within each ``first`` value, the last
    range-end before the range-start. That table is bounded by the
    number of ranges, so it is broadcast back. Nothing runs while binding."""
    keys = [first] + order
    kind = agg.schema[value].dataType
    ranged = _range_number(agg.select(*keys, value), keys, parts)
    w_local = Window.partitionBy("_pid", first).orderBy(*order)
    local = ranged.withColumn("_prev", F.lag(value).over(w_local))
    ends = ranged.groupBy("_pid").agg(
        F.min(F.struct(*keys, F.col(value).alias("_v"))).alias("_lo"),
        F.max(F.struct(*keys, F.col(value).alias("_v"))).alias("_hi"))
    bounds = ends.select(F.inline(F.array(
        F.struct(*[F.col(f"_lo.{k}").alias(k) for k in keys], F.lit(0).alias("_kind"),
                 F.lit(None).cast(kind).alias("_v")),
        F.struct(*[F.col(f"_hi.{k}").alias(k) for k in keys], F.lit(1).alias("_kind"),
                 F.col("_hi._v").alias("_v")))))
    w_carry = Window.partitionBy(first).orderBy(*order, "_kind").rowsBetween(Window.unboundedPreceding, -1)
    carry = (bounds.withColumn("_carry", F.last("_v", ignorenulls=True).over(w_carry))
             .filter(F.col("_kind") == 0).select(*keys, "_carry"))
    out = local.join(F.broadcast(carry), keys, "left")
    return out.withColumn("_prev", F.coalesce(F.col("_prev"), F.col("_carry"))).drop("_carry", "_pid")


def trend(ts: TableSet, rule: Mapping) -> list[Outcome]:
    sheet, name = rule["sheet"], rule["name"]
    metric, previous = rule["metric"], rule["previousmetric"]
    op, threshold = rule["operator"], float(rule["threshold"])
    aggregate = bool(rule.get("aggregate", False))
    groups = list(rule.get("groupbycolumns", []))
    distinct = rule.get("distinctcolumn", DEFAULT_DISTINCT)
    t = ts.get(sheet)
    if t is None:
        return [missing_table(sheet, DATA_VALIDATION, TREND, field=name)]
    names = header_map(t.columns, underscored)
    required = [metric] + groups if aggregate else [metric, previous, distinct]
    missing = [c for c in required if c not in names]
    if missing:
        return [missing_columns(sheet, missing, DATA_VALIDATION, TREND)]

    def total(c):
        return group_sum(col(names[c]), t.dtype(names[c]))

    per_file = FILE in t.df.columns

    if aggregate:
        if len(groups) == 1:
            # one group column: every window partition holds a single row
            return [Outcome(sheet, name, DATA_VALIDATION, TREND, failed=0)]
        keys_ok = reduce(lambda a, b: a & b, [col(names[g]).isNotNull() for g in groups])
        keys = [col(names[g]).alias(f"_g{k}") for k, g in enumerate(groups)]
        if per_file:  # batch runs: the first group key becomes (file, key), so lags never cross files
            keys[0] = F.struct(F.col(FILE).alias("f"), col(names[groups[0]]).alias("k")).alias("_g0")
        agg = t.df.filter(keys_ok).groupBy(*keys).agg(
            total(metric).alias("_cur"))
        parts = int(ts.spark.conf.get("spark.sql.shuffle.partitions", "200"))
        lagged = lag_by_range(agg, "_g0", [f"_g{k}" for k in range(1, len(groups))], "_cur", parts)
        dev = pct_deviation(F.col("_cur"), F.col("_prev"))
        fail = dev.isNotNull() & apply_operator(dev, op, threshold)
        file_col = [F.col("_g0.f").alias(FILE)] if per_file else []
        counts = lagged.select(F.coalesce(fail, F.lit(False)).alias("_f"), *file_col).groupBy(
            *[F.col(FILE)] if per_file else []).agg(F.count_if("_f").alias("failed_count"))
    else:
        gcols = [distinct] + [c for c in PERIOD_COLUMNS if c in names]
        keys_ok = reduce(lambda a, b: a & b, [col(names[g]).isNotNull() for g in gcols])
        file_key = [F.col(FILE)] if per_file else []
        agg = t.df.filter(keys_ok).groupBy(*[col(names[g]) for g in gcols], *file_key).agg(
            total(metric).alias("_cur"),
            total(previous).alias("_prev"))
        dev = pct_deviation(F.col("_cur"), F.col("_prev"))
        fail = F.coalesce(dev.isNotNull() & apply_operator(dev, op, threshold), F.lit(False))
        counts = agg.groupBy(*file_key).agg(F.count_if(fail).alias("failed_count"))
    return [Outcome(sheet, name, DATA_VALIDATION, TREND, counts=counts)]
