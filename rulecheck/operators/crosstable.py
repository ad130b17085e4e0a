"""Checks across two tables: reconciliation (C12), value comparison (C13),
key existence (C14).

All three reduce each side to ONE row per key with a partial (map-side)
aggregate, then full-outer-join the reduced sides on the key. Both sides are
hash-partitioned on the key by their own aggregate, so the join adds no
further shuffle, never fans out, and a hot key is collapsed before it moves.

Where the tables hold several inputs, the input is a further leading key of
both sides and the failing keys are counted for each input.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import functions as F

from ..functions.names import col, header_map, lowered, spaced
from ..functions.numbers import RuleError, difference, group_sum
from ..functions.text import aligned_keys, key_text, norm_text
from ..sources.tables import FILE, TableSet
from .base import (
    CROSS_SHEET,
    DATA_VALIDATION,
    RECONCILIATION,
    Outcome,
    missing_columns,
    missing_table,
)


def input_key(ts: TableSet) -> list[str]:
    """The leading key of both sides where the tables hold several inputs."""
    return [FILE] if ts.paired else []


def reconciliation(ts: TableSet, rule: Mapping) -> list[Outcome]:
    """Per match key: |sum(source) - sum(target)| > tolerance fails.

    Values are made numeric (unparsable -> 0) before summing; keys with a
    NULL part are dropped (group-by); a key present on one side only
    compares with 0. Failing keys are counted distinct on ``distinctcolumn``
    when it is one of the output columns, else each failing key counts.
    """
    name = rule["name"]
    src_sheet, tgt_sheet = rule["sourcesheet"], rule["targetsheet"]
    match = [spaced(c) for c in rule["matchcolumns"]]
    src_col, tgt_col = spaced(rule["sourcecolumn"]), spaced(rule["targetcolumn"])
    distinct = spaced(rule["distinctcolumn"])
    tol = float(rule.get("tolerance", 0.01))
    s, t = ts.get(src_sheet), ts.get(tgt_sheet)
    if s is None:
        return [missing_table(src_sheet, DATA_VALIDATION, RECONCILIATION, field="Source Sheet")]
    if t is None:
        return [missing_table(tgt_sheet, DATA_VALIDATION, RECONCILIATION, field="Target Sheet")]
    sn, tn = header_map(s.columns, spaced), header_map(t.columns, spaced)
    miss = [c for c in match if c not in sn or c not in tn]
    if miss:
        return [missing_columns(src_sheet, miss, DATA_VALIDATION, RECONCILIATION)]
    if src_col not in sn:
        return [missing_columns(src_sheet, [src_col], DATA_VALIDATION, RECONCILIATION)]
    if tgt_col not in tn:
        return [missing_columns(tgt_sheet, [tgt_col], DATA_VALIDATION, RECONCILIATION)]

    own = input_key(ts)
    aligned = {m: aligned_keys(col(sn[m]), s.dtype(sn[m]), col(tn[m]), t.dtype(tn[m])) for m in match}

    def side(tab, names, value_col, alias):
        keys_ok = reduce(lambda a, b: a & b, [col(names[m]).isNotNull() for m in match])
        return tab.df.filter(keys_ok).groupBy(*own, *[aligned[m][alias == "_tgt"].alias(m) for m in match]).agg(
            group_sum(col(names[value_col]), tab.dtype(names[value_col])).alias(alias))

    merged = side(s, sn, src_col, "_src").join(side(t, tn, tgt_col, "_tgt"), on=[*own, *match], how="full_outer")
    diff = F.abs(difference(F.coalesce(F.col("_src"), F.lit(0)), F.coalesce(F.col("_tgt"), F.lit(0))))
    failing = merged.select(*own, *[col(m) for m in match], F.col("_src"), F.col("_tgt"), (diff > F.lit(tol)).alias("_fail"))
    if distinct in match:
        counts = (failing.filter("_fail").select(*own, col(distinct)).distinct()
                  .groupBy(*own).agg(F.count(F.lit(1)).alias("failed_count")))
    elif distinct in (src_col, tgt_col):
        value = F.coalesce(F.col("_src" if distinct == src_col else "_tgt"), F.lit(0))
        counts = failing.filter("_fail").select(*own, value.alias("_v")).distinct().groupBy(*own).agg(F.count(F.lit(1)).alias("failed_count"))
    else:
        counts = failing.groupBy(*own).agg(F.count_if(F.col("_fail")).alias("failed_count"))
    return [Outcome(src_sheet, name, DATA_VALIDATION, RECONCILIATION, counts=counts)]


def cross_sheet(ts: TableSet, rule: Mapping) -> list[Outcome]:
    """``valuecomparison``: the first source row per key vs every target row
    with that key (normalised text); a key on one side only compares with ''.
    Counts distinct failing keys.
    ``existencecheck``: keys (trimmed text, NULLs dropped) on exactly one side.
    Column names match after strip + lower."""
    name = rule.get("name")
    src_sheet, tgt_sheet = rule.get("sourcesheet"), rule.get("targetsheet")
    vtype = rule.get("validationtype")
    drop_null = bool(rule.get("dropnullkeys", True))
    s, t = ts.get(src_sheet), ts.get(tgt_sheet)
    if s is None:
        return [missing_table(src_sheet, DATA_VALIDATION, CROSS_SHEET, field="Source Sheet")]
    if t is None:
        return [missing_table(tgt_sheet, DATA_VALIDATION, CROSS_SHEET, field="Target Sheet")]
    sn, tn = header_map(s.columns, lowered), header_map(t.columns, lowered)
    key = lowered(rule.get("matchcolumn"))
    if key not in sn or key not in tn:
        side = src_sheet if key not in sn else tgt_sheet
        return [missing_columns(side, [key], DATA_VALIDATION, CROSS_SHEET)]
    sk, tk = col(sn[key]), col(tn[key])
    own = input_key(ts)

    if vtype == "valuecomparison":
        sc, tc = lowered(rule.get("sourcecolumn")), lowered(rule.get("targetcolumn"))
        miss = [c for c, names in ((sc, sn), (tc, tn)) if c not in names]
        if miss:
            return [missing_columns(src_sheet, miss, DATA_VALIDATION, CROSS_SHEET)]
        src = s.ordered()
        tgt = t.df
        if drop_null:
            src, tgt = src.filter(sk.isNotNull()), tgt.filter(tk.isNotNull())
        order = F.struct(*s.row_order())
        s_key, t_key = aligned_keys(sk, s.dtype(sn[key]), tk, t.dtype(tn[key]))
        first = src.groupBy(*own, s_key.alias("_k")).agg(
            F.min_by(norm_text(col(sn[sc])), order).alias("_s"), F.lit(True).alias("_hs"))
        tv = norm_text(col(tn[tc]))
        tagg = tgt.groupBy(*[F.col(c).alias(f"{c}_t") for c in own], t_key.alias("_tk")).agg(F.min(tv).alias("_tmin"), F.max(tv).alias("_tmax"))
        cond = (F.col("_k") == F.col("_tk")) if drop_null else F.col("_k").eqNullSafe(F.col("_tk"))
        cond = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"{c}_t") for c in own], cond)
        joined = first.join(tagg, cond, "full_outer")
        both = F.col("_hs").isNotNull() & F.col("_tmin").isNotNull()
        fail = (
            F.when(both, ~((F.col("_tmin") == F.col("_tmax")) & (F.col("_tmin") == F.col("_s"))))
            .when(F.col("_hs").isNotNull(), F.col("_s") != F.lit(""))
            .otherwise(F.col("_tmax") != F.lit(""))
        )
        counts = joined.groupBy(*[F.coalesce(c, f"{c}_t").alias(c) for c in own]).agg(F.count_if(fail).alias("failed_count"))
    elif vtype == "existencecheck":
        a = s.df.filter(sk.isNotNull()).groupBy(*own, key_text(sk).alias("_k")).agg(F.lit(True).alias("_a"))
        b = t.df.filter(tk.isNotNull()).groupBy(*own, key_text(tk).alias("_k")).agg(F.lit(True).alias("_b"))
        joined = a.join(b, [*own, "_k"], "full_outer")
        counts = joined.groupBy(*own).agg(F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("failed_count"))
    else:
        raise RuleError(f"Unsupported cross-sheet validation type: {vtype}")
    return [Outcome(src_sheet, name, DATA_VALIDATION, CROSS_SHEET, counts=counts)]

