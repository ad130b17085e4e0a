"""Check inference (C23-C25): which cell check fits each column.

Every configured check is tried on every non-blank value of a column; in the
fixed priority order the first check whose match rate reaches the threshold
wins, else the column is "Unrecognized (best match x%)" or "(no data)". The
counts are one plain aggregate over the table (``full_stats``).

A caller may ask for the first N non-blank values in row order instead
(``sample_size``), two small jobs per table:
1. count non-blank cells per column per (file, block of 2^20 rows) - a plain
   map-side aggregate, no sort - and, with a running sum over the blocks,
   find for each column the block holding its N-th non-blank value;
2. over the rows up to those blocks only, explode one small typed payload
   per non-blank cell (text / number / timestamp form), keep
   ``row_number() <= N`` per column in row order (Spark puts a partial
   WindowGroupLimit before the shuffle, so each task ships at most N rows per
   column), then evaluate the checks on the sampled payloads and count per
   column.
The result has one row per column; it is brought to the driver to pick the
check that phase 2 of the run applies to all rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from ..functions.cells import INFERENCE_PRIORITY, check_passes
from ..functions.names import col
from ..functions.text import is_blank_cell
from ..sources.tables import FILE, ROW_NO, TableSet
from ..plans import COUNTERS_PER_PASS
from .base import RULE_DETERMINATION, UNRECOGNIZED, Outcome

DEFAULT_MATCH_THRESHOLD = 0.6
DEFAULT_SAMPLE_SIZE = None  # every non-blank value


def candidate_checks(column_checks: Mapping) -> list[str]:
    return [n for n in INFERENCE_PRIORITY if n in column_checks]


def _proxy(check: str, dtype):
    """Which payload field (and type) a check reads for a column of ``dtype``."""
    if isinstance(dtype, (NumericType, BooleanType)) and check in ("amount", "number"):
        return "d", DoubleType()
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)) and check in ("date", "amount", "number"):
        return "t", TimestampNTZType()
    return "s", StringType()


BLOCK_ROWS = 1 << 20


def _block_key(block_rows: int):
    return F.struct(F.coalesce(F.col(FILE), F.lit("")).alias("f"),
                    F.floor(F.col(ROW_NO) / F.lit(block_rows)).alias("b"))


def _cutoff_frame(frame: DataFrame, nonblank: list, sample_size: int, block_rows: int) -> DataFrame:
    per_block = frame.groupBy(_block_key(block_rows).alias("k")).agg(
        *[F.count_if(nb).alias(f"n{i}") for i, nb in enumerate(nonblank)])
    long = per_block.select("k", F.inline(F.array(
        *[F.struct(F.lit(i).alias("ci"), F.col(f"n{i}").alias("n")) for i in range(len(nonblank))])))
    w = Window.partitionBy("ci").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    needed = long.filter(F.col("n") > 0).withColumn("cum", F.sum("n").over(w)).filter(
        F.col("cum") - F.col("n") < F.lit(int(sample_size)))
    return needed.groupBy("ci").agg(F.max("k").alias("cut"))


def sample_cutoffs(frame: DataFrame, nonblank: list, sample_size: int, block_rows: int = BLOCK_ROWS) -> dict:
    """Per column index, the (file, row block) that holds its N-th non-blank
    value in row order (or its last one): blocks after it cannot be sampled.

    Counting non-blank cells per (file, block) is a plain aggregate (partial
    map-side, one row per block); a running sum over blocks per column then
    finds the cut-off. Only one row per column reaches the driver."""
    rows = _cutoff_frame(frame, nonblank, sample_size, block_rows).collect()
    return {r["ci"]: (r["cut"]["f"], r["cut"]["b"]) for r in rows}


def _nonblank(t) -> list:
    return [~is_blank_cell(col(name), t.dtype(name)) for name in t.columns]


def cutoffs_for(ts: TableSet, sheets: list[str], sample_size: int, block_rows: int = BLOCK_ROWS) -> dict:
    """``sample_cutoffs`` for several tables in ONE job: ``{sheet: {ci: cut}}``."""
    parts = [
        _cutoff_frame(ts.get(s).ordered(), _nonblank(ts.get(s)), sample_size, block_rows)
        .select(F.lit(k).alias("ti"), "ci", "cut")
        for k, s in enumerate(sheets)
    ]
    out: dict[str, dict] = {s: {} for s in sheets}
    if not parts:
        return out
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    for r in union.collect():
        out[sheets[r["ti"]]][r["ci"]] = (r["cut"]["f"], r["cut"]["b"])
    return out


def sample_stats(ts: TableSet, sheet: str, column_checks: Mapping, sample_size: int,
                 block_rows: int = BLOCK_ROWS, cuts: dict | None = None) -> DataFrame:
    """``(ci, sampled, m0..mk)``: per column index, the sample size and the
    number of sampled values passing each candidate check.

    Pass 1 (``sample_cutoffs``) bounds, per column, how far into the table
    its sample can reach. Pass 2 explodes one small typed payload per
    non-blank cell of the rows before that bound (text / number / timestamp
    form), keeps the first N per column in row order and only then runs the
    checks on the sampled payloads."""
    t = ts.get(sheet)
    checks = candidate_checks(column_checks)
    frame = t.ordered()
    dtypes = [t.dtype(name) for name in t.columns]
    nonblank = _nonblank(t)
    if cuts is None:
        cuts = sample_cutoffs(frame, nonblank, sample_size, block_rows)
    key = _block_key(block_rows)
    structs = []
    for i, name in enumerate(t.columns):
        if i not in cuts:
            continue  # no non-blank value at all
        dtype = dtypes[i]
        c = col(name)
        is_num = isinstance(dtype, (NumericType, BooleanType))
        is_time = isinstance(dtype, (DateType, TimestampType, TimestampNTZType))
        f, b = cuts[i]
        within = key <= F.struct(F.lit(f).alias("f"), F.lit(b).cast("long").alias("b"))
        kind = 1 if is_num else 2 if is_time else 0
        structs.append(F.struct(
            F.lit(i).alias("ci"),
            F.lit(kind).alias("kind"),
            (nonblank[i] & within).alias("nb"),
            c.cast("string").alias("s"),
            (c.cast("double") if is_num else F.lit(None).cast("double")).alias("d"),
            (c.cast("timestamp_ntz") if is_time else F.lit(None).cast("timestamp_ntz")).alias("t"),
        ))
    if not structs:
        return ts.spark.createDataFrame([], "ci int, sampled long, " + ", ".join(f"m{k} long" for k in range(len(checks))))
    f_max, b_max = max(cuts.values())
    prefix = frame.filter(key <= F.struct(F.lit(f_max).alias("f"), F.lit(b_max).cast("long").alias("b")))
    long = prefix.select(F.col(FILE).alias("_f"), F.col(ROW_NO).alias("_r"), F.inline(F.array(*structs))).filter("nb")
    w = Window.partitionBy("ci").orderBy("_f", "_r")
    sample = long.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= int(sample_size))
    # a check reads the payload field of the column's type class: evaluate it
    # once per class present (at most three variants), not once per column
    kinds = {}
    for i, dtype in enumerate(dtypes):
        if i in cuts:
            is_num = isinstance(dtype, (NumericType, BooleanType))
            is_time = isinstance(dtype, (DateType, TimestampType, TimestampNTZType))
            kinds[1 if is_num else 2 if is_time else 0] = dtype
    flags = []
    for k, n in enumerate(checks):
        per_kind = F.lit(False)
        for kind, dtype in kinds.items():
            field, ftype = _proxy(n, dtype)
            per_kind = F.when(F.col("kind") == kind, check_passes(n, F.col(field), ftype, column_checks[n])) \
                .otherwise(per_kind)
        flags.append(F.count_if(per_kind).alias(f"m{k}"))
    return sample.groupBy("ci").agg(F.count(F.lit(1)).alias("sampled"), *flags)


def full_stats(ts: TableSet, sheet: str, column_checks: Mapping) -> DataFrame:
    """``(ci, sampled, rows, m0..mk)`` over all rows (``rows``: of the table): one ``count_if`` per (column, check) in plain aggregates, a few columns
    to each so that they stay inside generated code; no order, no shuffle of rows."""
    t = ts.get(sheet)
    checks = candidate_checks(column_checks)
    some = max(1, COUNTERS_PER_PASS // (len(checks) + 1))
    parts = []
    for first in range(0, len(t.columns), some):
        aggs, structs = [], []
        for i, name in enumerate(t.columns[first:first + some], first):
            there = ~is_blank_cell(col(name), t.dtype(name))
            if i == first:
                aggs.append(F.count(F.lit(1)).alias("_rows"))
            aggs.append(F.count_if(there).alias(f"n{i}"))
            aggs += [F.count_if(there & check_passes(n, col(name), t.dtype(name), column_checks[n])).alias(f"m{i}_{k}") for k, n in enumerate(checks)]
            structs.append(F.struct(F.lit(i).alias("ci"), F.col(f"n{i}").alias("sampled"), F.col("_rows").alias("rows"), *[F.col(f"m{i}_{k}").alias(f"m{k}") for k in range(len(checks))]))
        parts.append(t.df.agg(*aggs).select(F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, parts)


def decide(sampled: int, matches: list[int], checks: list[str], threshold: float):
    """(check or None, rate, sampled) exactly as the priority rule reads."""
    if not sampled:
        return None, 0.0, 0
    best = 0.0
    for name, m in zip(checks, matches):
        rate = m / sampled
        if rate >= threshold:
            return name, rate, sampled
        best = max(best, rate)
    return None, best, sampled


def infer_rules(ts: TableSet, sheets: list[str], column_checks: Mapping, threshold: float = DEFAULT_MATCH_THRESHOLD,
                sample_size: int | None = DEFAULT_SAMPLE_SIZE,
                counted: dict[str, dict] | None = None) -> tuple[list[Outcome], dict[str, dict[str, str]]]:
    """Rule-determination outcomes and ``{table: {column: check}}``. Where all values were tried, ``counted`` receives
    ``{table: {None: rows, column: (values, values that pass its check)}}``: the check's own result."""
    checks = candidate_checks(column_checks)
    outcomes: list[Outcome] = []
    rules: dict[str, dict[str, str]] = {}
    sheets = [s for s in sheets if ts.get(s) is not None and ts.get(s).columns]
    if sample_size is None:
        stated = [full_stats(ts, s, column_checks) for s in sheets]
    else:  # two jobs for all tables: the cut-offs, then the samples
        cuts = cutoffs_for(ts, sheets, sample_size)
        stated = [sample_stats(ts, s, column_checks, sample_size, cuts=cuts[s]) for s in sheets]
    parts = [p.select(F.lit(k).alias("ti"), "*") for k, p in enumerate(stated)]
    stats: dict[str, dict] = {s: {} for s in sheets}
    if parts:
        union = parts[0]
        for p in parts[1:]:
            union = union.unionByName(p)
        for r in union.collect():
            stats[sheets[r["ti"]]][r["ci"]] = r
    for sheet in sheets:
        t = ts.get(sheet)
        got = stats[sheet]
        for i, name in enumerate(t.columns):
            r = got.get(i)
            sampled = r["sampled"] if r else 0
            matches = [r[f"m{k}"] for k in range(len(checks))] if r else []
            rule, rate, n = decide(sampled, matches, checks, threshold)
            if counted is not None and sample_size is None and r:
                own = counted.setdefault(sheet, {None: r["rows"]})
                if rule is not None:
                    own[name] = (n, matches[checks.index(rule)])
            if rule is not None:
                rules.setdefault(sheet, {})[name] = rule
                outcomes.append(Outcome(sheet, name, RULE_DETERMINATION, rule, failed=0, status="PASS"))
            elif n == 0:
                outcomes.append(Outcome(sheet, name, RULE_DETERMINATION, f"{UNRECOGNIZED} (no data)",
                                        failed=0, status="SKIPPED"))
            else:
                outcomes.append(Outcome(sheet, name, RULE_DETERMINATION, f"{UNRECOGNIZED} (best match {rate:.0%})",
                                        failed=0, status="SKIPPED"))
    return outcomes, rules
