"""Data-quality checks: duplicates, nulls, formulas, numeric precision.

Every function binds ONE rule to a TableSet and returns Outcome specs; see
``operators.base``. Column names are matched exactly (case-sensitive) unless
stated otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, IntegralType

from ..functions.formula import Value, differs_rounded, double, formula_value, holds, threshold_value, typed, whole
from ..functions.names import col, header_map, spaced, underscored
from ..functions.numbers import (
    RuleError,
    format_decimal_places,
    group_sum,
    is_number_type,
    raw_precision_fails,
    to_double,
)
from ..functions.text import is_blank_loose
from ..sources.tables import FILE, ROW_NO, TableSet
from .base import (
    DATA_QUALITY,
    DUPLICATE_CHECK,
    FORMULA_VALIDATION,
    NULL_CHECK,
    NUMERIC_PRECISION,
    ROWS,
    Grouped,
    Outcome,
    key_name,
    missing_columns,
    missing_table,
    sum_name,
)


def _unique(names):
    out = []
    for n in names:
        if n not in out:
            out.append(n)
    return out


def duplicate_check(ts: TableSet, rule: Mapping) -> list[Outcome]:
    """Rows that belong to a key group of size > 1 (all members counted).

    Rows whose keys are all NULL are ignored; NULL equals NULL otherwise.
    Fused with the other grouped rules of the table: partial counts per key
    map-side, one shuffle, global sum. A hot key is collapsed before it.
    """
    sheet, columns = rule["sheetname"], list(rule["columns"])
    t = ts.get(sheet)
    if t is None:
        return [missing_table(sheet, DATA_QUALITY, DUPLICATE_CHECK)]
    missing = [c for c in columns if c not in t.columns]
    if missing:
        return [missing_columns(sheet, missing, DATA_QUALITY, DUPLICATE_CHECK)]
    keys = tuple(_unique(columns))
    some_key = reduce(lambda a, b: a | b, [col(key_name(c)).isNotNull() for c in keys])
    # rows of groups with more than one member (in batch runs, within each file)
    addend = F.when(some_key & (F.col(ROWS) > 1), F.col(ROWS))
    return [Outcome(sheet, ", ".join(columns), DATA_QUALITY, DUPLICATE_CHECK, frame=t.df, grouped=Grouped(keys, {}, addend))]


def null_check(ts: TableSet, rule: Mapping) -> list[Outcome]:
    """Blank cells (NULL or whitespace-only) summed over the listed columns;
    every missing column adds 1. Row-local: fused into the table's scan."""
    sheet, columns = rule["sheetname"], list(rule["columns"])
    t = ts.get(sheet)
    if t is None:
        return [missing_table(sheet, DATA_QUALITY, NULL_CHECK)]
    present = [c for c in columns if c in t.columns]
    offset = len(columns) - len(present)
    field = ", ".join(columns)
    if not present:
        return [Outcome(sheet, field, DATA_QUALITY, NULL_CHECK, failed=offset)]
    weight = reduce(lambda a, b: a + b, [is_blank_loose(col(c)).cast("long") for c in present])
    return [Outcome(sheet, field, DATA_QUALITY, NULL_CHECK, frame=t.df, weight=weight, offset=offset)]


# --------------------------------------------------------------------------- formulas

def _formula_frame(ts: TableSet, sheet: str):
    t = ts.get(sheet)
    if t is None:
        return None, None
    return t, header_map(t.columns, underscored)


def _resolver(t, names: Mapping[str, str]):
    """Typed values of the rows' own columns."""
    def resolve(name: str) -> Value:
        return typed(col(names[name]), t.dtype(names[name]))
    return resolve


def _sums(t, names: Mapping[str, str]):
    """Typed values of a grouped frame: sums of whole numbers are whole again, those of decimals decimals."""
    def resolve(name: str, keys: frozenset[str] = frozenset()) -> Value:
        dtype = t.dtype(names[name])
        if name in keys:
            return typed(col(key_name(names[name])), dtype)
        c = col(sum_name(names[name]))
        if isinstance(dtype, (IntegralType, BooleanType)):
            return whole(c.try_cast("bigint"), c.cast("double"))
        if isinstance(dtype, DecimalType) and dtype.precision <= 28:
            return Value("decimal", c, c.cast("double"), (dtype.precision + 10, dtype.scale))
        return double(c)
    return resolve


def formula_rule(ts: TableSet, rule: Mapping, sheet: str = "KPI") -> list[Outcome]:
    """One formula rule on ``sheet`` (default ``KPI``).

    threshold:  value = formula; fails when value is not missing and NOT
                ``value <op> threshold`` (the operator is the pass condition;
                +-inf fails, 0/0 is missing and passes).
    comparison: ``round(formula, p) != round(target, p)`` (half-even, p=2);
                a missing value on either side fails.
    ``aggregate``: both work on ``groupby(groupbycolumns).sum()``.
    """
    name = rule["name"]
    sheet = rule.get("sheetname", sheet)
    t, names = _formula_frame(ts, sheet)
    if t is None:
        return [missing_table(sheet, DATA_QUALITY, FORMULA_VALIDATION)]
    vtype = str(rule["validationtype"]).lower()
    aggregate = bool(rule.get("aggregate", False))
    formula = rule["formula"]
    if vtype not in ("threshold", "comparison"):
        raise RuleError(f"Unsupported validation type: {vtype}")
    target = spaced(rule["targetcolumn"]) if vtype == "comparison" else None
    if aggregate:
        groups = [spaced(c) for c in rule["groupbycolumns"]]
        sources = [spaced(c) for c in (rule["sourcecolumns"] if target else rule.get("sourcecolumns", []))]
        frame, known, keys = t.df, _sums(t, names), frozenset(groups)
        made = {*groups, *sources, target} - {None}
        for c in made:
            if c not in names:
                raise KeyError(c)

        def resolve(name: str) -> Value:
            if name not in made:
                raise KeyError(name)
            return known(name, keys)
    else:
        if target is not None and target not in names:
            raise KeyError(target)
        frame, resolve = t.df, _resolver(t, names)
    value = formula_value(formula, resolve)
    if vtype == "threshold":
        passes = holds(value, rule["operator"], threshold_value(rule["threshold"])(value))
        fail = ~F.coalesce(passes, F.lit(True))  # a missing value passes
    else:
        p = int(rule.get("precision", 2))
        tgt = resolve(target)
        if tgt.kind == "text":
            tgt = double(to_double(col(names[target]), t.dtype(names[target])))
        fail = differs_rounded(value, tgt, p)
    if aggregate:  # groupby(keys).sum() as pandas does it: NULL keys dropped, the sum of an all-NULL group is 0
        there = reduce(lambda a, b: a & b, [col(key_name(names[g])).isNotNull() for g in groups])
        sums = {names[c]: (col(names[c]), partial(group_sum, dtype=t.dtype(names[c]))) for c in made - keys}
        grouped = Grouped(tuple(_unique(names[g] for g in groups)), sums, F.when(there & fail, F.lit(1)))
        from ..plans.planner import grouped_counts

        grouped_counts(frame, [grouped])  # analysed now, so that a bad rule fails alone
        return [Outcome(sheet, name, DATA_QUALITY, FORMULA_VALIDATION, frame=frame, grouped=grouped)]
    return [Outcome(sheet, name, DATA_QUALITY, FORMULA_VALIDATION, frame=frame, fail=fail)]


# --------------------------------------------------------------------------- precision

def numeric_precision(ts: TableSet, rule: Mapping) -> list[Outcome]:
    """Values showing more decimals than ``precision``, one result per column.

    Without a cell-format sidecar (or ``usecellformat: false``) every
    non-NULL value is tested on its raw value (text that parses as a number
    included). With a sidecar, only numeric cells are tested: a cell whose
    format fixes its decimals fails when those exceed the precision; cells
    without a fixed format fall back to the raw test. The sidecar is joined
    once per table (one shuffle) and all columns share that pass.
    """
    sheet = rule["sheetname"]
    p = int(rule["precision"])
    use_format = bool(rule.get("usecellformat", True))
    t = ts.get(sheet)
    if t is None:
        return [missing_table(sheet, DATA_QUALITY, NUMERIC_PRECISION)]
    if rule["columns"] == "ALL_NUMERIC_COLUMNS":
        columns = [f.name for f in t.schema.fields if is_number_type(f.dataType)]
    else:
        columns = list(rule["columns"])
    if not columns:
        return [Outcome(sheet, "Numeric Columns", DATA_QUALITY, NUMERIC_PRECISION, failed=1)]
    formats = ts.formats_for(sheet) if use_format else None
    present = [c for c in columns if c in t.columns]
    frame = t.df
    fmt_cols: dict[str, Column] = {}
    if formats is not None and present:
        wanted = _unique(present)
        # a sidecar with a ``file`` column addresses rows per file (batches)
        by_file = "file" in formats.columns
        keys = [F.col("row_no").alias("_fmt_row")] + ([F.col("file").alias("_fmt_file")] if by_file else [])
        wide = formats.filter(F.col("field").isin(wanted)).groupBy(*keys).agg(
            *[F.max(F.when(F.col("field") == c, F.col("number_format"))).alias(f"_fmt{k}") for k, c in enumerate(wanted)]
        )
        cond = F.col(ROW_NO) == F.col("_fmt_row")
        if by_file:
            cond = cond & (F.col(FILE) == F.col("_fmt_file"))
        frame = t.ordered().join(wide, cond, "left")
        fmt_cols = {c: F.col(f"_fmt{k}") for k, c in enumerate(wanted)}
    out = []
    for c in columns:
        if c not in t.columns:
            out.append(missing_columns(sheet, [c], DATA_QUALITY, NUMERIC_PRECISION))
            continue
        dtype = t.dtype(c)
        if c in fmt_cols:
            if not is_number_type(dtype) and dtype.typeName() != "boolean":
                fail = F.lit(False)  # text cells are skipped when formats are known
            else:
                v = col(c).cast("double")
                places = format_decimal_places(fmt_cols[c])
                fail = v.isNotNull() & F.when(places.isNotNull(), places > p).otherwise(raw_precision_fails(v, p))
        else:
            fail = raw_precision_fails(to_double(col(c), dtype, python_float=True), p)
        out.append(Outcome(sheet, c, DATA_QUALITY, NUMERIC_PRECISION, frame=frame, fail=F.coalesce(fail, F.lit(False))))
    return out
