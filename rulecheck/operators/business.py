"""Business rules: two-column comparison, stale data, lookup match.

``comparison`` and ``staledata`` are row-local (fused into the table scan);
with ``distinctcolumn`` they count distinct keys among failing rows.
``lookupmatch`` needs a join; both sides are first reduced to one row per key
(min/max of the normalised value) so the join never fans out and a hot key
is collapsed map-side before any shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.date_formats import column_form, first_texts, form_of, parse_column
from ..functions.dates import stale_cutoff, to_timestamp_lenient
from ..functions.names import col
from ..functions.numbers import RuleError, apply_operator, to_double
from ..functions.text import aligned_keys, is_blank_norm, norm_text
from ..sources.tables import FILE, TableSet
from .base import BUSINESS_RULE, DATA_VALIDATION, Outcome, failed_rule, missing_columns, missing_table

_PRIMARY_KEYS = ("leftcolumn", "column", "referencecolumn", "distinctcolumn", "lookupkeyleft")


def business_rule(ts: TableSet, rule: Mapping, as_of: _dt.date | str | None = None,
                  date_formats=None) -> list[Outcome]:
    name, sheet, rtype = rule["name"], rule["sheetname"], rule.get("type")
    t = ts.get(sheet)
    if t is None:
        return [missing_table(sheet, DATA_VALIDATION, BUSINESS_RULE, field=name)]
    primary = [rule[k] for k in _PRIMARY_KEYS if k in rule]
    if rtype != "lookupmatch" and "rightcolumn" in rule:
        primary.append(rule["rightcolumn"])
    missing = [c for c in primary if c not in t.columns]
    if missing:
        return [missing_columns(sheet, missing, DATA_VALIDATION, BUSINESS_RULE)]
    distinct = rule.get("distinctcolumn") or None
    date_formats = rule.get("dateformats") or date_formats
    if rtype == "comparison":
        fail = _comparison_fail(t, rule, date_formats)
        return [Outcome(sheet, name, DATA_VALIDATION, BUSINESS_RULE, frame=t.df, fail=fail, distinct=distinct)]
    if rtype == "staledata":
        frame, form = _column_form(t, rule["column"], date_formats)
        fail = _stale_fail(t, rule, as_of, date_formats, form)
        return [Outcome(sheet, name, DATA_VALIDATION, BUSINESS_RULE, frame=frame, fail=fail, distinct=distinct)]
    if rtype == "lookupmatch":
        counts = _lookup_counts(ts, t, rule)
        if counts is None:
            return [failed_rule(sheet, name, DATA_VALIDATION, BUSINESS_RULE)]
        return [Outcome(sheet, name, DATA_VALIDATION, BUSINESS_RULE, counts=counts)]
    raise RuleError(f"Unsupported business rule type: {rtype}")


def _parse(t, c: str, datatype: str, date_formats, form=None):
    dtype = t.dtype(c)
    if datatype == "date" and isinstance(dtype, StringType) and not date_formats:
        return parse_column(c, form)
    if datatype == "date":
        return to_timestamp_lenient(col(c), dtype, date_formats)
    return to_double(col(c), dtype)


def _column_form(t, c: str, date_formats):
    """(frame, form): a text column is read in the form of its first value in
    row order - a scalar subquery, so the rule shares its table's scan; in
    batch runs every file has its own, joined by file. None (every text in
    its own form): no text, formats are given, or the rows have no known order."""
    if date_formats or not isinstance(t.dtype(c), StringType) or not t.has_row_numbers():
        return t.df, None
    rows = t.ordered()
    order = t.row_order()
    if FILE not in t.df.columns:
        return t.df, column_form(rows, col(c), order)
    forms = first_texts(rows, col(c), order, [F.col(FILE).alias("_form_file")]).select("_form_file", form_of(F.col("first")).alias("_form"))
    frame = t.df.join(forms, F.col(FILE).eqNullSafe(F.col("_form_file")), "left").drop("_form_file")
    return frame, F.col("_form")


def _comparison_fail(t, rule: Mapping, date_formats):
    """Fails when either side is blank, either side does not parse, or
    NOT ``left <op> right`` (the operator is the pass condition)."""
    left, right, op = rule["leftcolumn"], rule["rightcolumn"], rule["operator"]
    datatype = rule.get("datatype", "date")
    blanks = rule.get("blankindicators", [])
    lb = is_blank_norm(col(left), t.dtype(left), blanks)
    rb = is_blank_norm(col(right), t.dtype(right), blanks)
    lv, rv = _parse(t, left, datatype, date_formats), _parse(t, right, datatype, date_formats)
    holds = F.coalesce(apply_operator(lv, op, rv), F.lit(False))  # a side that does not parse is NULL
    return lb | rb | ~holds


def _stale_fail(t, rule: Mapping, as_of, date_formats, form):
    """A parsable date older than (as_of - months) whose text is not blank."""
    c = rule["column"]
    blanks = rule.get("blankindicators", [])
    parsed = _parse(t, c, "date", date_formats, form)
    shown = ~is_blank_norm(col(c), t.dtype(c), blanks)
    return shown & F.coalesce(parsed < stale_cutoff(int(rule["months"]), as_of), F.lit(False))


def _lookup_counts(ts: TableSet, t, rule: Mapping):
    """Distinct left keys whose value differs (normalised text) from a
    looked-up value. Unmatched keys compare with '' (blank left passes).
    Returns None when the lookup table or its columns are missing."""
    lk, rk = rule["lookupkeyleft"], rule["lookupkeyright"]
    left_col, right_col = rule["leftcolumn"], rule["rightcolumn"]
    lookup = ts.get(rule["lookupsheet"])
    if lookup is None or rk not in lookup.columns or right_col not in lookup.columns:
        return None
    drop_null = bool(rule.get("dropnullkeys", True))
    left_key, right_key = aligned_keys(col(lk), t.dtype(lk), col(rk), lookup.dtype(rk))
    left = t.df
    if drop_null:
        left = left.filter(col(lk).isNotNull())
    lv = norm_text(col(left_col))
    per_file = [F.col(FILE)] if FILE in left.columns else []  # batch runs: the left table per file
    left_agg = left.groupBy(left_key.alias("_k"), *per_file).agg(F.min(lv).alias("_lmin"), F.max(lv).alias("_lmax"))
    rv = norm_text(col(right_col))
    right = lookup.df
    if drop_null:
        right = right.filter(col(rk).isNotNull())
    pair = [F.col(FILE).alias("_rfile")] if ts.paired else []  # several inputs: each looks up in its own table
    right_agg = right.groupBy(*pair, right_key.alias("_rk")).agg(F.min(rv).alias("_rmin"), F.max(rv).alias("_rmax"))
    cond = F.col("_k") == F.col("_rk") if drop_null else F.col("_k").eqNullSafe(F.col("_rk"))
    if pair:
        cond = cond & (F.col(FILE) == F.col("_rfile"))
    joined = left_agg.join(right_agg, cond, "left")
    matched = F.col("_rmin").isNotNull()
    same = (F.col("_lmin") == F.col("_lmax")) & (F.col("_lmin") == F.col("_rmin")) & (F.col("_rmin") == F.col("_rmax"))
    fail = F.when(matched, ~same).otherwise(F.col("_lmax") != F.lit(""))
    return joined.groupBy(*per_file).agg(F.count_if(fail).alias("failed_count"))
