"""Table and column existence (C1, C2, C19, C20).

These depend on schema metadata only, so they resolve on the driver without
running a job and come out as literal outcomes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from ..functions.names import loose
from ..sources.tables import TableSet
from .base import (
    FIELD_EXISTENCE,
    FIELD_VALIDATION,
    SHEET_EXISTENCE,
    SHEET_VALIDATION,
    Outcome,
    missing_table,
)


def table_list(ts: TableSet, expected: Iterable[str]) -> list[Outcome]:
    """One row per expected table name: exact match, P/F."""
    return [
        Outcome(name, "Sheet", SHEET_VALIDATION, SHEET_EXISTENCE, failed=0 if name in ts else 1)
        for name in expected
    ]


def table_columns(ts: TableSet, spec: Mapping[str, Mapping]) -> list[Outcome]:
    """``{table: {"fields": [{"name": ..}, ..]}}``: loose name match
    (strip, lower, no spaces/underscores); a missing table gives one row."""
    out: list[Outcome] = []
    for sheet, info in spec.items():
        t = ts.get(sheet)
        if t is None:
            out.append(missing_table(sheet, FIELD_VALIDATION, FIELD_EXISTENCE, field="Field"))
            continue
        have = {loose(c) for c in t.columns}
        for f in info["fields"]:
            out.append(Outcome(sheet, f["name"], FIELD_VALIDATION, FIELD_EXISTENCE,
                               failed=0 if loose(f["name"]) in have else 1))
    return out


def required_tables(ts: TableSet, sheet_checks: Mapping[str, Mapping]) -> tuple[list[Outcome], set[str]]:
    """PASS if present; FAIL if absent and required (default); SKIPPED if
    absent and optional. Also returns the missing required names."""
    out, missing = [], set()
    for sheet, rules in sheet_checks.items():
        required = (rules or {}).get("required", True)
        if sheet in ts:
            out.append(Outcome(sheet, "Sheet", SHEET_VALIDATION, SHEET_EXISTENCE, failed=0, status="PASS"))
        elif required:
            missing.add(sheet)
            out.append(Outcome(sheet, "Sheet", SHEET_VALIDATION, SHEET_EXISTENCE, failed=1, status="FAIL"))
        else:
            out.append(Outcome(sheet, "Sheet", SHEET_VALIDATION, SHEET_EXISTENCE, failed=0, status="SKIPPED"))
    return out, missing


def field_existence(ts: TableSet, fields: Mapping[str, Mapping], missing_tables: set[str]) -> tuple[list[Outcome], dict]:
    """Exact column names; tables that are absent are skipped."""
    out, missing = [], {}
    for sheet, field_map in fields.items():
        if sheet in missing_tables or sheet not in ts:
            continue
        cols = set(ts.get(sheet).columns)
        for c in field_map:
            ok = c in cols
            if not ok:
                missing.setdefault(sheet, set()).add(c)
            out.append(Outcome(sheet, c, FIELD_VALIDATION, FIELD_EXISTENCE, failed=0 if ok else 1,
                               status="PASS" if ok else "FAIL"))
    return out, missing
