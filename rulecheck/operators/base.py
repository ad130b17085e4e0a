"""Check outcomes: what a bound rule contributes to the summary.

A check never runs anything itself. Binding a rule to a TableSet (driver side,
schema metadata only) yields one or more ``Outcome`` specs:

* literal   - the result is known from metadata (missing table/column, table
              existence, configuration errors): ``failed`` is set;
* row-local - a per-row failure predicate ``fail`` over ``frame``; all
              row-local outcomes over the same frame are fused by the planner
              into ONE aggregate (one scan) per table and distinct column;
* grouped   - a count over groups of ``frame``'s rows; all of one frame are
              fused into one aggregate over grouping sets;
* counts    - a one-row DataFrame with a ``failed_count`` column, for checks
              that need their own shuffle (joins, windows).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

# Result labels (test type, test name) of each check family.
SHEET_VALIDATION = "Sheet Validation"
SHEET_EXISTENCE = "Sheet Existence Testing"
FIELD_VALIDATION = "Field Validation"
FIELD_EXISTENCE = "Field Existence Testing"
DATA_QUALITY = "Data Quality Validation"
DUPLICATE_CHECK = "Duplicate Check"
NULL_CHECK = "Null Check"
FORMULA_VALIDATION = "Formula Validation"
NUMERIC_PRECISION = "Numeric Precision"
DATA_VALIDATION = "Data Validation"
BUSINESS_RULE = "Business Rule Validation"
RECONCILIATION = "Reconciliation Validation"
CROSS_SHEET = "Cross Sheet Validation"
TREND = "Trend Validation"
CONFIGURATION = "Configuration Validation"
RULE_DETERMINATION = "Rule Determination"
UNRECOGNIZED = "Unrecognized"


@dataclass(frozen=True)
class Grouped:
    """A rule over groups of a table's rows: ``keys`` (physical columns) make
    the groups, ``sums`` (physical columns) are summed in each, and every
    group adds ``addend`` to the failed count. The addend is a Column over
    ``key_name(c)``, ``sum_name(c)`` and ``ROWS``. All grouped rules of a
    frame share one scan and one exchange (planner)."""

    keys: tuple[str, ...]
    sums: dict[str, tuple[Column, Callable[[Column], Column]]]  # column -> (what is summed, its sum)
    addend: Column


ROWS = "_rows"


def key_name(c: str) -> str:
    return f"_k:{c}"


def sum_name(c: str) -> str:
    return f"_s:{c}"


@dataclass
class Outcome:
    sheet_name: str
    field: str
    test_type: str
    test_name: str
    # literal result
    failed: int | None = None
    status: str | None = None
    total: int | None = None
    # row-local result (fused per frame)
    frame: DataFrame | None = None
    fail: Column | None = None
    weight: Column | None = None
    offset: int = 0
    checked: Column | None = None
    distinct: str | None = None
    # result over groups of the frame's rows (fused per frame)
    grouped: Grouped | None = None
    # precomputed one-row result with column ``failed_count``
    counts: DataFrame | None = None
    # text for the details report
    params: str | None = None
    # replacement outcome if the plan fails to analyse (set by the engine)
    on_error: object | None = None

    @property
    def kind(self) -> str:
        if self.counts is not None:
            return "counts"
        if self.grouped is not None:
            return "grouped"
        if self.fail is not None or self.weight is not None:
            return "rowlocal"
        return "literal"


def missing_table(sheet: str, test_type: str, test_name: str, field: str = "Sheet") -> Outcome:
    return Outcome(sheet, field, test_type, test_name, failed=1)


def missing_columns(sheet: str, columns: list[str], test_type: str, test_name: str) -> Outcome:
    return Outcome(sheet, ", ".join(columns), test_type, test_name, failed=len(columns))


def failed_rule(sheet: str, field: str, test_type: str, test_name: str) -> Outcome:
    return Outcome(sheet, field, test_type, test_name, failed=1)
