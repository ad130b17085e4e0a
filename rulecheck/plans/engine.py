"""Rule-set runs: the KPI dialect and the field / inferred-field dialects.

A run binds every rule to the TableSet on the driver (schema metadata and
analysis only), isolates rule errors into "Configuration Validation" rows,
fuses row-local rules per table (``planner.materialize``) and returns lazy
DataFrames. Nothing is executed until the caller writes or collects a result.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import RuleError
from ..operators import business, cells, crosstable, existence, infer, quality, trend
from ..operators.base import (
    BUSINESS_RULE,
    CONFIGURATION,
    DATA_QUALITY,
    DATA_VALIDATION,
    FORMULA_VALIDATION,
    RULE_DETERMINATION,
    SHEET_EXISTENCE,
    Outcome,
    failed_rule,
    missing_table,
)
from ..session import ensure_checkpoint_dir
from ..sources.sets import InputSets
from ..sources.tables import FILE, TableSet
from .planner import materialize, summary_columns

# The KPI run's steps in order: (config path, test name).
KPI_STEPS = [
    ("sheetlist", "Sheet Validation"),
    ("sheetvalidation", "Field Validation"),
    ("dataqualityvalidation.duplicatecheck", "Duplicate Check"),
    ("dataqualityvalidation.nullcheck", "Null Check"),
    ("formulavalidation", "Formula Validation"),
    ("dataqualityvalidation.numericprecision", "Numeric Precision"),
    ("businessrulevalidation", "Business Rule Validation"),
    ("reconciliationvalidation", "Reconciliation Validation"),
    ("crosssheetvalidation", "Cross Sheet Validation"),
    ("trendvalidation", "Trend Validation"),
]


@dataclass
class RunResult:
    """Lazy results of a run. ``summary``/``details`` are ordered by rule."""

    all_rows: DataFrame
    style: str
    failed: DataFrame | None = None
    totals: Callable[..., DataFrame] | None = None
    inferred: dict | None = None
    pass_over: Callable[[], tuple[DataFrame, Callable[[], RunResult]]] | None = None

    @property
    def execution(self) -> DataFrame | None:
        return self.totals(self.all_rows) if self.totals else None

    def in_one_pass(self) -> tuple[DataFrame, Callable[[], RunResult]] | None:
        """(failed cells, finish): writing the failed cells reads every table once and counts all that the other results
        need; after that ``finish()`` gives the result with its rows at hand. None where the run has no such pass."""
        return self.pass_over() if self.pass_over else None

    def once(self) -> RunResult:
        """The same result with its rows (one per rule and file) written to the shared checkpoint folder, so that
        summary, details and run totals don't run the checks again."""
        ensure_checkpoint_dir(self.all_rows.sparkSession)
        return replace(self, all_rows=self.all_rows.checkpoint())

    def _cols(self) -> list[str]:
        extra = ["source_file"] if "source_file" in self.all_rows.columns else []
        return [*extra, *summary_columns(self.style)]

    def _ordered(self) -> DataFrame:
        if "source_file" in self.all_rows.columns:  # grows with the files
            return self.all_rows.orderBy("_ord", "source_file")
        # one row per rule: every part ends in a single-partition aggregate,
        # so one partition sorted locally replaces a range shuffle
        return self.all_rows.coalesce(1).sortWithinPartitions("_ord")

    @property
    def summary(self) -> DataFrame:
        return self._ordered().select(*self._cols())

    @property
    def details(self) -> DataFrame:
        params = F.when(F.col("test_type") != DATA_VALIDATION, F.lit("")).otherwise(
            F.coalesce(F.col("rule_parameters"), F.lit("-")))
        cols = [*self._cols(), params.alias("rule_parameters")]
        return self._ordered().select(*cols)


def _section(config: Mapping, path: str):
    node = config
    for part in path.split("."):
        node = node[part]
    return node


_RULE_ERRORS = (RuleError, KeyError, TypeError, ValueError, AnalysisException)


def _bind(fn: Callable[[], list[Outcome]], on_error: Callable[[], Outcome]) -> list[Outcome]:
    """Bind one rule; a binding error becomes ``on_error()``. Plans are
    analysed later, all predicates of a frame together (``_analysed``)."""
    try:
        outs = fn()
    except _RULE_ERRORS:
        return [on_error()]
    for o in outs:
        o.on_error = on_error
    return outs


def _expr(o: Outcome):
    return o.fail if o.fail is not None else o.weight


def _analysed(outcomes: list[Outcome]) -> list[Outcome]:
    """Analyse every plan now, so a bad rule fails alone: the row-local
    predicates of one frame in ONE analysis; only if that fails, one by one.
    (DataFrame-built plans were analysed when they were built.)"""
    by_frame: dict[int, list[int]] = {}
    out = list(outcomes)
    for i, o in enumerate(out):
        if o.kind == "rowlocal":
            by_frame.setdefault(id(o.frame), []).append(i)
    for idx in by_frame.values():
        frame = out[idx[0]].frame
        try:
            frame.select(*[_expr(out[i]).alias(f"_x{k}") for k, i in enumerate(idx)]).schema
            continue
        except AnalysisException:
            pass
        for i in idx:
            try:
                frame.select(_expr(out[i]).alias("_x")).schema
            except AnalysisException:
                out[i] = out[i].on_error() if callable(out[i].on_error) else out[i]
    return out


def kpi_outcomes(ts: TableSet, config: Mapping, as_of: _dt.date | str | None = None) -> list[Outcome]:
    out: list[Outcome] = []
    for path, test_name in KPI_STEPS:
        try:
            section = _section(config, path)
        except (KeyError, TypeError):
            out.append(Outcome("Configuration", path, CONFIGURATION, test_name, failed=1))
            continue

        def cfg_error(rule, i, path=path, test_name=test_name):
            label = rule.get("name") if isinstance(rule, Mapping) and rule.get("name") else f"{path}[{i}]"
            return lambda: Outcome("Configuration", label, CONFIGURATION, test_name, failed=1)

        try:
            if path == "sheetlist":
                out += existence.table_list(ts, section)
            elif path == "sheetvalidation":
                out += existence.table_columns(ts, section)
            elif path == "formulavalidation":
                seen_missing = set()
                for i, rule in enumerate(section):
                    sheet = rule.get("sheetname", "KPI")
                    if sheet not in ts:
                        if sheet not in seen_missing:
                            seen_missing.add(sheet)
                            out.append(missing_table(sheet, DATA_QUALITY, FORMULA_VALIDATION))
                        continue
                    out += _bind(lambda rule=rule: quality.formula_rule(ts, rule),
                                 lambda rule=rule, sheet=sheet: failed_rule(sheet, rule.get("name"), DATA_QUALITY,
                                                                            FORMULA_VALIDATION))
            elif path == "businessrulevalidation":
                for i, rule in enumerate(section):
                    out += _bind(lambda rule=rule: business.business_rule(ts, rule, as_of=as_of),
                                 lambda rule=rule: failed_rule(rule.get("sheetname"), rule.get("name"),
                                                               DATA_VALIDATION, BUSINESS_RULE))
            else:
                fn = {
                    "dataqualityvalidation.duplicatecheck": quality.duplicate_check,
                    "dataqualityvalidation.nullcheck": quality.null_check,
                    "dataqualityvalidation.numericprecision": quality.numeric_precision,
                    "reconciliationvalidation": crosstable.reconciliation,
                    "crosssheetvalidation": crosstable.cross_sheet,
                    "trendvalidation": trend.trend,
                }[path]
                for i, rule in enumerate(section):
                    out += _bind(lambda rule=rule, fn=fn: fn(ts, rule), cfg_error(rule, i))
        except KeyError:
            out.append(Outcome("Configuration", path, CONFIGURATION, test_name, failed=1))
        except _RULE_ERRORS:
            out.append(Outcome("Configuration", test_name, CONFIGURATION, test_name, failed=1))
    return _analysed(out)


def run_kpi(ts: TableSet, config: Mapping, as_of: _dt.date | str | None = None, by_file: bool = False) -> RunResult:
    """KPI dialect: ten check families -> one summary DataFrame (P/F).

    ``by_file``: single-table rules (row-local, duplicates, formulas per
    group, trends) and lookups are reported per source file (``source_file``);
    reconciliation and cross-table rules, which pair two tables, are reported
    once for the whole batch (``source_file`` NULL)."""
    if by_file:
        ts = ts.with_file_column()
        return RunResult(materialize(ts.spark, kpi_outcomes(ts, config, as_of), "kpi", FILE), "kpi")
    return RunResult(materialize(ts.spark, kpi_outcomes(ts, config, as_of), "kpi"), "kpi")


def run_kpi_inputs(sets: InputSets, config: Mapping, as_of: _dt.date | str | None = None) -> RunResult:
    """KPI dialect over many inputs, each a set of tables: every rule is reported for every input (``source_file``), as if each
    input were run by itself, two-table rules included. The rules are bound once for each group of like inputs; an input
    without rows in a table passes that table's rules, one without the table fails them as a run of its own would."""
    parts = []
    for group in sets.groups:
        outcomes = kpi_outcomes(group.tables, config, as_of)
        rules = [F.struct(F.lit(o.sheet_name).alias("sheet_name"), F.lit(o.field).alias("field"), F.lit(o.test_type).alias("test_type"),
                          F.lit(o.test_name).alias("test_name"), F.lit(o.status).cast("string").alias("_status"),
                          F.lit(int(o.failed or 0) + o.offset * (o.kind != "literal")).cast("long").alias("_known"),
                          F.lit(o.params).cast("string").alias("rule_parameters"), F.lit(i).alias("_ord")) for i, o in enumerate(outcomes)]
        if not rules:
            continue
        each = group.inputs.select("source_file", F.inline(F.array(*rules)))  # metadata: inputs x rules
        counted = materialize(group.tables.spark, outcomes, "kpi", FILE).filter("source_file IS NOT NULL").select(
            F.col("source_file").alias("_of"), F.col("_ord").alias("_rule"), F.col("failed_count").alias("_count"))
        failed = F.coalesce("_count", "_known")
        parts.append(each.join(counted, (F.col("source_file") == F.col("_of")) & (F.col("_ord") == F.col("_rule")), "left").select(
            "sheet_name", "field", "test_type", "test_name",
            F.coalesce("_status", F.when(failed == 0, "P").otherwise("F")).alias("status"), failed.alias("failed_count"),
            "rule_parameters", "_ord", "source_file"))
    if not parts:
        raise ValueError("no input, or no rule")
    return RunResult(reduce(DataFrame.unionByName, parts), "kpi")


# --------------------------------------------------------------------------- field dialects

def _cell_plan(ts: TableSet, column_rules: Mapping[str, Mapping[str, list]], column_checks: Mapping,
               by_file: bool = False):
    """Summary outcomes of every (table, column, check) and the plan of the
    failed-cells pass (checks that could not be bound are left out of it)."""
    outcomes, plan = [], []
    for sheet, fmap in column_rules.items():
        for column, checks in fmap.items():
            for check in checks:
                if check not in column_checks:
                    continue
                params = column_checks[check]
                outcomes.extend(_bind(
                    lambda sheet=sheet, column=column, check=check, params=params: [
                        cells.cell_check(ts, sheet, column, check, params, by_file)],
                    lambda sheet=sheet, column=column, check=check: Outcome(
                        sheet, column, CONFIGURATION, check, failed=1, status="FAIL")))
                plan.append((sheet, column, check, params))
    outcomes = _analysed(outcomes)
    plan = [p for p, o in zip(plan, outcomes) if o.test_type != CONFIGURATION]
    return outcomes, plan


def _one_pass(ts: TableSet, known: list[Outcome], data_rows: list[Outcome], plan: list[tuple], row_tables: list[str], inferred: bool,
              column_rules: dict | None = None):
    """A run's failed cells with counters, and the run's result made from them.

    The counters are observations of the job that writes the failed cells: its tasks need no shuffle, and Spark counts each
    finished task once, whatever is tried again after a lost executor."""
    counted: list[cells.Counted] = []
    failed = cells.failed_cells(ts, plan, counted=counted)
    checks = [o for o in data_rows if o.test_type != CONFIGURATION]  # in the order of the plan

    def finish() -> RunResult:
        rows, told = {}, {}
        for c in counted:
            seen = c.seen.get
            rows[c.sheet] = seen["rows"]
            for k in c.checks:
                told[id(checks[k])] = (seen.get(f"f{k}", 0), seen[f"t{k}"])
        outcomes = [replace(o, frame=None, fail=None, checked=None, failed=told[id(o)][0], total=told[id(o)][1]) if id(o) in told else o for o in data_rows]
        all_rows = materialize(ts.spark, known + outcomes, "fields")
        return RunResult(all_rows, "fields", failed, partial(_execution, ts, row_tables, inferred, rows), column_rules)

    return failed, finish


def _execution(ts: TableSet, row_tables: list[str], inferred: bool, counted: Mapping[str, int], all_rows: DataFrame) -> DataFrame:
    """Run totals as ``(metric, value)`` rows; tables not ``counted`` yet are."""
    is_sheet = F.col("test_name") == SHEET_EXISTENCE
    st = F.col("status")
    aggs = [
        F.count_if(is_sheet).alias("Total Sheets"),
        F.count_if(is_sheet & (st == "PASS")).alias("Sheets Passed"),
        F.count_if(is_sheet & (st == "FAIL")).alias("Sheets Failed"),
    ]
    if inferred:
        is_rule = F.col("test_type") == RULE_DETERMINATION
        aggs += [
            F.count_if(is_rule).alias("Total Columns Discovered"),
            F.count_if(is_rule & (st == "PASS")).alias("Total Columns Recognized"),
            F.count_if(is_rule & (st == "SKIPPED")).alias("Total Columns Unrecognized"),
        ]
    aggs += [
        F.count(F.lit(1)).alias("Total Validations Executed"),
        F.count_if(st == "PASS").alias("Total Passed"),
        F.count_if(st == "FAIL").alias("Total Failed"),
    ]
    if inferred:
        aggs.append(F.count_if(st == "SKIPPED").alias("Total Skipped"))
    aggs.append(F.coalesce(F.sum(F.when(F.col("test_type") == DATA_VALIDATION, F.col("failed_count"))),
                           F.lit(0)).alias("Total Failed Cells"))
    stats = all_rows.agg(*aggs)
    names = [a for a in stats.columns]
    rows = [ts.get(n).df.agg(F.count(F.lit(1)).alias("n")) for n in row_tables if n in ts and n not in counted]
    rows.append(ts.spark.range(1).select(F.lit(sum(counted.get(n, 0) for n in row_tables)).cast("long").alias("n")))
    total = reduce(DataFrame.unionByName, rows).agg(F.sum("n").alias("n"))
    status = F.when(F.col("Sheets Failed") == 0, F.lit("SUCCESS")).otherwise(F.lit("COMPLETED WITH FAILURES"))
    pos = names.index("Total Validations Executed")
    long_stats = stats.select(F.inline(F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("string").alias("value"),
                   F.lit(k if k < pos else k + 1).alias("_ord")) for k, n in enumerate(names)],
        F.struct(F.lit("Execution Status").alias("metric"), status.alias("value"), F.lit(len(names) + 1).alias("_ord")),
    )))
    long_rows = total.select(F.lit("Total Rows Processed").alias("metric"), F.col("n").cast("string").alias("value"),
                             F.lit(pos).alias("_ord"))
    return long_stats.unionByName(long_rows).coalesce(1).sortWithinPartitions("_ord").select("metric", "value")


def run_fields(ts: TableSet, config: Mapping, by_file: bool = False) -> RunResult:
    """Explicit field dialect: table existence, field existence, cell checks.

    ``by_file``: data-validation rows and failed cells come per source file
    (``source_file`` column) - a batch of files checked in one query."""
    sheet_rows, missing = existence.required_tables(ts, config.get("sheet_checks", {}))
    fields = config.get("fields", {})
    field_rows, missing_fields = existence.field_existence(ts, fields, missing)
    rules = {}
    for sheet, fmap in fields.items():
        if sheet in missing or sheet not in ts:
            continue
        rules[sheet] = {c: list(v) for c, v in fmap.items() if c not in missing_fields.get(sheet, set())}
    data_rows, plan = _cell_plan(ts, rules, config.get("column_checks", {}), by_file)
    all_rows = materialize(ts.spark, sheet_rows + field_rows + data_rows, "fields", FILE if by_file else None)
    failed = cells.failed_cells(ts, plan, by_file)
    row_tables = [n for n in fields if n in ts]
    again = None if by_file else partial(_one_pass, ts, sheet_rows + field_rows, data_rows, plan, row_tables, False)
    return RunResult(all_rows, "fields", failed, partial(_execution, ts, row_tables, False, {}), pass_over=again)


def run_inferred(ts: TableSet, config: Mapping) -> RunResult:
    """Inferred dialect: table existence, check inference per column (one
    row per column is collected), then cell checks. Where the search has tried
    all values, its counts are the checks' results."""
    sheet_rows, missing = existence.required_tables(ts, config.get("sheet_checks", {}))
    det = config.get("rule_detection", {})
    column_checks = config.get("column_checks", {})
    sheets = [n for n in ts.names if n not in missing]
    known: dict[str, dict] = {}
    rule_rows, column_rules = infer.infer_rules(
        ts, sheets, column_checks,
        det.get("match_threshold", infer.DEFAULT_MATCH_THRESHOLD), det.get("sample_size", infer.DEFAULT_SAMPLE_SIZE), known)
    rules = {s: {c: [r] for c, r in m.items()} for s, m in column_rules.items()}
    data_rows, plan = _cell_plan(ts, rules, {**{r: {} for m in column_rules.values() for r in m.values()},
                                             **column_checks})
    # the search tried the winning checks on every value: what it counted is their result, no table is read again for it
    counts = {(sheet, column): n for sheet, own in known.items() for column, n in own.items() if column is not None}
    told = [replace(o, frame=None, fail=None, checked=None, failed=n[0] - n[1], total=n[0])
            if o.kind == "rowlocal" and (n := counts.get((o.sheet_name, o.field))) else o for o in data_rows]
    rows = {sheet: own[None] for sheet, own in known.items()}
    all_rows = materialize(ts.spark, sheet_rows + rule_rows + told, "fields")
    failed = cells.failed_cells(ts, plan)
    again = partial(_one_pass, ts, sheet_rows + rule_rows, data_rows, plan, list(column_rules), True, column_rules)
    return RunResult(all_rows, "fields", failed, partial(_execution, ts, list(column_rules), True, rows), column_rules, again)
