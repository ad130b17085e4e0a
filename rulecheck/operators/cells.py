"""Cell checks over columns (C21, C22) and their failed-cell records.

Blank cells (NULL or exactly '') are skipped and not counted; every other
cell is checked. For the summary all (column, check) pairs of a table are
counted in ONE fused aggregate. Failed cells come from ONE pass per table:
each row gives a (rule number, value) struct per failing check, exploded and
labelled - so the output is one row per failing cell and nothing is collected.
A report needs no other pass: that one can count as it goes (``Counted``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.cells import check_passes, datatype_label, error_message
from ..functions.names import col
from ..functions.text import is_blank_cell
from ..sources.tables import FILE, ROW_NO, TableSet
from .base import DATA_VALIDATION, Outcome

FAILED_SCHEMA = (
    "sheet_name string, field string, row long, value string, validation_type string, "
    "required_datatype string, error_message string"
)
FAILED_COLUMNS = ["sheet_name", "field", "row", "value", "validation_type", "required_datatype", "error_message"]


@dataclass(frozen=True)
class Counted:
    """What the failed-cells pass over a table counts: ``rows``, and ``t<k>`` checked and ``f<k>`` failing cells of its checks."""

    sheet: str
    checks: list[int]
    seen: Observation


def format_params(params: Mapping | None) -> str:
    """``k=v, k=v`` of a check's parameters, '-' when it has none."""
    if not params:
        return "-"
    return ", ".join(f"{k}={v}" for k, v in params.items())


def cell_check(ts: TableSet, sheet: str, column: str, check: str, params: Mapping | None,
               by_file: bool = False) -> Outcome:
    """Summary outcome of one check on one column (row-local, fused). With
    ``by_file`` the frame carries the source file for per-file counts."""
    t = ts.get(sheet)
    dtype = t.dtype(column)
    c = col(column)
    nonblank = ~is_blank_cell(c, dtype)
    ok = check_passes(check, c, dtype, params)
    fail = F.lit(False) if ok is None else (nonblank & ~ok)  # unknown check: counted, never fails
    return Outcome(sheet, column, DATA_VALIDATION, check, frame=t.ordered() if by_file else t.df, fail=fail,
                   checked=nonblank, params=format_params(params))


def failed_cells(ts: TableSet, plan: Sequence[tuple[str, str, str, Mapping | None]],
                 by_file: bool = False, counted: list[Counted] | None = None) -> DataFrame:
    """One row per failing cell for ``[(table, column, check, params), ..]``
    (plus ``source_file`` with ``by_file``).

    Every predicate is evaluated once a row: it is a column of its own, from which one candidate per check is made, and
    the candidates that are NULL go after the explode. ``counted`` receives, for each table, an observation of this pass that holds the
    table's rows and the checked and failing cells of each check, once the result has been written."""
    by_table: dict[str, list] = {}
    for k, (sheet, column, check, params) in enumerate(plan):
        by_table.setdefault(sheet, []).append((k, column, check, params))
    parts = []
    for sheet, items in by_table.items():
        t = ts.get(sheet)
        row = (F.col(ROW_NO) + 2) if t.has_row_numbers() else F.lit(None).cast("long")
        fails, metrics, structs, labels = {}, [F.count(F.lit(1)).alias("rows")], [], []
        for k, column, check, params in items:
            dtype = t.dtype(column)
            c = col(column)
            ok = check_passes(check, c, dtype, params)
            metrics.append(F.count_if(~is_blank_cell(c, dtype)).alias(f"t{k}"))
            if ok is None:
                continue
            name = f"_fail{k}"
            fails[name] = ~is_blank_cell(c, dtype) & ~ok
            metrics.append(F.count_if(F.col(name)).alias(f"f{k}"))
            structs.append(F.when(F.col(name), F.struct(F.lit(len(labels)).alias("rule"), c.cast("string").alias("value"))))
            labels.append(F.struct(
                F.lit(column).alias("field"),
                F.lit(check).alias("validation_type"),
                F.lit(datatype_label(check)).alias("required_datatype"),
                F.lit(error_message(check, column)).alias("error_message"),
            ))
        if not structs:
            continue
        frame = t.ordered().withColumns(fails)
        if counted is not None:
            seen = Observation()
            frame = frame.observe(seen, *metrics)
            counted.append(Counted(sheet, [k for k, *_ in items], seen))
        parts.append(
            frame.select(row.cast("long").alias("row"), F.col(FILE).alias("_f"), F.explode_outer(F.array(*structs)).alias("_x"))
            .filter(F.col("_x").isNotNull())
            .select("row", "_f", "_x.value", F.get(F.array(*labels), F.col("_x.rule")).alias("_l"))
            .select(F.lit(sheet).alias("sheet_name"), "_l.field", "row", "value", "_l.validation_type",
                    "_l.required_datatype", "_l.error_message", *([F.col("_f").alias("source_file")] if by_file else []))
        )
    if not parts:
        schema = FAILED_SCHEMA + (", source_file string" if by_file else "")
        return ts.spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)

