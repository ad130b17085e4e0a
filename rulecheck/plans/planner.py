"""Turn a list of check outcomes into ONE summary DataFrame.

Row-local outcomes over the same frame are fused: their counters go into one
aggregate over that frame, so N null/format/comparison rules on a table cost
one scan, not N (beyond COUNTERS_PER_PASS rules a further aggregate, which
reads its own columns). Counters that count distinct keys of failing rows
(``distinct``) are fused per distinct column: ``groupBy(key)`` with
``max(fail)`` per rule, all rows that pass in one group (partial aggregation
collapses it and hot keys map-side, so only failing keys are shuffled), then a
global ``count_if``. Plain counters ride along on the first such passes.
Each pass yields one row which is turned into one summary row per rule with
``inline`` - no join, no driver round-trip. Nothing runs until an action.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.base import ROWS, Grouped, Outcome, key_name, sum_name
from ..functions.names import col
from . import COUNTERS_PER_PASS

KPI_SUMMARY_SCHEMA = (
    "sheet_name string, field string, test_type string, test_name string, status string, failed_count long"
)
FIELDS_SUMMARY_SCHEMA = KPI_SUMMARY_SCHEMA + ", total_checked long, passed_count long"

KPI_COLUMNS = ["sheet_name", "field", "test_type", "test_name", "status", "failed_count"]
FIELDS_COLUMNS = KPI_COLUMNS + ["total_checked", "passed_count"]


def _meta(i: int, o: Outcome) -> list[Column]:
    return [
        F.lit(o.sheet_name).cast("string").alias("sheet_name"),
        F.lit(o.field).cast("string").alias("field"),
        F.lit(o.test_type).alias("test_type"),
        F.lit(o.test_name).alias("test_name"),
        F.lit(o.status).cast("string").alias("_status"),
        F.lit(i).alias("_ord"),
        F.lit(o.params).cast("string").alias("rule_parameters"),
    ]


def _fused(frame: DataFrame, items: list[tuple[int, Outcome]], group: str | None = None) -> DataFrame:
    """One pass over ``frame`` for all its row-local outcomes (per ``group``
    value when given, e.g. per source file of a batch)."""
    gcols = [col(group)] if group else []
    plain = [(i, o) for i, o in items if o.distinct is None]
    by_key: dict[str, list[tuple[int, Outcome]]] = {}
    for i, o in items:
        if o.distinct is not None:
            by_key.setdefault(o.distinct, []).append((i, o))

    def plain_aggs(some: list[tuple[int, Outcome]], with_offset: bool = True) -> list[Column]:
        aggs = []
        for i, o in some:
            if o.weight is not None:
                agg = F.coalesce(F.sum(o.weight), F.lit(0))
            else:
                agg = F.count_if(o.fail)
            if o.offset and with_offset:
                agg = agg + F.lit(o.offset)
            aggs.append(agg.alias(f"f{i}"))
            if o.checked is not None:
                aggs.append(F.count_if(o.checked).alias(f"t{i}"))
        return aggs

    cut = lambda xs: [xs[k:k + COUNTERS_PER_PASS] for k in range(0, len(xs), COUNTERS_PER_PASS)]
    chunks, rows = cut(plain), []
    for key, members in by_key.items():
        for some in cut(members):
            riding = chunks.pop(0) if chunks else []
            told = frame.withColumns({f"_fail{i}": F.coalesce(o.fail, F.lit(False)) for i, o in some})  # each evaluated once
            fails = {i: F.col(f"_fail{i}") for i, _ in some}
            any_fail = reduce(lambda x, y: x | y, fails.values())
            # rows that pass share one group, so only failing keys are shuffled
            inner = [F.max(f).alias(f"f{i}") for i, f in fails.items()] + plain_aggs(riding, with_offset=False)
            outer = [F.count_if(F.col(f"f{i}")).alias(f"f{i}") for i in fails]
            for i, o in riding:
                outer.append((F.coalesce(F.sum(f"f{i}"), F.lit(0)) + F.lit(o.offset)).alias(f"f{i}"))
                if o.checked is not None:
                    outer.append(F.coalesce(F.sum(f"t{i}"), F.lit(0)).alias(f"t{i}"))
            keys = told.groupBy(*gcols, any_fail.alias("_fails"), F.when(any_fail, col(key)).alias("_key")).agg(*inner)
            rows.append(keys.groupBy(*gcols).agg(*outer))
    rows += [frame.groupBy(*gcols).agg(*plain_aggs(some)) for some in chunks]

    out = []
    for one in rows:
        present = set(one.columns)
        structs = []
        for i, o in items:
            if f"f{i}" not in present:
                continue
            total = F.col(f"t{i}").cast("long") if f"t{i}" in present else F.lit(None).cast("long")
            structs.append(F.struct(*_meta(i, o), F.col(f"f{i}").cast("long").alias("failed_count"),
                                    total.alias("total_checked")))
        src = col(group).cast("string") if group else F.lit(None).cast("string")
        out.append(one.select(src.alias("source_file"), F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, out)


def grouped_counts(frame: DataFrame, rules: Sequence[Grouped], group: str | None = None) -> DataFrame:
    """One row (one per ``group`` value) with the failed count ``f<k>`` of each rule.

    The rules' keys are grouping sets of ONE aggregate: every row is dealt to
    its group of each set (``Expand``), partial sums collapse hot keys before
    the one exchange, and a global aggregate adds up what each rule counts.
    One set is a plain group-by."""
    files = [group] if group else []
    columns = list(dict.fromkeys(c for r in rules for c in r.keys))
    sums = {c: v for r in rules for c, v in r.sums.items()}
    inputs = [*[col(c).alias(key_name(c)) for c in columns], *[v.alias(f"_v:{c}") for c, (v, _) in sums.items()], *map(col, files)]
    keys = [*map(key_name, columns), *files]
    sets = list(dict.fromkeys(tuple(c for c in columns if c in r.keys) for r in rules))
    aggs = [F.count(F.lit(1)).alias(ROWS), *[total(col(f"_v:{c}")).alias(sum_name(c)) for c, (_, total) in sums.items()]]
    rows = frame.select(*inputs)
    if len(sets) == 1:
        per_key, number = rows.groupBy(*map(col, keys)).agg(*aggs), F.lit(0)
        numbers = {sets[0]: 0}
    else:
        cols = [col(k) for k in keys]
        per_key = rows.groupingSets([[col(key_name(c)) for c in s] + [col(f) for f in files] for s in sets], *cols).agg(*aggs, F.grouping_id().alias("_set"))
        # a bit for each column that a set leaves out, the first column's the highest
        numbers = {s: sum(1 << len(keys) - 1 - i for i, c in enumerate(columns) if c not in s) for s in sets}
        number = F.col("_set")
    counts = []
    for k, r in enumerate(rules):
        own = number == numbers[tuple(c for c in columns if c in r.keys)]
        counts.append(F.coalesce(F.sum(F.when(own, r.addend)), F.lit(0)).cast("long").alias(f"f{k}"))
    return per_key.groupBy(*map(col, files)).agg(*counts)


def _grouped(frame: DataFrame, items: list[tuple[int, Outcome]], group: str | None = None) -> DataFrame:
    group = group if group and group in frame.columns else None
    one = grouped_counts(frame, [o.grouped for _, o in items], group)
    structs = [F.struct(*_meta(i, o), F.col(f"f{k}").alias("failed_count"), F.lit(None).cast("long").alias("total_checked"))
               for k, (i, o) in enumerate(items)]
    src = col(group).cast("string") if group else F.lit(None).cast("string")
    return one.select(src.alias("source_file"), F.inline(F.array(*structs)))


def materialize(spark: SparkSession, outcomes: Sequence[Outcome], style: str = "kpi",
                group: str | None = None) -> DataFrame:
    """All outcomes -> DataFrame(summary columns, rule_parameters, _ord).

    With ``group`` (a column of the row-local frames, e.g. ``_file``), each
    row-local result comes out once per group value in a ``source_file``
    column; literal and precomputed results carry NULL there."""
    lit_rows = []
    parts: list[DataFrame] = []
    frames: dict[int, tuple[DataFrame, list[tuple[int, Outcome]]]] = {}
    groups: dict[int, tuple[DataFrame, list[tuple[int, Outcome]]]] = {}
    for i, o in enumerate(outcomes):
        if o.kind == "literal":
            lit_rows.append((o.sheet_name, o.field, o.test_type, o.test_name, o.status, i, o.params,
                             int(o.failed or 0), o.total))
        elif o.kind == "grouped":
            groups.setdefault(id(o.frame), (o.frame, []))[1].append((i, o))
        elif o.kind == "rowlocal":
            frames.setdefault(id(o.frame), (o.frame, []))[1].append((i, o))
        else:
            c = o.counts
            total = col("total_checked").cast("long") if "total_checked" in c.columns else F.lit(None).cast("long")
            src = col("_file").cast("string") if "_file" in c.columns else F.lit(None).cast("string")
            parts.append(c.select(src.alias("source_file"), *_meta(i, o),
                                  col("failed_count").cast("long").alias("failed_count"), total.alias("total_checked")))
    for frame, items in frames.values():
        parts.append(_fused(frame, items, group))
    for frame, items in groups.values():
        parts.append(_grouped(frame, items, group))
    if lit_rows or not parts:
        parts.append(spark.createDataFrame(
            [(None, *r) for r in lit_rows],
            "source_file string, sheet_name string, field string, test_type string, test_name string, "
            "_status string, _ord int, rule_parameters string, failed_count long, total_checked long",
        ))
    allrows = reduce(DataFrame.unionByName, parts)
    failed = F.coalesce(F.col("failed_count"), F.lit(0))
    if style == "kpi":
        status = F.coalesce(F.col("_status"), F.when(failed == 0, F.lit("P")).otherwise(F.lit("F")))
    else:
        status = F.coalesce(F.col("_status"), F.when(failed == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))
    out = allrows.select(
        "sheet_name", "field", "test_type", "test_name", status.alias("status"),
        failed.alias("failed_count"),
        F.col("total_checked"),
        (F.col("total_checked") - failed).alias("passed_count"),
        "rule_parameters", "_ord", "source_file",
    )
    if style == "kpi":
        out = out.drop("total_checked", "passed_count")
    if group is None:
        out = out.drop("source_file")
    return out


def summary_columns(style: str) -> list[str]:
    return KPI_COLUMNS if style == "kpi" else FIELDS_COLUMNS
