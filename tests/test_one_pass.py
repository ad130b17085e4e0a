"""A report of a field run reads every table once; its counters are those of the plain run."""

import csv

from rulecheck import run_fields, run_inferred
from rulecheck.catalog import FIELD_CONFIG, FIELD_TABLES, INFER_CONFIG, INFER_TABLES, tables
from rulecheck.sinks.report import write_report

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.collect()))


def same(spark, result, out):
    for name, df in (("summary", result.summary), ("details", result.details), ("failed_records", result.failed), ("execution_summary", result.execution)):
        assert rows(spark.read.schema(df.schema).parquet(out[name])) == rows(df), name


def test_report_of_a_field_run(spark, tmp_path):
    result = run_fields(tables(spark, SF, FIELD_TABLES), FIELD_CONFIG)
    same(spark, result, write_report(result, str(tmp_path / "r")))


def test_report_of_an_inferred_run(spark, tmp_path):
    result = run_inferred(tables(spark, SF, INFER_TABLES), INFER_CONFIG)
    same(spark, result, write_report(result, str(tmp_path / "r")))


def test_every_table_is_read_once(spark, tmp_path):
    result = run_fields(tables(spark, SF, FIELD_TABLES), FIELD_CONFIG)
    failed, finish = result.in_one_pass()
    scans = failed._jdf.queryExecution().executedPlan().toString()
    assert [scans.count(f"{t}.parquet") for t in ("customer", "orders", "events")] == [1, 1, 1]
    assert "hashpartitioning" not in scans
    failed.write.parquet(str(tmp_path / "failed"))
    after = finish()
    for df in (after.summary, after.details, after.execution):
        assert ".parquet" not in df._jdf.queryExecution().executedPlan().toString()


def test_predicates_run_once_a_row(spark):
    """One match for each check in the plan of the failed cells."""
    result = run_fields(tables(spark, SF, ["orders_dates"]), {"column_checks": {"date": {"format": "%Y-%m-%d"}}, "fields": {"orders_dates": {"date_text": ["date"]}}})
    plan = result.failed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and "regexp_extract" not in plan


def test_empty_and_unknown(spark, tmp_path):
    """An empty table, and one whose only check is unknown: counted, never failing."""
    from rulecheck import TableSet

    ts = TableSet.from_frames(spark, {"e": spark.createDataFrame([], "a string"), "u": spark.createDataFrame([("1",), (None,), ("",)], "a string")})
    cfg = {"column_checks": {"email": {}, "zip": {}}, "fields": {"e": {"a": ["email"]}, "u": {"a": ["zip"]}}}
    out = write_report(run_fields(ts, cfg), str(tmp_path / "r"), fmt="csv")
    import glob

    told = [r for f in glob.glob(out["summary"] + "/*.csv") for r in csv.DictReader(open(f)) if r["test_type"] == "Data Validation"]
    assert sorted((r["sheet_name"], r["failed_count"], r["total_checked"]) for r in told) == [("e", "0", "0"), ("u", "0", "1")]


def test_an_inferred_run_reads_no_table_again(spark):
    """The search tries the winning check on every value: summary and run totals come from its counts, and they equal those
    of the explicit run with the same checks."""
    result = run_inferred(tables(spark, SF, INFER_TABLES), INFER_CONFIG)
    for df in (result.summary, result.execution):
        assert ".parquet" not in df._jdf.queryExecution().executedPlan().toString()
    fields = {s: {c: [r] for c, r in m.items()} for s, m in result.inferred.items()}
    explicit = run_fields(tables(spark, SF, INFER_TABLES), {"column_checks": INFER_CONFIG["column_checks"], "fields": fields})
    data = "test_type = 'Data Validation'"
    assert rows(result.summary.filter(data)) == rows(explicit.summary.filter(data)) != []
    total = "metric = 'Total Rows Processed'"
    assert rows(result.execution.filter(total)) == rows(explicit.execution.filter(total))
