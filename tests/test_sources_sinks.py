"""CSV tables (row numbers without a reader row index), batches of files, report sinks."""

import os
import tempfile

from rulecheck import TableSet, run_fields
from rulecheck.sinks.report import write_report

CHECKS = {"numeric_only": {}, "amount": {"min_value": 0, "max_value": 100}}


def _base(path):
    """File name of a reported ``source_file`` (results are keyed by file path)."""
    return None if path is None else path.rsplit("/", 1)[-1]


def _write_csvs(folder, n_files=2, rows=300):
    for k in range(n_files):
        with open(os.path.join(folder, f"part{k}.csv"), "w") as fh:
            fh.write("id,score,note\n")
            for i in range(rows):
                score = "NA" if i % 50 == 7 else str((i * 7 + k) % 130)
                ident = f"{i}x" if i % 97 == 5 else str(i)
                fh.write(f"{ident},{score},row {i}\n")
    with open(os.path.join(folder, "~$lock.csv"), "w") as fh:
        fh.write("id,score,note\nbad,bad,bad\n")


def test_csv_row_numbers_are_dense_per_file(spark):
    folder = tempfile.mkdtemp(prefix="rulecheck-csv-")
    _write_csvs(folder, n_files=1, rows=2000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits per file
    try:
        ts = TableSet.from_csv(spark, os.path.join(folder, "part0.csv"))
        rows = ts.get("Sheet1").ordered().select("_row_no", "note").collect()
        assert len(rows) == 2000
        assert all(r.note == f"row {r._row_no}" for r in rows)
        assert ts.get("Sheet1").df.filter("score IS NULL").count() == 40  # 'NA' is missing, like pandas
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_batch_by_file_and_sinks(spark):
    folder = tempfile.mkdtemp(prefix="rulecheck-batch-")
    _write_csvs(folder)
    ts = TableSet(spark).add_batch("scores", folder, fmt="csv", inferSchema="false")
    cfg = {"sheet_checks": {"scores": {}}, "column_checks": CHECKS,
           "fields": {"scores": {"id": ["numeric_only"], "score": ["amount"]}}}
    res = run_fields(ts, cfg, by_file=True)
    rows = {(_base(r.source_file), r.field): (r.total_checked, r.failed_count)
            for r in res.summary.collect() if r.test_type == "Data Validation"}
    # ids 5, 102, 199, 296 carry an 'x'; scores 'NA' -> missing; >100 fails
    for k in range(2):
        f = f"part{k}.csv"
        assert rows[(f, "id")] == (300, 4)
        want_fail = sum(1 for i in range(300) if i % 50 != 7 and (i * 7 + k) % 130 > 100)
        assert rows[(f, "score")] == (294, want_fail)
    failed = res.failed.filter("field = 'id'").orderBy("source_file", "row").collect()
    assert [(_base(r.source_file), r.row, r.value) for r in failed[:2]] == [("part0.csv", 7, "5x"),
                                                                             ("part0.csv", 104, "102x")]
    out = tempfile.mkdtemp(prefix="rulecheck-report-")
    parts = write_report(res, out, fmt="parquet", partition_by=["source_file"])
    assert set(parts) == {"summary", "details", "failed_records", "execution_summary"}
    back = spark.read.parquet(parts["failed_records"])
    assert back.count() == res.failed.count()
    details = spark.read.parquet(parts["details"]).filter("test_name = 'amount'").select("rule_parameters").first()[0]
    assert details == "min_value=0, max_value=100"


def test_kpi_batch_by_file(spark):
    from rulecheck import run_kpi

    folder = tempfile.mkdtemp(prefix="rulecheck-kpibatch-")
    _write_csvs(folder, n_files=2, rows=120)
    with open(os.path.join(folder, "part1.csv"), "a") as fh:
        fh.write("0,1,dup\n1,2,dup\n")  # two duplicate ids in part1 only
    ts = TableSet(spark).add_batch("Sheet1", folder, fmt="csv", inferSchema="false")
    cfg = {"sheetlist": ["Sheet1"],
           "dataqualityvalidation": {"duplicatecheck": [{"sheetname": "Sheet1", "columns": ["id"]}],
                                     "nullcheck": [{"sheetname": "Sheet1", "columns": ["score"]}]}}
    rows = run_kpi(ts, cfg, by_file=True).summary.collect()
    got = {(_base(r.source_file), r.test_name): r.failed_count for r in rows if r.source_file}
    nas = sum(1 for i in range(120) if i % 50 == 7)
    assert got[("part0.csv", "Duplicate Check")] == 0
    assert got[("part1.csv", "Duplicate Check")] == 4
    assert got[("part0.csv", "Null Check")] == nas and got[("part1.csv", "Null Check")] == nas
    assert any(r.source_file is None and r.test_name == "Sheet Existence Testing" for r in rows)
    whole = {r.test_name: r.failed_count for r in run_kpi(ts, cfg).summary.collect()}
    assert whole["Duplicate Check"] == 2 * 120 + 2  # every id repeats across the two files, 0 and 1 thrice


def test_from_dir_split_set_and_kpi_report(spark):
    from rulecheck import run_kpi

    folder = tempfile.mkdtemp(prefix="rulecheck-split-")
    long_name = "Practice Detail With A Very Long Sheet Name"
    with open(os.path.join(folder, f"{long_name}.csv"), "w") as fh:
        fh.write("code,reason\nP1,Active\nP2,\n")
    with open(os.path.join(folder, "KPI.csv"), "w") as fh:
        fh.write("code,charges\nP1,10.5\nP2,NA\n")
    with open(os.path.join(folder, "~$KPI.csv"), "w") as fh:
        fh.write("x\n1\n")
    spark.range(3).write.parquet(os.path.join(folder, "numbers"))
    ts = TableSet.from_dir(spark, folder)
    assert ts.names == ["KPI", long_name, "numbers"]
    assert ts.get("KPI").df.filter("charges IS NULL").count() == 1
    cfg = {"sheetlist": ["KPI", long_name, "numbers", "Missing"],
           "dataqualityvalidation": {"nullcheck": [{"sheetname": long_name, "columns": ["reason"]}]}}
    res = run_kpi(ts, cfg)
    out = tempfile.mkdtemp(prefix="rulecheck-kpireport-")
    for fmt in ("csv", "json"):
        parts = write_report(res, os.path.join(out, fmt), fmt=fmt)
        assert set(parts) == {"summary"}
        back = spark.read.format(fmt).option("header", "true").load(parts["summary"])
        assert back.count() == res.summary.count()
    rows = {(r.sheet_name, r.test_name): (r.status, r.failed_count) for r in res.summary.collect()}
    assert rows[("Missing", "Sheet Existence Testing")] == ("F", 1)
    assert rows[(long_name, "Null Check")] == ("F", 1)


def test_kpi_batch_group_rules_per_file(spark):
    from rulecheck import run_kpi

    folder = tempfile.mkdtemp(prefix="rulecheck-kpigroups-")
    for k in range(2):
        with open(os.path.join(folder, f"f{k}.csv"), "w") as fh:
            fh.write("code,month,cur,prev\n")
            for m in range(1, 7):
                cur = 100.0 * (2 if (k == 1 and m == 4) else 1)
                fh.write(f"P1,{m},{cur},100.0\n")
    ts = TableSet(spark).add_batch("KPI", folder, fmt="csv")
    cfg = {"trendvalidation": [
        {"name": "lag", "sheet": "KPI", "metric": "cur", "previousmetric": "x", "operator": ">", "threshold": 30,
         "aggregate": True, "groupbycolumns": ["code", "month"]},
        {"name": "two", "sheet": "KPI", "metric": "cur", "previousmetric": "prev", "operator": ">", "threshold": 30,
         "distinctcolumn": "code"}],
        "formulavalidation": [{"name": "ratio", "sheetname": "KPI", "validationtype": "threshold",
                               "formula": "cur / prev * 100", "threshold": 150, "operator": "<=", "aggregate": True,
                               "groupbycolumns": ["code", "month"], "sourcecolumns": ["cur", "prev"]}]}
    rows = run_kpi(ts, cfg, by_file=True).summary.collect()
    got = {(_base(r.source_file), r.field): r.failed_count for r in rows if r.source_file}
    # f1: month 4 doubles (+100 %) then halves (-50 %) -> 2 lag failures; f0 flat. Months never pair across files.
    assert got[("f0.csv", "lag")] == 0 and got[("f1.csv", "lag")] == 2
    # two-column: summed per code per file: f1 700 vs 600 -> 16.7 %, passes
    assert got[("f0.csv", "two")] == 0 and got[("f1.csv", "two")] == 0
    assert got[("f0.csv", "ratio")] == 0 and got[("f1.csv", "ratio")] == 1
