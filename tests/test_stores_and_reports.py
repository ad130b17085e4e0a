"""Folders of any store Spark reads, and one readable report per input file."""

import os

import pytest

from rulecheck import TableSet, run_fields, run_kpi
from rulecheck.sinks.report import report_names, write_file_reports
from rulecheck.sources.tables import listing


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "b.csv").write_text("x\n1\n")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "part.csv").write_text("x\n2\n3\n")
    (tmp_path / "~$b.csv").write_text("lock")
    return tmp_path


def test_folders_are_listed_through_spark(spark, folder, monkeypatch):
    """A path, a file URI and a mount that only Spark knows; nothing asks the local folder."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.reports.link./in", f"file://{folder}")
    for name in ("listdir", "scandir"):
        monkeypatch.setattr(os, name, lambda *a, **k: pytest.fail("a local listing"))
    for path in (str(folder), f"file://{folder}", "viewfs://reports/in", "viewfs://reports/in/"):
        assert listing(spark, path) == [("a", True), ("b.csv", False), ("~$b.csv", False)]
        ts = TableSet.from_dir(spark, path, fmt="csv", schema="x int")
        assert ts.names == ["a", "b"] and [ts.get(n).df.count() for n in ts.names] == [2, 1]


def test_report_names_are_readable_and_never_collide(spark):
    files = ["file:///d/2024/north.csv", "file:///d/2025/North.csv", "file:///d/south%20east.tar.gz", "s3a://b/x/a.b.csv", "file:///d/.csv",
             "file:///d/y_0123456789ab.csv", "file:///d/100%.csv", None]
    df = spark.createDataFrame([(f,) for f in files * 2], "source_file string")
    got = {r["source_file"]: r["report"] for r in report_names(df, "kpi").collect()}
    assert set(got) == set(files) - {None} and len({n.lower() for n in got.values()}) == len(got)
    assert got[files[2]] == "kpi_south_east" and got[files[3]] == "kpi_a" and got[files[6]] == "kpi_100_"
    assert got[files[0]].startswith("kpi_north_") and got[files[1]].startswith("kpi_North_") and got[files[5]].startswith("kpi_y_0123456789ab_")
    alone = {r["source_file"]: r["report"] for r in report_names(df.filter(f"source_file = '{files[0]}'"), "kpi").collect()}
    assert alone == {files[0]: "kpi_north"}


def test_a_report_per_input(spark, tmp_path):
    for place in ("one", "two"):
        (tmp_path / "in" / place).mkdir(parents=True)
        (tmp_path / "in" / place / "data.csv").write_text("x,y\na1,1\n7,2\n" + "b2,2\n" * (place == "two"))
    ts = TableSet(spark).add_batch("s", str(tmp_path / "in"), schema="x string, y int")
    config = {"sheet_checks": {"s": {}}, "column_checks": {"numeric_only": {}}, "fields": {"s": {"x": ["numeric_only"]}}}
    out = write_file_reports(run_fields(ts, config, by_file=True), str(tmp_path / "out" / "run"), "check")
    assert sorted(os.listdir(tmp_path / "out")) == ["run"] and sorted(out) == ["details", "failed_records", "inputs", "summary"]
    named = {r["source_file"].split("/")[-2]: r["report"] for r in spark.read.parquet(out["inputs"]).collect()}
    assert set(named) == {"one", "two"} and len(set(named.values())) == 2 and all(n.startswith("check_data_") for n in named.values())
    folders = {f for f in os.listdir(out["summary"]) if f.startswith("report=")}
    assert folders == {f"report={n}" for n in named.values()} | {"report=check_whole_set"}
    counts = {r["report"]: r["failed_count"] for r in spark.read.parquet(out["summary"]).filter("test_type = 'Data Validation'").collect()}
    assert counts == {named["one"]: 1, named["two"]: 2}
    assert spark.read.parquet(out["failed_records"] + f"/report={named['two']}").count() == 2
    with pytest.raises(FileExistsError):
        write_file_reports(run_fields(ts, config, by_file=True), str(tmp_path / "out" / "run"))


def test_only_batch_runs_have_file_reports(spark, tmp_path):
    ts = TableSet.from_frames(spark, {"s": spark.createDataFrame([("a",)], "x string")})
    with pytest.raises(ValueError):
        write_file_reports(run_kpi(ts, {"dataqualityvalidation": {"nullcheck": [{"sheetname": "s", "columns": ["x"]}]}}), str(tmp_path / "r"))
