"""Local date texts against pandas: cell by cell, and a column in the form of its first value; the rules that use them."""

import datetime as dt
import random
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rulecheck import TableSet, run_kpi
from rulecheck.functions import date_formats as dfm
from rulecheck.functions import dates

PATTERNS = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%m/%d/%Y", "%m-%d-%Y", "%m.%d.%Y", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y", "%Y%m%d", "%d-%b-%Y",
            "%d %b %Y", "%d%b%Y", "%d %B %Y", "%b %d, %Y", "%B %d, %Y", "%b %d %Y", "%b-%d-%Y", "%Y-%b-%d"]
TIMES = ["", " %H:%M", " %H:%M:%S", " %H:%M:%S.%f", "T%H:%M", "T%H:%M:%S"]


def texts():
    rng = random.Random(3)
    out = ["05-Jan-2024", "2024.01.05", "January 5, 2024", "20240105", "2024-1-5", "1/5/2024", "13/01/2024", "5 May 2024", "05-JAN-2024", "january 5, 2024",
           "2024", "2024-01", "  2024-01-05 ", "2024-02-30", "31-Feb-2024", "02/30/2024", "99/99/2024", "12-Foo-2024", "x", "", " ", "45000", "1.5",
           "1704412800", "12/31/99", "5/1/24", "1-Jan-24", "1/5/2024 10:30:00 PM", "2024-01-05 9:05", "01/05/2024 11:59 pm", "abc 2024-01-05x"]
    for p in PATTERNS:
        for t in TIMES:
            day = dt.datetime(rng.randrange(1970, 2040), rng.randrange(1, 13), rng.randrange(1, 29), rng.randrange(24), rng.randrange(60), rng.randrange(60), rng.randrange(10**6))
            out.append(day.strftime(p + t))
    return out


def pandas_cell(t):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        v = pd.to_datetime(t, errors="coerce")
    return None if pd.isna(v) else v.to_pydatetime()


def test_cells_as_pandas_reads_them(spark):
    rows = list(enumerate(texts()))
    got = spark.createDataFrame(rows, "i int, t string").select("i", "t", dfm.parse_cell(F.col("t")).alias("v")).collect()
    wrong = [(r["t"], r["v"], pandas_cell(r["t"])) for r in got if r["v"] != pandas_cell(r["t"])]
    assert wrong == []


COLUMNS = [
    ["05-Jan-2024", "2024-01-05", "6-Feb-2024", "06-February-2024", "06-feb-2024", None, "30-Feb-2024"],
    ["2024-01-05", "2024-01-06 10:00", "2024-1-7", "20240108", "2024/01/09"],
    [None, "01/05/2024", "13/01/2024", "1/5/2024", "01/05/24", "01/05/2024 10:00"],
    ["13/01/2024", "01/05/2024"], ["2024-1-5", "2024-01-05", "05-Jan-2024"],
    ["01/05/2024 10:30", "01/05/2024 10:30:15", "01/06/2024"], ["20240105", "2024-01-05", "20240199"],
    ["2024-01-05 10:00:00", "2024-01-05", "2024-01-05 10:00:00.5", "2024-01-05T10:00:00"],
    ["05-JAN-2024", "2024-01-05", "1/7/2024"], ["x", "2024-01-05", "05-Jan-2024"], ["January 5, 2024", "Jan 5, 2024", "january 6, 2024"],
    ["2024.01.05", "2024-01-05"], [None, None], ["5 May 2024", "6 Jun 2024"],
]


def test_columns_have_one_form(spark):
    rows = [(k, i, v) for k, values in enumerate(COLUMNS) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, i int, t string").repartition(3)
    forms = dfm.first_texts(df, F.col("t"), [F.col("i")], [F.col("k")]).select("k", dfm.form_of(F.col("first")).alias("form"))
    got = df.join(forms, "k").select("k", "i", dates.to_timestamp_lenient(F.col("t"), StringType(), form=F.col("form")).alias("v")).orderBy("k", "i").collect()
    for k, values in enumerate(COLUMNS):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = [None if pd.isna(v) else v.to_pydatetime() for v in pd.to_datetime(pd.Series(values, dtype=object), errors="coerce")]
        assert [r["v"] for r in got if r["k"] == k] == want, values


def stale(spark, values, **more):
    ts = TableSet(spark).add_frame("s", spark.createDataFrame([(i, v) for i, v in enumerate(values)], "_i long, d string"), order_col="_i")
    rule = {"name": "r", "type": "staledata", "sheetname": "s", "column": "d", "referencecolumn": "d", "months": 1} | more
    rows = run_kpi(ts, {"businessrulevalidation": [rule]}, as_of="2024-06-01").summary.filter("field = 'r'").collect()
    return rows[0]["failed_count"]


def test_stale_rule_reads_the_column(spark):
    assert stale(spark, [None, " ", "05-Jan-2024", "2024-01-05", "06-Feb-2024", "20-May-2024"]) == 2
    assert stale(spark, ["2024-01-05", "05-Jan-2024", "06-Feb-2024"]) == 1
    assert stale(spark, ["13/01/2024", "01/05/2024", "02/05/2024"]) == 1  # days first: the first of May is no month old
    assert stale(spark, ["05-Jan-2024", "2024-01-05"], dateformats=["yyyy-MM-dd"]) == 1


def test_comparison_rule_reads_cells(spark):
    rows = [("05-Jan-2024", "2024.01.05"), ("January 5, 2024", "20240105"), ("1/5/2024", "2024-01-05"), ("13/01/2024", "2024-01-13"), ("31-Feb-2024", "2024-03-02")]
    ts = TableSet.from_frames(spark, {"s": spark.createDataFrame(rows, "a string, b string")})
    rule = {"name": "r", "type": "comparison", "sheetname": "s", "leftcolumn": "a", "rightcolumn": "b", "operator": "==", "datatype": "date"}
    got = run_kpi(ts, {"businessrulevalidation": [rule]}).summary.filter("field = 'r'").first()
    assert got["failed_count"] == 1


def test_batch_files_have_forms_of_their_own(spark, tmp_path):
    for name, values in (("a", ["05-Jan-2024", "2024-01-05"]), ("b", ["2024-01-05", "05-Jan-2024", "2024-02-01"])):
        (tmp_path / f"{name}.csv").write_text("d,n\n" + "".join(f"{v},1\n" for v in values))
    ts = TableSet(spark).add_batch("s", str(tmp_path), schema="d string, n int")
    rule = {"name": "r", "type": "staledata", "sheetname": "s", "column": "d", "referencecolumn": "d", "months": 1}
    got = run_kpi(ts, {"businessrulevalidation": [rule]}, as_of="2024-06-01", by_file=True).all_rows.filter("field = 'r'").collect()
    assert {r["source_file"][-5:]: r["failed_count"] for r in got} == {"a.csv": 1, "b.csv": 2}


CHECKED = ["%Y-%m-%d", "%m/%d/%y", "%d %b %Y", "%B %d, %Y", "%Y%m%d", "%d.%m.%Y %H:%M:%S", "%b-%y", "%d", "%H:%M", "%d%m%y", "%j %Y", "%m %d", "%%%d", "%A %d %B"]


def near_texts(fmt):
    rng = random.Random(len(fmt))
    yield from ("", " ", "x")
    for _ in range(300):
        y, m, d = rng.choice([1900, 2000, 2023, 2024, 0, 1, 9999, 68, 69]), rng.randrange(0, 14), rng.choice([0, 1, 9, 28, 29, 30, 31, 32])
        name = rng.choice(["jan", "Feb", "APRIL", "february", "June", "mai"])
        t = fmt.replace("%%", "%")
        for k, v in {"%Y": f"{y:04d}", "%y": f"{y % 100:02d}", "%m": rng.choice([f"{m:02d}", str(m)]), "%d": rng.choice([f"{d:02d}", str(d), f"{d:2d}"]), "%b": name[:3],
                     "%B": name, "%H": str(rng.randrange(26)), "%M": f"{rng.randrange(62):02d}", "%S": f"{rng.randrange(63):02d}", "%j": str(rng.randrange(370)), "%A": "Monday"}.items():
            t = t.replace(k, v)
        yield rng.choice([t, t, t, t + " ", t.replace(" ", "  "), t + "1", t[:-1]])


def test_date_check_against_strptime(spark):
    """One match a cell gives what strptime says, on days of all kinds and on texts near them."""
    def ok(v, fmt):
        try:
            dt.datetime.strptime(v, fmt)
        except ValueError:
            return False
        return True

    rows = [(k, v) for k, fmt in enumerate(CHECKED) for v in near_texts(fmt)]
    checked = F.coalesce(*[F.when(F.col("k") == k, dates.strptime_ok(F.col("v"), fmt)) for k, fmt in enumerate(CHECKED)])
    got = spark.createDataFrame(rows, "k int, v string").select("k", "v", checked.alias("ok")).collect()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert [(CHECKED[r["k"]], r["v"], r["ok"]) for r in got if r["ok"] != ok(r["v"], CHECKED[r["k"]])] == []


def test_one_match_in_the_plan(spark):
    df = spark.createDataFrame([("2024-01-05",)], "v string").filter(dates.strptime_ok(F.col("v"), "%Y-%m-%d"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and "regexp_extract" not in plan
