"""Bad data fails a rule, never the run; results do not depend on plan reuse."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rulecheck import TableSet, run_kpi
from rulecheck.functions.numbers import safe_mod
from rulecheck.operators.trend import lag_by_range


def test_bad_data_is_isolated(spark):
    """Text in a formula, number keys against text keys; the healthy rule beside them counts on."""
    left = spark.createDataFrame([(1, "2", "a"), (2, "abc", "b"), (2, "4", "c")], "k int, txt string, v string")
    right = spark.createDataFrame([("1", "a", 2.0), ("zz", "q", 1.0)], "k string, v string, x double")
    rules = {
        "dataqualityvalidation": {"duplicatecheck": [{"sheetname": "l", "columns": ["k"]}]},
        "formulavalidation": [{"name": "f", "sheetname": "l", "validationtype": "threshold", "formula": "txt * 2", "threshold": 100, "operator": "<"}],
        "businessrulevalidation": [{"name": "look", "sheetname": "l", "type": "lookupmatch", "lookupsheet": "r", "lookupkeyleft": "k",
                                    "lookupkeyright": "k", "leftcolumn": "v", "rightcolumn": "v"}],
        "crosssheetvalidation": [{"name": "cross", "validationtype": "valuecomparison", "sourcesheet": "l", "targetsheet": "r", "matchcolumn": "k",
                                  "sourcecolumn": "v", "targetcolumn": "v"}],
        "reconciliationvalidation": [{"name": "rec", "sourcesheet": "l", "targetsheet": "r", "matchcolumns": ["k"], "sourcecolumn": "txt",
                                      "targetcolumn": "x", "distinctcolumn": "k"}],
    }
    rows = {(r["test_name"], r["field"]): (r["status"], r["failed_count"]) for r in run_kpi(TableSet.from_frames(spark, {"l": left, "r": right}), rules).summary.collect()}
    assert ("F", 2) in [v for (name, _), v in rows.items() if "Duplicate" in name]
    assert all(status in ("P", "F") for status, _ in rows.values()) and len(rows) >= 5


@pytest.mark.parametrize("n,d,want", [(7, 3, 1.0), (-7, 3, 2.0), (7, -3, -2.0), (-7, -3, -1.0)])
def test_modulo_takes_the_divisors_sign(spark, n, d, want):
    assert spark.range(1).select(safe_mod(F.lit(n), F.lit(d)).alias("m")).first()["m"] == want


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_lag_does_not_depend_on_exchange_reuse(spark, reuse):
    agg = spark.range(2_000_000).select((F.col("id") % 7).alias("g"), F.xxhash64("id").alias("o"), (F.col("id") % 1000).cast("double").alias("v")).distinct()
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = lag_by_range(agg, "g", ["o"], "v", 8)
        want = agg.withColumn("_prev", F.lag("v").over(Window.partitionBy("g").orderBy("o")))
        digest = lambda df: df.agg(F.count("_prev"), F.sum(F.xxhash64("g", "o", "v", "_prev").cast("decimal(38,0)"))).first()
        assert digest(got) == digest(want)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_from_dir_names(spark, tmp_path):
    for name in ("x" * 40 + "a", "x" * 40 + "b", "~c"):
        (tmp_path / f"{name}.csv").write_text("k\n1\n")
    (tmp_path / "~$lock.csv").write_text("")
    assert sorted(TableSet.from_dir(spark, f"file://{tmp_path}").names) == sorted(["x" * 40 + "a", "x" * 40 + "b", "~c"])
    (tmp_path / "_b.csv").write_text("k\n1\n")
    with pytest.raises(ValueError):
        TableSet.from_dir(spark, str(tmp_path))
