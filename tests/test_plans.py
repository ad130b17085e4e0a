"""Plan shapes that the design relies on at scale (checked on the physical plan)."""

from rulecheck import TableSet, run_kpi
from rulecheck.operators import infer, trend

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_local_rules_share_one_scan(spark):
    ts = TableSet.from_dir(spark, SF, names=["lineitem", "orders"])
    cfg = {
        "dataqualityvalidation": {
            "nullcheck": [{"sheetname": "lineitem", "columns": ["l_returnflag", "l_linestatus"]}],
            "numericprecision": [{"sheetname": "lineitem", "columns": "ALL_NUMERIC_COLUMNS", "precision": 2}]},
        "formulavalidation": [{"name": "f", "sheetname": "lineitem", "validationtype": "threshold",
                               "formula": "l_discount * 100", "threshold": 10, "operator": "<="}],
        "businessrulevalidation": [
            {"name": "b1", "type": "comparison", "sheetname": "lineitem", "leftcolumn": "l_quantity",
             "rightcolumn": "l_extendedprice", "operator": "<", "datatype": "number", "distinctcolumn": "l_orderkey"},
            {"name": "b2", "type": "staledata", "sheetname": "lineitem", "column": "l_shipdate",
             "referencecolumn": "l_shipdate", "months": 3, "distinctcolumn": "l_orderkey"}],
    }
    plan = _plan(run_kpi(ts, cfg, as_of="1998-01-01").summary)
    # ten row-local rules (2 null-check columns, 8 precision columns, a formula, two distinct-key rules): one scan
    assert plan.count("lineitem.parquet") == 1, plan


def test_inference_limits_before_the_shuffle(spark):
    ts = TableSet.from_dir(spark, SF, names=["customer"])
    checks = {"email": {}, "numeric_only": {}, "text_only": {}}
    plan = _plan(infer.sample_stats(ts, "customer", checks, 200))
    limit = plan.find("WindowGroupLimit")
    assert "Partial" in plan and limit >= 0
    # the partial limit sits below (after, in the string) the exchange on the column index
    assert plan.find("Exchange hashpartitioning(ci") < plan.rfind("WindowGroupLimit")


def test_trend_lag_uses_ranges_of_keys(spark):
    agg = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)], "g string, m int, v double")
    plan = _plan(trend.lag_by_range(agg, "g", ["m"], "v", 4))
    assert "windowspecdefinition(_pid" in plan and "rangepartitioning" not in plan  # lag per (range, key), never per whole key
    ranges = trend._range_number(spark.range(20000).selectExpr("id % 2 AS g", "id AS m"), ["g", "m"], 16).groupBy("_pid").count().collect()
    assert 14 <= len(ranges) <= 20 and max(r["count"] for r in ranges) < 4 * 20000 / 16


def test_trend_lag_is_that_of_the_sorted_rows(spark):
    """Against plain Python: one group with half of all rows, groups that lie in one range, no rows; with and without exchange reuse."""
    rows = [("hot", k * 7 % 1009, float(k)) for k in range(1009)] + [(f"g{k % 300}", k, k / 3) for k in range(1000)]
    want, last = {}, {}
    for g, m, v in sorted(rows):
        want[g, m] = last.get(g)
        last[g] = v
    agg = spark.createDataFrame(rows, "g string, m int, v double").groupBy("g", "m").agg({"v": "sum"}).withColumnRenamed("sum(v)", "v")
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            for parts in (1, 3, 8, 200):
                got = {(r["g"], r["m"]): r["_prev"] for r in trend.lag_by_range(agg, "g", ["m"], "v", parts).collect()}
                assert got == want, (reuse, parts)
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
    assert trend.lag_by_range(agg.limit(0), "g", ["m"], "v", 8).count() == 0


def test_a_trend_rule_runs_nothing_while_binding(spark):
    ts = TableSet.from_dir(spark, SF, names=["orders"])
    rule = {"name": "t", "sheet": "orders", "metric": "o_totalprice", "previousmetric": "x", "operator": ">", "threshold": 30, "aggregate": True,
            "groupbycolumns": ["o_custkey", "o_orderdate"]}
    spark.sparkContext.setJobGroup("binding", "no job")
    try:
        run = run_kpi(ts, {"trendvalidation": [rule]})
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("binding")
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert run.summary.filter("field = 't' AND test_name = 'Trend Validation'").count() == 1


GROUPED = {
    "dataqualityvalidation": {"duplicatecheck": [
        {"sheetname": "lineitem", "columns": ["l_orderkey", "l_linenumber"]}, {"sheetname": "lineitem", "columns": ["l_partkey"]},
        {"sheetname": "lineitem", "columns": ["l_partkey", "l_suppkey"]}]},
    "formulavalidation": [
        {"name": "a", "sheetname": "lineitem", "validationtype": "threshold", "formula": "l_tax / l_discount", "threshold": 1.00001, "operator": "<=",
         "aggregate": True, "groupbycolumns": ["l_orderkey"], "sourcecolumns": ["l_tax", "l_discount"]},
        {"name": "b", "sheetname": "lineitem", "validationtype": "threshold", "formula": "l_quantity - 2 * l_partkey", "threshold": 1000, "operator": "<=",
         "aggregate": True, "groupbycolumns": ["l_partkey"], "sourcecolumns": ["l_quantity"]},
        {"name": "bad", "sheetname": "lineitem", "validationtype": "threshold", "formula": "l_quantity - l_tax", "threshold": 1, "operator": "<=",
         "aggregate": True, "groupbycolumns": ["l_partkey"], "sourcecolumns": ["l_quantity"]}],
}


def test_grouped_rules_share_one_scan_and_one_exchange(spark):
    """Three duplicate rules and two formulas per group of a table: one scan, one exchange of its (partly aggregated) rows."""
    ts = TableSet.from_dir(spark, SF, names=["lineitem"])
    result = run_kpi(ts, GROUPED)
    plan = _plan(result.summary)
    assert plan.count("lineitem.parquet") == 1 and plan.count("Expand") == 1, plan
    assert plan.count("Exchange hashpartitioning") == 1, plan
    rows = {(r["test_name"], r["field"]): r["failed_count"] for r in result.summary.collect()}
    t = spark.read.parquet(f"{SF}/lineitem.parquet").toPandas()
    for r in GROUPED["dataqualityvalidation"]["duplicatecheck"]:
        assert rows["Duplicate Check", ", ".join(r["columns"])] == int(t.duplicated(r["columns"], keep=False).sum())
    by_order, by_part = t.groupby("l_orderkey").sum(numeric_only=True), t.groupby("l_partkey", as_index=False).agg({"l_quantity": "sum"})
    assert rows["Formula Validation", "a"] == int((~(by_order.eval("l_tax / l_discount") <= 1.00001)).sum())
    assert rows["Formula Validation", "b"] == int((~(by_part.eval("l_quantity - 2 * l_partkey") <= 1000)).sum())
    assert rows["Formula Validation", "bad"] == 1


def test_grouped_rules_keep_their_null_rules(spark):
    """NULL keys: equal in a duplicate check unless all are NULL, dropped in a formula per group; a real NULL is told from a
    key that another rule's set leaves out."""
    rows = [(1, None, 1), (1, None, 2), (None, None, 5), (None, None, 5), (None, 2, 7), (None, 2, 1), (3, 2, 1)]
    ts = TableSet.from_frames(spark, {"KPI": spark.createDataFrame(rows, "a int, b int, v int")})
    formula = {"name": "f", "validationtype": "threshold", "formula": "v", "threshold": 2, "operator": "<=", "aggregate": True, "sourcecolumns": ["v"]}
    got = run_kpi(ts, {
        "dataqualityvalidation": {"duplicatecheck": [{"sheetname": "KPI", "columns": c} for c in (["a", "b"], ["a"], ["b"])]},
        "formulavalidation": [dict(formula, groupbycolumns=["a"]), dict(formula, name="g", groupbycolumns=["a", "b"])]}).summary.collect()
    counts = {r["field"]: r["failed_count"] for r in got if r["test_name"] in ("Duplicate Check", "Formula Validation")}
    assert counts == {"a, b": 4, "a": 2, "b": 3, "f": 1, "g": 0}
