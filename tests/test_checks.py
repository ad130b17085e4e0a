"""Checks on small fixture tables built in the test."""

import datetime as dt

from rulecheck import TableSet, run_fields, run_inferred, run_kpi
from rulecheck.operators import business, crosstable, infer, quality, trend
from rulecheck.plans.planner import materialize


def _counts(spark, outcomes):
    rows = materialize(spark, outcomes, "kpi").orderBy("_ord").collect()
    return [(r.field, r.status, r.failed_count) for r in rows]


def _kpi_tables(spark):
    # 12 practices x 3 months
    kpi, detail, fin = [], [], []
    for p in range(12):
        code = f"P{p:02d}"
        status = "Active" if p % 3 else "Closed"
        detail.append((code, status if p not in (1, 2, 4, 5) else "Other"))
        for m in (1, 2, 3):
            charges = 100.0 * (p + 1) * (2 if (p == 0 and m == 3) else 1)
            kpi.append((2024, m, code, status, charges, charges * 0.5, 10.0, 5.0, 15.0 if p != 7 else 16.0))
            if not (p == 11 and m == 3):
                fin.append((2024, m, code, charges + (5.0 if p == 3 else 0.0)))
    fin.append((2024, 4, "P99", 1.0))
    kpi_df = spark.createDataFrame(kpi, "FiscalYear int, FiscalMonth int, PracticeCode string, `Practice Status` string, "
                                        "Current_Charges double, AssociatedPayments double, InsuranceAR double, "
                                        "PatientAR double, GrossAR double")
    det_df = spark.createDataFrame(detail, "practicecode string, ProblemReason string")
    fin_df = spark.createDataFrame(fin, "FiscalYear int, FiscalMonth int, PracticeCode string, PM_Charges double")
    return TableSet.from_frames(spark, {"KPI": kpi_df, "Practice Detail": det_df, "FIN Recon": fin_df})


def test_lookup_counts_distinct_keys(spark):
    ts = _kpi_tables(spark)
    rule = {"name": "status", "type": "lookupmatch", "sheetname": "KPI", "leftcolumn": "Practice Status",
            "lookupsheet": "Practice Detail", "lookupkeyleft": "PracticeCode", "lookupkeyright": "practicecode",
            "rightcolumn": "ProblemReason"}
    # 4 mismatching practices over 36 rows -> 4, not 12
    assert _counts(spark, business.business_rule(ts, rule)) == [("status", "F", 4)]


def test_cross_value_and_existence(spark):
    ts = _kpi_tables(spark)
    r1 = {"name": "v", "sourcesheet": "Practice Detail", "targetsheet": "KPI", "matchcolumn": "PracticeCode",
          "sourcecolumn": "ProblemReason", "targetcolumn": "Practice Status", "validationtype": "valuecomparison"}
    r2 = {"name": "e", "sourcesheet": "FIN Recon", "targetsheet": "KPI", "matchcolumn": "practicecode",
          "validationtype": "existencecheck"}
    assert _counts(spark, crosstable.cross_sheet(ts, r1)) == [("v", "F", 4)]
    assert _counts(spark, crosstable.cross_sheet(ts, r2)) == [("e", "F", 1)]


def test_reconciliation_one_sided_groups(spark):
    ts = _kpi_tables(spark)
    rule = {"name": "charges", "sourcesheet": "KPI", "targetsheet": "FIN Recon",
            "matchcolumns": ["FiscalYear", "FiscalMonth", "PracticeCode"], "sourcecolumn": "Current_Charges",
            "targetcolumn": "PM_Charges", "distinctcolumn": "PracticeCode", "tolerance": 0.01}
    # P03 drifts (3 months, 1 practice), P11 month 3 missing on target, P99 only on target
    assert _counts(spark, crosstable.reconciliation(ts, rule)) == [("charges", "F", 3)]


def test_formula_and_duplicates(spark):
    ts = _kpi_tables(spark)
    gross = {"name": "gross", "validationtype": "comparison", "formula": "InsuranceAR + PatientAR",
             "sourcecolumns": ["InsuranceAR", "PatientAR"], "targetcolumn": "GrossAR", "aggregate": True,
             "groupbycolumns": ["FiscalYear", "FiscalMonth", "PracticeCode"]}
    gcr = {"name": "gcr", "validationtype": "threshold", "formula": "(AssociatedPayments / Current_Charges) * 100",
           "threshold": 50, "operator": "<="}
    assert _counts(spark, quality.formula_rule(ts, gross)) == [("gross", "F", 3)]
    assert _counts(spark, quality.formula_rule(ts, gcr)) == [("gcr", "P", 0)]
    dup = {"sheetname": "KPI", "columns": ["FiscalYear", "PracticeCode"]}
    assert _counts(spark, quality.duplicate_check(ts, dup)) == [("FiscalYear, PracticeCode", "F", 36)]
    missing = {"sheetname": "KPI", "columns": ["practicecode", "Nope"]}
    assert _counts(spark, quality.duplicate_check(ts, missing)) == [("practicecode, Nope", "F", 2)]


def test_trend(spark):
    ts = _kpi_tables(spark)
    rule = {"name": "t", "sheet": "KPI", "metric": "Current_Charges", "previousmetric": "x", "operator": ">",
            "threshold": 30, "aggregate": True, "groupbycolumns": ["PracticeCode", "FiscalYear", "FiscalMonth"]}
    assert _counts(spark, trend.trend(ts, rule)) == [("t", "F", 1)]


def test_null_and_precision_with_formats(spark):
    df = spark.createDataFrame([(0, 1.5, " "), (1, 2.1234, None), (2, 3.0, "x"), (3, 4.125, "")],
                               "_row_no long, amt double, note string")
    ts = TableSet(spark).add_frame("S", df, order_col="_row_no")
    fmts = spark.createDataFrame([(0, "amt", "#,##0.00"), (1, "amt", "General"), (2, "amt", "#,##0.0000")],
                                 "row_no long, field string, number_format string")
    ts.add_formats("S", fmts)
    nulls = {"sheetname": "S", "columns": ["note", "gone"]}
    assert _counts(spark, quality.null_check(ts, nulls)) == [("note, gone", "F", 4)]
    prec = {"sheetname": "S", "columns": "ALL_NUMERIC_COLUMNS", "precision": 2}
    # row 1: General -> raw 2.1234 fails; row 2: format shows 4 decimals; row 3: no format, 4.125 fails
    assert _counts(spark, quality.numeric_precision(ts, prec)) == [("amt", "F", 3)]
    prec_raw = dict(prec, usecellformat=False)
    assert _counts(spark, quality.numeric_precision(ts, prec_raw)) == [("amt", "F", 2)]


def test_stale_and_comparison(spark):
    df = spark.createDataFrame([("A", "2026-04-02", "2026-05-01"), ("B", "2026-03-07", "2026-01-01"),
                                ("B", "not applicable", "2026-01-01"), ("C", "", "")],
                               "code string, d1 string, d2 string")
    ts = TableSet.from_frames(spark, {"T": df})
    stale = {"name": "s", "type": "staledata", "sheetname": "T", "column": "d1", "referencecolumn": "d2",
             "months": 3, "distinctcolumn": "code", "blankindicators": ["Not Applicable"]}
    assert _counts(spark, business.business_rule(ts, stale, as_of=dt.date(2026, 6, 8))) == [("s", "F", 1)]
    cmp = {"name": "c", "type": "comparison", "sheetname": "T", "leftcolumn": "d1", "rightcolumn": "d2",
           "operator": "<", "blankindicators": ["not applicable"], "distinctcolumn": "code"}
    assert _counts(spark, business.business_rule(ts, cmp)) == [("c", "F", 2)]


def test_kpi_run_isolates_bad_rules(spark):
    ts = _kpi_tables(spark)
    cfg = {"sheetlist": ["KPI", "Missing"], "businessrulevalidation": [
        {"name": "bad", "type": "comparison", "sheetname": "KPI", "leftcolumn": "Current_Charges",
         "rightcolumn": "GrossAR", "operator": "=<", "datatype": "number"}]}
    rows = [tuple(r) for r in run_kpi(ts, cfg).summary.collect()]
    assert rows[0][4] == "P" and rows[1][4] == "F"
    assert ("KPI", "bad", "Data Validation", "Business Rule Validation", "F", 1) in rows
    assert sum(1 for r in rows if r[2] == "Configuration Validation") == 8  # eight missing sections


def _field_book(spark):
    emp = spark.createDataFrame([(0, "1001", "Ann Lee", "Sales", "2024-01-05"), (1, "10A2", "Bob2", "R&D", "2024/01/05"),
                                 (2, "1003", "", "Ops", "2024-2-30"), (3, "1004", "Cy", "HR", "2024-3-1")],
                                "_row_no long, Employee_ID string, Employee_Name string, Department string, Joining_Date string")
    pay = spark.createDataFrame([(0, "1001", 50000.0, 95), (1, "1002", 250000.0, 150), (2, "1003", None, 42)],
                                "_row_no long, Employee_ID string, Salary double, Performance_Score long")
    ts = TableSet(spark).add_frame("Employee Details", emp, "_row_no").add_frame("Compensation", pay, "_row_no")
    checks = {"numeric_only": {}, "email": {}, "phone_number": {}, "amount": {"min_value": 20000, "max_value": 200000},
              "number": {"min_value": 0, "max_value": 100}, "date": {"format": "%Y-%m-%d"}, "text_only": {}}
    return ts, checks


def test_fields_run(spark):
    ts, checks = _field_book(spark)
    cfg = {"sheet_checks": {"Employee Details": {}, "Compensation": {}, "Read Me": {"required": False},
                            "Contacts": {}},
           "column_checks": checks,
           "fields": {"Employee Details": {"Employee_ID": ["numeric_only"], "Employee_Name": ["text_only"],
                                           "Department": ["text_only"], "Joining_Date": ["date"], "Nope": ["email"]},
                      "Compensation": {"Salary": ["amount"], "Performance_Score": ["number"]}}}
    res = run_fields(ts, cfg)
    s = {(r.sheet_name, r.field, r.test_name): (r.status, r.failed_count, r.total_checked) for r in res.summary.collect()}
    assert s[("Read Me", "Sheet", "Sheet Existence Testing")][0] == "SKIPPED"
    assert s[("Contacts", "Sheet", "Sheet Existence Testing")][0] == "FAIL"
    assert s[("Employee Details", "Nope", "Field Existence Testing")][0] == "FAIL"
    assert s[("Employee Details", "Employee_ID", "numeric_only")] == ("FAIL", 1, 4)
    assert s[("Employee Details", "Employee_Name", "text_only")] == ("FAIL", 1, 3)
    assert s[("Employee Details", "Department", "text_only")] == ("FAIL", 1, 4)
    assert s[("Employee Details", "Joining_Date", "date")] == ("FAIL", 2, 4)
    assert s[("Compensation", "Salary", "amount")] == ("FAIL", 1, 2)
    assert s[("Compensation", "Performance_Score", "number")] == ("FAIL", 1, 3)
    failed = sorted((r.field, r.row) for r in res.failed.collect())
    assert failed == [("Department", 3), ("Employee_ID", 3), ("Employee_Name", 3), ("Joining_Date", 3),
                      ("Joining_Date", 4), ("Performance_Score", 3), ("Salary", 3)]
    stats = dict(res.execution.collect())
    assert stats["Total Failed Cells"] == "7" and stats["Execution Status"] == "COMPLETED WITH FAILURES"
    assert stats["Total Rows Processed"] == "7"


def test_inference_vectors(spark):
    df = spark.createDataFrame([(0, "2001", "a@x.com", "95", None), (1, "2002", "bad-email", "42", None),
                                (2, "20A3", "c@y.com", "150", None), (3, "2004", "d@z.com", "88", None)],
                               "_row_no long, `Staff Number` string, `Work Email` string, `Signup Score` string, "
                               "Empty string")
    ts = TableSet(spark).add_frame("S", df, "_row_no")
    _, checks = _field_book(spark)
    outcomes, rules = infer.infer_rules(ts, ["S"], checks)
    assert rules == {"S": {"Staff Number": "numeric_only", "Work Email": "email", "Signup Score": "number"}}
    assert outcomes[-1].test_name == "Unrecognized (no data)"
    assert {o.field: o.test_name for o in outcomes} == {"Staff Number": "numeric_only", "Work Email": "email", "Signup Score": "number",
                     "Empty": "Unrecognized (no data)"}
    res = run_inferred(ts, {"sheet_checks": {"S": {}}, "column_checks": checks})
    s = {(r.field, r.test_type): (r.test_name, r.failed_count) for r in res.summary.collect()}
    assert s[("Staff Number", "Data Validation")] == ("numeric_only", 1)
    assert s[("Signup Score", "Data Validation")] == ("number", 1)


def test_inference_sample_limit(spark):
    rows = [(i, "x@y.com" if i < 3 else "plain") for i in range(10)]
    ts = TableSet(spark).add_frame("S", spark.createDataFrame(rows, "_row_no long, v string"), "_row_no")
    _, checks = _field_book(spark)
    _, rules = infer.infer_rules(ts, ["S"], checks, sample_size=4)
    assert rules == {"S": {"v": "email"}}  # 3 of the first 4 values are emails
    for size in (10, None):  # all ten values
        _, rules = infer.infer_rules(ts, ["S"], checks, sample_size=size)
        assert rules == {"S": {"v": "text_only"}}


def test_inference_block_cutoffs_match_single_block(spark):
    rows = [(i, None if i % 3 == 0 else f"v{i}@x.com" if i < 40 else str(i), None if i < 50 else str(i))
            for i in range(60)]
    df = spark.createDataFrame(rows, "_row_no long, a string, b string")
    ts = TableSet(spark).add_frame("S", df, "_row_no")
    _, checks = _field_book(spark)
    small = sorted(tuple(r) for r in infer.sample_stats(ts, "S", checks, 7, block_rows=2).collect())
    big = sorted(tuple(r) for r in infer.sample_stats(ts, "S", checks, 7).collect())
    assert small == big
    assert [r[1] for r in big] == [7, 7]  # both columns sampled to the limit


def test_bad_cell_check_is_isolated(spark):
    ts, checks = _field_book(spark)
    bad = dict(checks, date={})  # no format: the date check cannot be bound
    cfg = {"sheet_checks": {"Employee Details": {}}, "column_checks": bad,
           "fields": {"Employee Details": {"Joining_Date": ["date"], "Employee_ID": ["numeric_only"]}}}
    res = run_fields(ts, cfg)
    s = {(r.field, r.test_type): (r.status, r.failed_count) for r in res.summary.collect()}
    assert s[("Joining_Date", "Configuration Validation")] == ("FAIL", 1)
    assert s[("Employee_ID", "Data Validation")] == ("FAIL", 1)
    assert {r.field for r in res.failed.collect()} == {"Employee_ID"}


def test_kpi_zero_denominator_and_null_keys(spark):
    rows = [("P1", 1, 100.0, 50.0), ("P1", 2, 0.0, 10.0), ("P2", 1, 0.0, 0.0), ("P2", 2, 80.0, 120.0),
            (None, None, 5.0, 1.0), (None, None, 5.0, 1.0), ("P3", 1, 10.0, None)]
    df = spark.createDataFrame(rows, "PracticeCode string, FiscalMonth int, Current_Charges double, "
                                     "AssociatedPayments double")
    ts = TableSet.from_frames(spark, {"KPI": df})
    gcr = {"name": "gcr", "validationtype": "threshold", "formula": "(AssociatedPayments / Current_Charges) * 100",
           "threshold": 100, "operator": "<="}
    # 10/0 -> inf fails; 0/0 -> missing passes; 120/80 -> 150 fails; NULL payments -> missing passes
    assert _counts(spark, quality.formula_rule(ts, gcr)) == [("gcr", "F", 2)]
    dup = {"sheetname": "KPI", "columns": ["PracticeCode", "FiscalMonth"]}
    # the two all-NULL key rows are ignored
    assert _counts(spark, quality.duplicate_check(ts, dup)) == [("PracticeCode, FiscalMonth", "P", 0)]
    dup1 = {"sheetname": "KPI", "columns": ["PracticeCode"]}
    assert _counts(spark, quality.duplicate_check(ts, dup1)) == [("PracticeCode", "F", 4)]
    two = {"name": "t2", "sheet": "KPI", "metric": "AssociatedPayments", "previousmetric": "Current_Charges",
           "operator": ">", "threshold": 30}
    # groups (PracticeCode [+FiscalMonth absent: only FiscalYear/FiscalMonth are added]): P1 m1 50 vs 100 -> 50 %,
    # P1 m2 prev 0 skipped, P2 m1 prev 0 skipped, P2 m2 120 vs 80 -> 50 %, P3 m1 NULL sum = 0 vs 10 -> 100 %
    assert _counts(spark, trend.trend(ts, dict(two, distinctcolumn="PracticeCode"))) == [("t2", "F", 3)]


def test_lag_by_range_matches_window(spark):
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rnd = random.Random(7)
    rows = set()
    for _ in range(400):
        g0 = "HOT" if rnd.random() < 0.5 else f"k{rnd.randint(0, 12)}"
        rows.add((g0, rnd.randint(2000, 2003), rnd.randint(1, 12)))
    data = [(g, y, m, float(rnd.randint(0, 50))) for g, y, m in sorted(rows)]
    agg = spark.createDataFrame(data, "g0 string, y int, m int, v double")
    want = agg.withColumn("_prev", F.lag("v").over(Window.partitionBy("g0").orderBy("y", "m")))
    want = sorted(tuple(r) for r in want.collect())
    for parts in (1, 3, 7, 25):
        got = trend.lag_by_range(agg, "g0", ["y", "m"], "v", parts).select("g0", "y", "m", "v", "_prev")
        assert sorted(tuple(r) for r in got.collect()) == want


def test_null_keys_match_each_other_when_kept(spark):
    left = spark.createDataFrame([("A", "x"), (None, "y"), (None, "y"), ("B", "z"), ("C", "")],
                                 "k string, v string")
    right = spark.createDataFrame([("A", "X "), (None, "y"), ("B", "q"), ("B", "z")], "k string, w string")
    ts = TableSet.from_frames(spark, {"L": left, "R": right})
    rule = {"name": "m", "type": "lookupmatch", "sheetname": "L", "leftcolumn": "v", "lookupsheet": "R",
            "lookupkeyleft": "k", "lookupkeyright": "k", "rightcolumn": "w", "dropnullkeys": False}
    # A matches (case/space-insensitive); NULL matches NULL ('y' = 'y'); B has a mismatching lookup row;
    # C is unmatched with a blank value -> passes
    assert _counts(spark, business.business_rule(ts, rule)) == [("m", "F", 1)]
    rule_drop = dict(rule, dropnullkeys=True)
    assert _counts(spark, business.business_rule(ts, rule_drop)) == [("m", "F", 1)]
    right2 = spark.createDataFrame([("A", "x"), (None, "other")], "k string, w string")
    ts2 = TableSet.from_frames(spark, {"L": left, "R": right2})
    # NULL key now mismatches (counted once), B unmatched with 'z' -> fails
    assert _counts(spark, business.business_rule(ts2, rule)) == [("m", "F", 2)]

    src = spark.createDataFrame([(0, None, "p"), (1, None, "q"), (2, "K", "r")], "_row_no long, key string, a string")
    tgt = spark.createDataFrame([(None, "P"), ("K", "r"), ("Z", "")], "key string, b string")
    ts3 = TableSet(spark).add_frame("S", src, "_row_no").add_frame("T", tgt)
    cross = {"name": "c", "sourcesheet": "S", "targetsheet": "T", "matchcolumn": "key", "sourcecolumn": "a",
             "targetcolumn": "b", "validationtype": "valuecomparison", "dropnullkeys": False}
    # the first NULL-key source row ('p') matches the NULL-key target ('P'); K matches; Z has a blank value
    assert _counts(spark, crosstable.cross_sheet(ts3, cross)) == [("c", "P", 0)]
    src2 = spark.createDataFrame([(0, None, "q"), (1, None, "p")], "_row_no long, key string, a string")
    ts4 = TableSet(spark).add_frame("S", src2, "_row_no").add_frame("T", tgt)
    # now the first NULL-key row is 'q' -> mismatch; K only in target with 'r' -> mismatch
    assert _counts(spark, crosstable.cross_sheet(ts4, cross)) == [("c", "F", 2)]


def test_registered_check(spark):
    from pyspark.sql import functions as F

    from rulecheck import register_check
    from rulecheck.functions import cells as registry

    name = "test_zip5"
    register_check(name, lambda c, dtype, params: F.coalesce(c.cast("string").rlike(r"^\d{5}$"), F.lit(False)),
                   "Invalid zip code in column '{column}'", "zip_code")
    try:
        df = spark.createDataFrame([(0, "12345"), (1, "1234"), (2, None)], "_row_no long, zip string")
        ts = TableSet(spark).add_frame("A", df, "_row_no")
        res = run_fields(ts, {"column_checks": {name: {}}, "fields": {"A": {"zip": [name]}}})
        s = {(r.field, r.test_name): (r.status, r.failed_count, r.total_checked) for r in res.summary.collect()
             if r.test_type == "Data Validation"}
        assert s[("zip", name)] == ("FAIL", 1, 2)
        (row,) = res.failed.collect()
        assert (row.row, row.value, row.error_message) == (3, "1234", "Invalid zip code in column 'zip'")
    finally:
        for table in (registry.CHECKS, registry.ERROR_MESSAGES, registry.REQUIRED_DATATYPE):
            table.pop(name, None)
