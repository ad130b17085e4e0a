"""Rule-set loading and the example rule sets end to end."""

import json
import os

import pytest

from rulecheck import TableSet, load_rules, run_fields, run_inferred, run_kpi
from rulecheck.functions.numbers import RuleError
from rulecheck.rules import bad_operators

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def test_load_rules_forms(tmp_path):
    doc = {"sheetlist": ["a"]}
    p = tmp_path / "r.json"
    p.write_text(json.dumps(doc))
    assert load_rules(doc) == doc == load_rules(json.dumps(doc)) == load_rules(str(p))
    for bad in ("{}", "[]", "[1]"):
        with pytest.raises(RuleError):
            load_rules(bad)
    assert bad_operators({"trendvalidation": [{"name": "t", "operator": "=>"}],
                          "formulavalidation": [{"name": "f", "operator": "<="}]}) == ["t"]


def test_example_kpi_rules(spark):
    ts = TableSet.from_dir(spark, SF)
    rows = run_kpi(ts, load_rules(os.path.join(HERE, "examples", "kpi_rules.json")), as_of="2000-01-01").summary.collect()
    kinds = {r.test_name for r in rows}
    assert {"Sheet Existence Testing", "Field Existence Testing", "Duplicate Check", "Null Check",
            "Formula Validation", "Numeric Precision", "Business Rule Validation", "Reconciliation Validation",
            "Cross Sheet Validation", "Trend Validation"} <= kinds
    by = {(r.test_name, r.field): (r.status, r.failed_count) for r in rows}
    assert by[("Duplicate Check", "o_orderkey")] == ("P", 0)
    assert by[("Reconciliation Validation", "Order value")] == ("P", 0)  # a table reconciles with itself
    assert by[("Business Rule Validation", "Shipped after it was ordered")] == ("P", 0)
    assert by[("Field Existence Testing", "c_phone")] == ("F", 1)


def test_example_field_rules(spark):
    ts = TableSet.from_dir(spark, SF)
    res = run_fields(ts, load_rules(os.path.join(HERE, "examples", "field_rules.json")))
    stats = dict(res.execution.collect())
    assert stats["Total Sheets"] == "3" and stats["Sheets Failed"] == "0"
    assert stats["Execution Status"] == "SUCCESS"
    assert int(stats["Total Failed Cells"]) == res.failed.count()


def test_example_inferred_rules(spark):
    ts = TableSet.from_dir(spark, SF, names=["customer", "region", "nation"])
    res = run_inferred(ts, load_rules(os.path.join(HERE, "examples", "inferred_rules.json")))
    assert res.inferred["region"]["r_regionkey"] == "amount"  # 0..4 is within 0..5000; amount outranks numeric_only
    assert res.inferred["customer"]["c_mktsegment"] == "text_only"


def test_command_line(spark, tmp_path, capsys):
    from rulecheck.__main__ import main

    out = tmp_path / "report"
    rules = os.path.join(HERE, "examples", "field_rules.json")
    assert main(["fields", "--tables", SF, "--rules", rules, "--out", str(out), "--format", "json"]) == 0
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(printed["report"]) == {"summary", "details", "failed_records", "execution_summary"}
    assert spark.read.json(printed["report"]["summary"]).count() > 0
