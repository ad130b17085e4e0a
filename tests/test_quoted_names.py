"""Formulas over columns whose names need quotes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rulecheck.functions.formula import formula_column, formula_names
from rulecheck.functions.numbers import RuleError


def test_names_in_back_quotes():
    assert formula_names("(`AR 90+` / Total) * 100 - `AR 90+` + `_q0`") == ["AR 90+", "Total", "_q0"]
    with pytest.raises(RuleError):
        formula_names("`AR 90+ / Total")


def test_value_of_a_quoted_column(spark):
    df = spark.createDataFrame([(5.0, 20.0), (1.0, 0.0), (None, 3.0)], "`AR 90+` double, Total double")
    got = df.select(formula_column("`AR 90+` / Total * 100", lambda n: F.col(f"`{n}`")).alias("x")).collect()
    assert [r.x for r in got] == [25.0, float("inf"), None]


def test_unknown_quoted_column():
    with pytest.raises(RuleError, match="AR 90"):
        formula_column("`AR 90+` * 2", {})
