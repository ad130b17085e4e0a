"""Typed formulas: parity with pandas' DataFrame.eval on random formulas, exact whole numbers and decimals, rule results."""

import math
import random
import warnings
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rulecheck import TableSet, run_kpi
from rulecheck.functions.formula import FUNCTIONS, Value, formula_names, formula_value, typed
from rulecheck.functions.numbers import RuleError

BIG = 2**53


def frames(spark):
    rng = random.Random(1)
    rows = []
    for k in range(60):
        a, b = rng.choice([0, 1, -1, 7, -13, BIG + 1, -BIG - 3, rng.randrange(-99, 99)]), rng.choice([0, 1, -1, 2, -3, 5, rng.randrange(-9, 9)])
        x, y = rng.choice([0.0, -0.0, 1.5, -2.25, None, rng.uniform(-9, 9)]), rng.choice([0.0, 2.0, -0.5, None, rng.uniform(-3, 3)])
        rows.append((k, a, b, x, y, rng.random() < 0.5, rng.random() < 0.5, rng.choice(["u", "v", None])))
    sdf = spark.createDataFrame(rows, "k long, a long, b long, x double, y double, p boolean, q boolean, t string")
    pdf = pd.DataFrame(rows, columns=["k", "a", "b", "x", "y", "p", "q", "t"]).astype({"x": float, "y": float})
    return sdf, pdf


def resolver(df):
    return lambda n: typed(F.col(n), df.schema[n].dataType)


def random_formula(rng, depth=0):
    kind = rng.random()
    if depth > 2 or kind < 0.25:
        return rng.choice(["a", "b", "x", "y", "p", "3", "2.5", "-2", "0", "10"])
    if kind < 0.5:
        return f"({random_formula(rng, depth + 1)} {rng.choice('+-*')} {random_formula(rng, depth + 1)})"
    if kind < 0.7:  # (numpy divides by a truth value in a byte)
        return f"({random_formula(rng, depth + 1)} {rng.choice(['/', '//', '%'])} {rng.choice(['a', 'b', 'x', 'y', '(a - b)', '3', '2.5', '0', '-7'])})"
    if kind < 0.8:
        return f"({random_formula(rng, depth + 1)} {rng.choice(['<', '<=', '>', '>=', '==', '!='])} {random_formula(rng, depth + 1)})"
    if kind < 0.87:
        return f"({random_formula(rng, depth + 1)} ** {rng.choice(['2', '3', '0', '1'])})"
    if kind < 0.93:
        return f"{rng.choice(['abs', 'floor', 'ceil', 'sqrt', 'log', 'arctan'])}({rng.choice(['a', 'b', 'x', '(x * y)', '(a / b)', '(b - 3)'])})"
    if kind < 0.97:
        return f"((a > {random_formula(rng, depth + 1)}) {rng.choice(['and', 'or', '&', '|'])} (x < y))"
    return f"-{random_formula(rng, depth + 1)}"


def close(got, want):
    if got is None or isinstance(got, float) and math.isnan(got):
        return math.isnan(want)
    if math.isinf(want) or math.isinf(got):
        return got == want
    return got == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_parity_with_pandas_eval(spark):
    sdf, pdf = frames(spark)
    rng, cases = random.Random(21), []
    while len(cases) < 150:
        f = random_formula(rng)
        if not any(n in f for n in "abxypq") or f in [c[0] for c in cases]:
            continue
        with warnings.catch_warnings(), np.errstate(all="ignore"):
            warnings.simplefilter("ignore")
            try:
                want = pdf.eval(f, engine="python")
                rough = pdf.assign(a=pdf.a.astype(float), b=pdf.b.astype(float)).eval(f, engine="python") if "p" not in f else None
            except Exception:  # noqa: BLE001 - pandas refuses it
                continue
        if not hasattr(want, "dtype") or want.dtype == object:
            continue
        try:
            value = formula_value(f, resolver(sdf))
        except RuleError:
            continue  # truth values in arithmetic that numpy stores in a byte
        cases.append((f, value, want, rough))
    columns = [c for k, (_, v, _, _) in enumerate(cases) for c in (v.exact.cast("string").alias(f"e{k}"), v.approx.alias(f"r{k}"))]
    rows = sdf.orderBy("k").select(*columns).collect()
    whole = 0
    for k, (f, v, want, rough) in enumerate(cases):
        for i, r in enumerate(rows):
            exact, approx, w = r[f"e{k}"], r[f"r{k}"], want.iloc[i]
            if want.dtype == bool:
                assert (exact == "true") == bool(w), (f, i)
            elif want.dtype.kind == "i" and v.kind == "long":
                if exact is None or rough is not None and abs(rough.iloc[i]) > 2**62:
                    assert approx is None or abs(approx) > 2**52, (f, i)  # numpy wraps round here
                else:
                    whole += 1
                    assert int(exact) == int(w), (f, i, r)
            elif v.kind == "long" and exact is not None and abs(int(exact)) > BIG:
                pass  # one x // 0 makes pandas' whole column a double
            elif abs(approx or 0) < 2**52 and not (rough is not None and abs(float(w)) > 2**52):
                got = float(exact) if v.kind == "long" and exact is not None else approx
                big = any(abs(pdf[c].iloc[i]) > 2**52 for c in "ab" if c in f)
                assert big or close(got, float(w)), (f, i, got, w)
    assert whole > 500


@pytest.mark.parametrize("formula,kind,want", [
    ("a - b", "long", BIG + 1), ("a // 2", "long", BIG // 2), ("-a // 2", "long", (-BIG - 1) // 2), ("a % 10", "long", (BIG + 1) % 10),
    ("a * 3 - a", "long", 2 * BIG + 2), ("c + 1", "long", None), ("abs(-a)", "long", BIG + 1), ("a ** 2", "long", None), ("b ** 0", "long", 1),
    ("d + d2", "decimal", Decimal("1234567890123456790.33")), ("d - 1", "decimal", Decimal("1234567890123456788.11")),
    ("d2 * d2", "decimal", Decimal("1.4884")), ("d2 * 2", "decimal", Decimal("2.44")), ("d2 / 2", "double", 0.61), ("d * d", "double", 1234567890123456789.11**2),
    ("a > 2.5", "bool", True), ("1 < d2 < 2", "bool", True), ("not (a > b)", "bool", False), ("n > 1", "bool", False), ("n != 1", "bool", True),
    ("n + 1", "long", None), ("s == 'it & that'", "bool", True), ("s + 1", "double", None), ("a in [1, 9007199254740993]", "bool", True),
    ("`odd name` * 2", "long", 6), ("True", "bool", True), ("(a > b) * 1", "long", 1), ("(a > b) + (b > a)", "bool", True)])
def test_types_and_exact_results(spark, formula, kind, want):
    df = spark.sql("""SELECT 9007199254740993L AS a, 0L AS b, 9223372036854775807L AS c, CAST(NULL AS BIGINT) AS n, 3 AS `odd name`,
                      CAST(1234567890123456789.11 AS DECIMAL(21,2)) AS d, CAST(1.22 AS DECIMAL(5,2)) AS d2, 'it & that' AS s""")
    v = formula_value(formula, lambda n: typed(F.col(f"`{n}`"), df.schema[n].dataType))
    got = df.select(v.exact.alias("v"), v.approx.alias("r")).first()
    assert v.kind == kind and (got["v"] == want if not isinstance(want, float) else got["v"] == pytest.approx(want))
    if formula in ("c + 1", "a ** 2"):  # beyond 64 bits the doubles hold the value
        assert got["r"] == pytest.approx(eval(formula, {"a": BIG + 1, "c": 2**63 - 1}))


@pytest.mark.parametrize("formula", ["a +", "nosuch(a)", "sqrt(a, b)", "(a > b) - (b > a)", "not x", "x and p", "a if a else b", "a << 1", "zz + 1",
                                     "a.b", "[1]", "a in b", "abs(a, key=1)", "a is b"])
def test_refused_formulas(spark, formula):
    sdf, _ = frames(spark)
    df = sdf
    columns = {c: typed(F.col(c), df.schema[c].dataType) for c in df.columns}
    with pytest.raises(RuleError):
        formula_value(formula, columns.__getitem__)


def test_names():
    assert formula_names("abs(`a b` - total) // x + min_1") == ["a b", "total", "x", "min_1"]
    assert set(FUNCTIONS) >= {"abs", "log", "arctan2"}
    assert isinstance(formula_value("1 + 1", {}.__getitem__), Value)


def failures(spark, ddl, rows, *rules):
    ts = TableSet.from_frames(spark, {"KPI": spark.createDataFrame(rows, ddl)})
    got = {r["field"]: (r["status"], r["failed_count"]) for r in run_kpi(ts, {"formulavalidation": list(rules)}).summary.collect()}
    return [got[r["name"]] for r in rules]


def rule(name, formula, **more):
    return {"name": name, "formula": formula, "validationtype": "threshold", "operator": "<=", "threshold": 0} | more


def test_rules_on_large_longs(spark):
    rows = [(1, BIG + 1, 0, BIG, True), (1, BIG, 0, BIG, False), (2, 2**63 - 1, -5, BIG, None), (None, 3, 0, 3, True)]
    target = {"validationtype": "comparison", "sourcecolumns": ["a", "b"], "targetcolumn": "t"}
    got = failures(
        spark, "g long, a long, b long, t long, ok boolean", rows,
        rule("exact", "a - b", **target), rule("grouped", "a - b", aggregate=True, groupbycolumns=["g"], **target),
        rule("grouped threshold", "a - t", aggregate=True, groupbycolumns=["g"], sourcecolumns=["a", "t"]),
        rule("at least", "a - b", operator=">=", threshold=BIG + 1), rule("just above", "a - b", operator="<=", threshold=float(BIG)),
        rule("comparison as a number", "(a > t) * 1"), rule("whole division", "a // (b + 5)", operator="==", threshold=3),
        rule("flag", "ok", operator="==", threshold=1), rule("beyond 64 bits", "a - b", operator="<", threshold=9.3e18))
    #                exact: 2^53+1 against 2^53 and the long beyond 64 bits; grouped sums: 2^54+1 against 2^54
    assert got == [("F", 2), ("F", 2), ("F", 2), ("F", 2), ("F", 2), ("F", 2), ("F", 4), ("F", 1), ("P", 0)]


def test_decimal_rules(spark):
    rows = [(Decimal("0.10"), Decimal("0.20"), Decimal("0.30")), (Decimal("99999999999999999.91"), Decimal("0.01"), Decimal("99999999999999999.92")),
            (Decimal("99999999999999999.91"), Decimal("0.01"), Decimal("99999999999999999.93")), (None, Decimal("1"), Decimal("1"))]
    got = failures(spark, "a decimal(19,2), b decimal(19,2), t decimal(19,2)", rows,
                   rule("sum", "a + b", validationtype="comparison", sourcecolumns=["a", "b"], targetcolumn="t"),
                   rule("equal", "a + b - t", operator="==", threshold=0), rule("above", "a", operator=">", threshold=0.1))
    assert got == [("F", 2), ("F", 1), ("F", 1)]
