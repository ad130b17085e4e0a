"""Column functions on literal vectors (golden values from the documented behaviour)."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from rulecheck.functions import cells, dates, formula, numbers, text


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_precision_raw_values(spark):
    vals = [123.0, 123.4, 123.45, 123.00, 123.456, 123.4567, None, float("inf")]
    got = _eval(spark, vals, lambda c: numbers.raw_precision_fails(c, 2), "double")
    assert got == [False, False, False, False, True, True, False, False]


def test_format_decimal_places(spark):
    fmts = ["#,##0.00", "#,##0.0000", "General", "0", "", None, "0.00;[Red]-0.000", "0.0#%"]
    got = _eval(spark, fmts, numbers.format_decimal_places)
    assert got == [2, 4, None, 0, None, None, 2, 2]


def test_round_half_even(spark):
    got = _eval(spark, [0.125, 0.135, 2.5, -2.5], lambda c: numbers.round_half_even(c, 2), "double")
    assert got == [0.12, 0.14, 2.5, -2.5]


def test_phone_email_numeric_text(spark):
    phone = _eval(spark, ["123-456-7890", "(123) 456-7890", "123 456 7890", "12-345-6789", " 1234567890 "],
                  lambda c: cells.phone_number(c, StringType(), {}))
    assert phone == [True, True, True, False, True]
    email = _eval(spark, ["a@x.com", "bad-email", "c@y.co.uk", "a b@x.com"], lambda c: cells.email(c, StringType(), {}))
    assert email == [True, False, True, False]
    num = _eval(spark, ["2001", "20A3", " 42 ", "-1", "1.0"], lambda c: cells.numeric_only(c, StringType(), {}))
    assert num == [True, False, True, False, False]
    txt = _eval(spark, ["Sales Dept", "R&D", "   ", "Zoë", "abc1"], lambda c: cells.text_only(c, StringType(), {}))
    assert txt == [True, False, True, True, False]


def test_amount_parsing(spark):
    p = {"min_value": 0, "max_value": 100}
    got = _eval(spark, ["95", "150", "abc", "1d", " 12 ", "nan", "inf"], lambda c: cells.in_range(c, StringType(), p))
    assert got == [True, False, False, False, True, False, False]


def test_strptime_semantics(spark):
    vals = ["2024-01-05", "2024-1-5", "2024-02-30", "2024/01/05", " 2024-01-05", "2024-01-05x", "0000-01-01"]
    got = _eval(spark, vals, lambda c: dates.strptime_ok(c, "%Y-%m-%d"))
    assert got == [True, True, False, False, False, False, False]
    got = _eval(spark, ["05 Jan 2024", "5 january 2024", "31 Feb 2024"], lambda c: dates.strptime_ok(c, "%d %b %Y"))
    assert got == [True, False, False]


def test_stale_cutoff(spark):
    df = spark.createDataFrame([("2026-04-02",), ("2026-03-07",)], "v string")
    cut = dates.stale_cutoff(3, "2026-06-08")
    got = [r[0] for r in df.select(dates.to_timestamp_lenient(F.col("v"), StringType()) < cut).collect()]
    assert got == [False, True]


def test_normalise_text(spark):
    got = _eval(spark, ["  Not Applicable ", None, "X", " y\t"], lambda c: text.norm_text(c, ["not applicable"]))
    assert got == ["", "", "x", "y"]


def test_formula_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (1.0, -0.0), (3.0, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(formula.formula_column("(a / b) * 100", lambda n: F.col(n))).collect()]
    assert got == [float("inf"), None, float("-inf"), float("-inf"), 150.0]
    assert formula.formula_names("((A + B) / C) * 100") == ["A", "B", "C"]


def test_to_double_types(spark):
    df = spark.createDataFrame([("1e3",)], "v string")
    assert df.select(numbers.to_double(F.col("v"), StringType())).first()[0] == 1000.0
    assert df.select(numbers.to_double(F.lit(2.5), DoubleType())).first()[0] == 2.5


def test_group_sum_follows_the_type(spark):
    row = lambda df, kind: df.agg(numbers.group_sum(F.col("v"), kind)).first()[0]
    longs = spark.createDataFrame([(2**53,), (1,), (None,)], "v long")
    assert int(row(longs, LongType())) == 2**53 + 1
    tiny = spark.createDataFrame([(1e-19,)] * 10, "v double")
    assert abs(row(tiny, DoubleType()) - 1e-18) < 1e-32
    big = spark.createDataFrame([(1e20,), (0.25,), (None,)], "v double")
    assert row(big, DoubleType()) == 1e20
    text = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert row(text, StringType()) == 1.5
    assert row(text.filter("v = 'x'"), StringType()) == 0.0
    assert row(longs.filter("v IS NULL"), LongType()) == 0


def test_difference_of_long_sums_is_exact(spark):
    df = spark.sql("SELECT CAST(9007199254740993 AS DECIMAL(38,0)) a, CAST(9007199254740992 AS DECIMAL(38,0)) b, 1.5D c")
    assert df.select(numbers.difference(F.col("a"), F.col("b")), numbers.difference(F.col("c"), F.lit(0))).first()[:] == (1.0, 1.5)
