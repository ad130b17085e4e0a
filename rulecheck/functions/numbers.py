"""Numeric Column helpers: lenient parsing, rounding, precision, operators."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    IntegralType,
    NumericType,
    StringType,
)

# The comparison operators a rule may name.
OPERATORS: dict[str, Callable[[Column, Column], Column]] = {
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "==": lambda a, b: a == b,
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
}


class RuleError(ValueError):
    """A rule that cannot be bound (bad operator, unknown type, ...)."""


def apply_operator(left: Column, op: str, right) -> Column:
    if op not in OPERATORS:
        raise RuleError(f"Unsupported operator: {op}")
    if not isinstance(right, Column):
        right = F.lit(right)
    return OPERATORS[op](left, right)


def is_number_type(dtype: DataType) -> bool:
    """pandas ``select_dtypes('number')``: numeric, booleans excluded."""
    return isinstance(dtype, NumericType)


# Non-ASCII decimal digits and their values, derived from the Unicode
# database (Python's ``float`` accepts any of them).
_UNICODE_DIGITS = "".join(ch for ch in map(chr, range(0x80, 0x20000)) if unicodedata.decimal(ch, None) is not None)
_ASCII_DIGITS = "".join(str(unicodedata.decimal(ch)) for ch in _UNICODE_DIGITS)


def to_double(c: Column, dtype: DataType, python_float: bool = False) -> Column:
    """Text or number -> double, NULL when unparsable.

    Default: ``pd.to_numeric(errors='coerce')``. ``python_float``: Python's
    ``float(value)`` (cell checks, precision), which also takes Unicode
    whitespace around the number, non-ASCII decimal digits and ``_`` between
    digits. Both reject Java's ``d``/``f`` type suffixes, which Spark's cast
    would accept. Non-numeric, non-text types (dates, timestamps) give NULL.
    """
    if isinstance(dtype, (NumericType, BooleanType)):
        return c.cast("double")
    if not isinstance(dtype, StringType):
        return F.lit(None).cast("double")
    t = c
    if python_float:
        from .text import strip

        t = strip(c)
        t = F.when(t.rlike("[^\\x00-\\x7f]"), F.translate(t, _UNICODE_DIGITS, _ASCII_DIGITS)).otherwise(t)
        t = F.when(t.contains("_"), F.regexp_replace(t, "(?<=[0-9])_(?=[0-9])", "")).otherwise(t)
    java_suffix = t.rlike(r"(?i)[0-9.][df]\s*$")
    return F.when(~java_suffix, t.try_cast("double"))


def group_sum(c: Column, dtype: DataType) -> Column:
    """``sum`` of a column made numeric, 0 for a group without values.

    The method follows the type, never the values: integers, booleans and
    decimals of up to 28 digits are summed exactly, as decimals; doubles, text
    and wider decimals by the plain double sum."""
    if isinstance(dtype, (IntegralType, BooleanType)):
        return F.coalesce(F.sum(c.cast("bigint").cast("decimal(28,0)")), F.lit(0))
    if isinstance(dtype, DecimalType) and dtype.precision <= 28:
        return F.coalesce(F.sum(c), F.lit(0))
    return F.coalesce(F.sum(to_double(c, dtype)), F.lit(0.0))


def difference(a: Column, b: Column) -> Column:
    """``a - b`` as double; two decimals are subtracted before the conversion."""
    return F.coalesce(F.try_subtract(a, b).cast("double"), a.cast("double") - b.cast("double"))


def no_nan(c: Column) -> Column:
    """NaN -> NULL (pandas treats both as missing)."""
    return F.nanvl(c, F.lit(None).cast("double"))


def round_half_even(c: Column, places: int) -> Column:
    """numpy ``round``: ``rint(x * 10**p) / 10**p`` (half to even)."""
    scale = float(10 ** int(places))
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def safe_divide(n: Column, d: Column) -> Column:
    """IEEE division as pandas does it: x/0 = +-inf, 0/0 = missing (NULL)."""
    inf = F.lit(float("inf"))
    # the sign of a zero divisor counts: 1 / -0.0 = -inf (only the text form
    # of a double keeps the sign of zero; evaluated only when d == 0)
    neg_zero = d.cast("double").cast("string").startswith("-")
    signed_inf = F.when(neg_zero, -inf).otherwise(inf)
    return (
        F.when(d.isNull() | n.isNull(), F.lit(None).cast("double"))
        .when(d == 0, F.when(n > 0, signed_inf).when(n < 0, -signed_inf))
        .otherwise(F.try_divide(n.cast("double"), d.cast("double")))
    )


def safe_mod(n: Column, d: Column) -> Column:
    """Python/numpy modulo (sign of the divisor); x % 0 = missing."""
    n, d = n.cast("double"), d.cast("double")
    return F.when(d != 0, n - d * F.floor(F.try_divide(n, d)))


def format_decimal_places(fmt: Column) -> Column:
    """Decimals displayed by a spreadsheet number format, NULL for none/General.

    First ';' section; 0 when it has no '.'; else the run of '0'/'#' right
    after the last '.'.
    """
    section = F.split(fmt, ";", 2).getItem(0)
    places = F.when(~section.contains("."), F.lit(0)).otherwise(
        F.length(F.regexp_extract(section, r"^.*\.([0#]*)", 1))
    )
    return F.when(fmt.isNull() | (fmt == "") | (fmt == "General"), F.lit(None).cast("int")).otherwise(places)


def raw_precision_fails(v: Column, places: int) -> Column:
    """Value shows more than ``places`` decimals, tolerant to 1e-6 float noise.

    ``|v - round(v, p)| > 1e-6`` is exactly the case in which the value has
    more than p significant decimals; non-finite and NULL values pass.
    """
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    return F.coalesce(finite & (F.abs(v - F.bround(v, int(places))) > F.lit(1e-6)), F.lit(False))


def pct_deviation(cur: Column, prev: Column) -> Column:
    """``abs((cur - prev) / prev * 100)``; NULL when prev is NULL or 0."""
    return F.when(prev.isNotNull() & (prev != 0) & cur.isNotNull(), F.abs(difference(cur, prev) / prev.cast("double") * F.lit(100.0)))
