"""The seven cell checks as Column predicates, plus their report labels.

Every predicate takes ``(column, dtype, params)`` and returns a non-NULL
boolean Column ("the value passes"). Blank cells are filtered by the caller.
The registry is open: ``register_check`` adds a check under a new name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .dates import date_check
from .numbers import to_double
from .text import strip

# The text patterns of three checks (applied to the stripped value).
NUMERIC_ONLY_RE = r"^\d+$"
EMAIL_RE = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
PHONE_RE = r"^(\(\d{3}\)\s?|\d{3}[-\s]?)\d{3}[-\s]?\d{4}$"

# Error message per check ({column} is the column name).
ERROR_MESSAGES = {
    "numeric_only": "Non-numeric value in column '{column}'",
    "email": "Invalid email in column '{column}'",
    "phone_number": "Invalid phone number in column '{column}'",
    "amount": "Invalid amount in column '{column}'",
    "number": "Out of range in column '{column}'",
    "date": "Invalid date in column '{column}'",
    "text_only": "Non-text value in column '{column}'",
}

# Fixed values: "required datatype" label per check.
REQUIRED_DATATYPE = {
    "numeric_only": "numeric",
    "email": "email",
    "phone_number": "phone_number",
    "amount": "amount",
    "number": "number",
    "date": "date",
    "text_only": "text_only",
}

# Order in which checks are tried when a column's check is inferred.
INFERENCE_PRIORITY = ["email", "phone_number", "date", "amount", "number", "numeric_only", "text_only"]

Predicate = Callable[[Column, DataType, Mapping], Column]


def _unicode(pattern: str) -> str:
    # Python's \d and \s are Unicode-aware; Java's are so under (?U).
    return "(?U)" + pattern


def numeric_only(c: Column, dtype: DataType, params: Mapping) -> Column:
    return F.coalesce(strip(c).rlike(_unicode(NUMERIC_ONLY_RE)), F.lit(False))


def email(c: Column, dtype: DataType, params: Mapping) -> Column:
    return F.coalesce(strip(c).rlike(EMAIL_RE), F.lit(False))


def phone_number(c: Column, dtype: DataType, params: Mapping) -> Column:
    return F.coalesce(strip(c).rlike(_unicode(PHONE_RE)), F.lit(False))


def in_range(c: Column, dtype: DataType, params: Mapping) -> Column:
    """``min <= float(value) <= max``; unparsable, NaN or non-numeric types fail."""
    v = to_double(c, dtype, python_float=True)
    lo = float(params.get("min_value", float("-inf")))
    hi = float(params.get("max_value", float("inf")))
    ok = v.isNotNull() & ~F.isnan(v) & (v >= F.lit(lo)) & (v <= F.lit(hi))
    return F.coalesce(ok, F.lit(False))


def date(c: Column, dtype: DataType, params: Mapping) -> Column:
    return date_check(c, dtype, params.get("format"), bool(params.get("strict_dates", False)))


def text_only(c: Column, dtype: DataType, params: Mapping) -> Column:
    """All letters or whitespace after stripping (so whitespace-only passes)."""
    return F.coalesce(strip(c).rlike(r"(?U)^[\p{L}\s\x1c-\x1f]*$"), F.lit(False))


CHECKS: dict[str, Predicate] = {
    "numeric_only": numeric_only,
    "email": email,
    "phone_number": phone_number,
    "amount": in_range,
    "number": in_range,
    "date": date,
    "text_only": text_only,
}


def register_check(name: str, predicate: Predicate, message: str, datatype_label: str) -> None:
    """Add a user check: ``predicate(col, dtype, params) -> Column[bool]``."""
    CHECKS[name] = predicate
    ERROR_MESSAGES[name] = message
    REQUIRED_DATATYPE[name] = datatype_label


def check_passes(name: str, c: Column, dtype: DataType, params: Mapping | None) -> Column | None:
    """Predicate of a known check, or None for an unknown name."""
    fn = CHECKS.get(name)
    return None if fn is None else fn(c, dtype, params or {})


def error_message(name: str, column: str) -> str:
    return ERROR_MESSAGES.get(name, "Invalid value in column '{column}'").format(column=column)


def datatype_label(name: str) -> str:
    return REQUIRED_DATATYPE.get(name, name)
