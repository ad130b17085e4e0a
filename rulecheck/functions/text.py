"""Text normalisation and blank tests as Spark Columns (no UDFs).

Python's ``str.strip()`` removes every Unicode whitespace character plus the
information separators U+001C..U+001F; Java's ``\\s`` only does so under the
``(?U)`` flag and never covers the separators, hence the explicit class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# The characters ``str.strip()`` removes: those for which ``str.isspace()`` is
# true, derived from Python itself rather than listed by hand.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, whatever the number of its uses. The body is evaluated outside of
    generated code, so a rare and long path does not bloat the code of the usual one."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_text(c: Column) -> Column:
    """Text form of any value (``str(value)`` analogue)."""
    return c.cast("string")


def strip(c: Column) -> Column:
    """``str(value).strip()``; NULL stays NULL. ``btrim`` with the whitespace
    set: a character scan, no regex."""
    return F.btrim(as_text(c), F.lit(WHITESPACE))


def norm_text(c: Column, blanks: Iterable[str] | None = None) -> Column:
    """Trimmed lower-case text; NULL -> ''; configured blank tokens -> ''."""
    t = F.coalesce(F.lower(strip(c)), F.lit(""))
    tokens = sorted({str(b).strip().lower() for b in (blanks or [])} - {""})
    if tokens:
        t = F.when(t.isin(tokens), F.lit("")).otherwise(t)
    return t


def is_blank_norm(c: Column, dtype: DataType, blanks: Iterable[str] | None = None) -> Column:
    """``norm_text(c, blanks) == ''`` without text work for non-text types
    (their text form never carries surrounding whitespace)."""
    tokens = sorted({str(b).strip().lower() for b in (blanks or [])} - {""})
    if isinstance(dtype, StringType):
        t = strip(c)
        blank = c.isNull() | (t == F.lit(""))
        if tokens:
            # lower-casing only texts as long as some token (cheap length test first)
            lengths = sorted({len(x) for x in tokens})
            blank = blank | F.coalesce(F.length(t).isin(lengths) & F.lower(t).isin(tokens), F.lit(False))
        return blank
    if not tokens:
        return c.isNull()
    return c.isNull() | F.lower(c.cast("string")).isin(tokens)


def is_blank_loose(c: Column) -> Column:
    """NULL or whitespace-only (used by the KPI null check)."""
    return c.isNull() | (strip(c) == F.lit(""))


def is_blank_cell(c: Column, dtype: DataType) -> Column:
    """NULL or exactly '' (used by cell checks: whitespace-only is checked)."""
    if isinstance(dtype, StringType):
        return c.isNull() | (c == F.lit(""))
    return c.isNull()


def aligned_keys(a: Column, a_type, b: Column, b_type) -> tuple[Column, Column]:
    """Two key columns in one type: as they are if the types agree or are both numbers, else both as trimmed text."""
    from pyspark.sql.types import NumericType

    if a_type == b_type or isinstance(a_type, NumericType) and isinstance(b_type, NumericType):
        return a, b
    return key_text(a.cast("string")), key_text(b.cast("string"))


def key_text(c: Column) -> Column:
    """Key compared as trimmed text."""
    return strip(c)
