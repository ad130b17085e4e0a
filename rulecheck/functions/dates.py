"""Date parsing as Spark Columns.

* ``strptime_ok``: the ``date`` cell check, i.e. "does ``datetime.strptime``
  accept this text with this format". Python builds a regex from the format,
  takes the first (priority-ordered) match from the start of the text, demands
  that it consumes the whole text and then builds a ``datetime``. The same is
  done here with ``regexp_extract`` + a length test + calendar validation, so
  no Python runs per row.
* ``to_timestamp_lenient``: ``pd.to_datetime(errors='coerce')``; the text forms
  are those of ``date_formats``.
* ``stale_cutoff``: midnight of ``as_of`` minus N calendar months.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from .date_formats import parse_as, parse_cell
from .numbers import RuleError
from .text import strip

# Regexes of the numeric strptime directives (Python, C locale).
_DIRECTIVE_RE = {
    "d": "(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])",
    "m": "(1[0-2]|0[1-9]|[1-9])",
    "Y": "([0-9][0-9][0-9][0-9])",
    "y": "([0-9][0-9])",
    "H": "(2[0-3]|[01][0-9]|[0-9])",
    "I": "(1[0-2]|0[1-9]|[1-9])",
    "M": "([0-5][0-9]|[0-9])",
    "S": "(6[01]|[0-5][0-9]|[0-9])",
    "f": "([0-9]{1,6})",
    "p": "(am|pm)",
    "j": "(36[0-6]|3[0-5][0-9]|[12][0-9][0-9]|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9])",
}
# English month names and abbreviations, January first.
_MONTHS = ["january", "february", "march", "april", "may", "june", "july",
           "august", "september", "october", "november", "december"]
_MONTHS_ABBR = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# English weekday names and abbreviations, Monday first.
_WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
_WEEKDAYS_ABBR = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
# Java DateTimeFormatter letters for each directive (rendering).
_JAVA = {"d": "dd", "m": "MM", "Y": "yyyy", "y": "yy", "H": "HH", "I": "hh", "M": "mm",
         "S": "ss", "f": "SSSSSS", "p": "a", "b": "MMM", "B": "MMMM"}
_TIME_DIRECTIVES = set("HIMSfp")


def _month_alt(names: list[str]) -> str:
    # longest first so that e.g. "june" is preferred over "jun"
    return "(" + "|".join(sorted(names, key=len, reverse=True)) + ")"


def _compile(fmt: str) -> tuple[str, list[str]]:
    """strptime format -> (Java regex, directive of each capture group)."""
    if fmt is None:
        raise RuleError("date check needs a 'format'")
    pieces = _pieces(fmt)
    return "(?i)^(" + "".join(regex for _, regex in pieces) + ")", [d for d, _ in pieces if d]


def _int(c: Column) -> Column:
    return F.trim(c).try_cast("int")


# Years without a 29th of February are left out by these.
_LEAP = {"Y": "(?:[0-9]{2}(?:0[48]|[2468][048]|[13579][26])|(?:[02468][048]|[13579][26])00)", "y": "(?:0[048]|[2468][048]|[13579][26])"}
_SHORT_MONTHS = {"m": "(?:0?[469]|11)", "b": "(?:apr|jun|sep|nov)", "B": "(?:april|june|september|november)"}
_FEBRUARY = {"m": "0?2", "b": "feb", "B": "february"}


def _pieces(fmt: str) -> list[tuple[str | None, str]]:
    """(directive or None, regex) of each part of a format, in order."""
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%":
            if i + 1 >= len(fmt):
                raise RuleError(f"stray % in date format {fmt!r}")
            d, i = fmt[i + 1], i + 2
            if d == "%":
                out.append((None, "%"))
                continue
            if d in (x for x, _ in out):
                raise RuleError(f"directive %{d} repeated in {fmt!r}")
            names = {"B": _MONTHS, "b": _MONTHS_ABBR, "A": _WEEKDAYS, "a": _WEEKDAYS_ABBR}
            if d not in _DIRECTIVE_RE and d not in names:
                raise RuleError(f"unsupported date directive %{d} in {fmt!r}")
            out.append((d, _DIRECTIVE_RE.get(d) or _month_alt(names[d])))
        elif ch.isspace():
            while i < len(fmt) and fmt[i].isspace():
                i += 1
            out.append((None, r"\s+"))
        else:
            out.append((None, re.escape(ch)))
            i += 1
    return out


def _told_apart(pieces: list[tuple[str | None, str]]) -> bool:
    """Whether no text can be cut into the directives in two ways (but for blanks): each one of varying length is followed
    by something that it cannot hold, or by the end."""
    return not any(d not in (None, "Y", "y") and (after is not None or literal != r"\s+" and literal[-1].isalnum())
                   for (d, _), (after, literal) in zip(pieces, pieces[1:], strict=False))


def _one_regex(fmt: str) -> str | None:
    """One Java regex for the texts that have the format and are days of the calendar; None where it takes more than that.

    The atomic group takes the first match as strptime does and gives nothing back; the refusals in front of it are the
    same format with days that their month lacks."""
    pieces = _pieces(fmt)
    found = [d for d, _ in pieces if d]
    month = next((d for d in found if d in _FEBRUARY), None)
    year = next((d for d in ("Y", "y") if d in found), None)
    if "j" in found or not found or month and "m" in found and month != "m":
        return None

    def spelt(**swap: str) -> str:
        return "".join(swap.get(d, regex) for d, regex in pieces)

    wrong = []
    if "Y" in found:
        wrong.append(spelt(Y="0000"))
    if "S" in found:
        wrong.append(spelt(S="6[01]"))
    if "d" in found and month:
        wrong += [spelt(**{"d": "31", month: _SHORT_MONTHS[month]}), spelt(**{"d": "3[01]", month: _FEBRUARY[month]})]
        if year:
            wrong.append(spelt(**{"d": "29", month: _FEBRUARY[month], year: f"(?!{_LEAP[year]})" + _DIRECTIVE_RE[year]}))
        else:  # the year is 1900
            wrong.append(spelt(**{"d": "29", month: _FEBRUARY[month]}))
    if wrong and not _told_apart(pieces):
        return None
    return r"(?i)\A" + "".join(f"(?!{w}\\z)" for w in wrong) + f"(?>{spelt()})\\z"


def strptime_ok(text: Column, fmt: str) -> Column:
    """True when ``datetime.strptime(text, fmt)`` would succeed (NULL -> False): one match a cell, but for formats whose
    directives run into each other."""
    regex = _one_regex(fmt)
    return _strptime_by_groups(text, fmt) if regex is None else F.coalesce(text.rlike(regex), F.lit(False))


def _strptime_by_groups(text: Column, fmt: str) -> Column:
    """The groups of the first match, then the calendar."""
    regex, groups = _compile(fmt)
    whole = F.regexp_extract(text, regex, 1)
    matched = (whole == text) & ((F.length(text) > 0) | F.lit(fmt == ""))
    if not groups:
        return F.coalesce(matched, F.lit(False))
    g = {d: F.regexp_extract(text, regex, k + 2) for k, d in enumerate(groups)}
    year = F.lit(1900)
    if "Y" in g:
        year = _int(g["Y"])
    elif "y" in g:
        yy = _int(g["y"])
        year = F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)
    month = F.lit(1)
    if "m" in g:
        month = _int(g["m"])
    elif "B" in g or "b" in g:
        names = _MONTHS if "B" in g else _MONTHS_ABBR
        txt = F.lower(g["B"] if "B" in g else g["b"])
        month = F.lit(None).cast("int")
        for k in range(len(names) - 1, -1, -1):
            month = F.when(txt == names[k], F.lit(k + 1)).otherwise(month)
    valid = (year >= 1) & (year <= 9999)
    if "d" in g:
        day = _int(g["d"])
        last = F.dayofmonth(F.last_day(F.make_date(F.when(valid, year).otherwise(F.lit(2000)), month, F.lit(1))))
        valid = valid & (day <= last)
    if "S" in g:
        valid = valid & (_int(g["S"]) <= 59)
    return F.coalesce(matched & valid, F.lit(False))


def render_pattern(fmt: str) -> str:
    """Java pattern that renders a value the way ``strftime(fmt)`` does."""
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            d = fmt[i + 1]
            out.append("%" if d == "%" else _JAVA.get(d, ""))
            i += 2
        else:
            ch = fmt[i]
            out.append("''" if ch == "'" else (f"'{ch}'" if ch.isalpha() else ch))
            i += 1
    return "".join(out)


def date_check(c: Column, dtype: DataType, fmt: str, strict_dates: bool = False) -> Column:
    """The ``date`` cell check on a value of any type."""
    _compile(fmt)  # validate the format when the rule is bound
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        if strict_dates:
            # the value is rendered as 'YYYY-MM-DD HH:MM:SS' and then parsed
            rendered = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
            return strptime_ok(rendered, fmt)
        if isinstance(dtype, DateType) or _TIME_DIRECTIVES & set(_compile(fmt)[1]):
            return c.isNotNull()
        ts = c.cast("timestamp_ntz")
        return F.coalesce(ts == F.date_trunc("day", ts), F.lit(False))
    return strptime_ok(c.cast("string"), fmt)


def to_timestamp_lenient(c: Column, dtype: DataType, formats=None, form: Column | None = None) -> Column:
    """Any value -> timestamp_ntz or NULL.

    Texts are read in whatever form each has (``date_formats.parse_cell``), or
    all in the form of the number ``form``. ``formats`` (Java patterns)
    replaces both with an explicit list."""
    if isinstance(dtype, (TimestampNTZType, DateType, TimestampType)):
        return c.cast("timestamp_ntz")
    if not isinstance(dtype, StringType):
        return F.lit(None).cast("timestamp_ntz")
    if formats:
        t = strip(c)
        return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats]).cast("timestamp_ntz")
    return parse_cell(c) if form is None else parse_as(c, form)


def stale_cutoff(months: int, as_of: _dt.date | str | None = None) -> Column:
    """Midnight of ``as_of`` (default: today) minus ``months`` calendar months."""
    base = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.add_months(base, -int(months)).cast("timestamp_ntz")
