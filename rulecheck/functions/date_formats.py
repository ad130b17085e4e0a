"""Dates in local text forms: every cell by itself, or a whole column in the form of its first value.

A text is a date part and, after a blank or a ``T``, an optional time of day. Of two numbers before a year the first is
the month where it can be one, else the day. ``parse_cell`` reads each text in whatever form it has (two-digit years
and am/pm included). A column read as a whole has one form, that of its first value in row order; texts of another form are
missing. A form is the text with its numbers and names replaced by letters (``05-Jan-2024``: ``n-b-Y``) and, where two
numbers stand before the year, which of them comes first. It is found by an aggregate inside the plan (``column_form``), so
no job runs while a rule is bound.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import col
from .text import let, strip

_TIME = r"[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?"
_HALF_DAY = r"(?i)[T ]" + _TIME + " ?[ap]m$"
_LONGEST = 40  # no date and time is longer
# English month names; three letters are enough.
_MONTH = ("(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:tember)?|oct(?:ober)?|"
          "nov(?:ember)?|dec(?:ember)?)")
#: What a date part may look like: Y a year, C year, month and day in one, n one or two digits, b and B a month's short or full name.
_DATES = r"Y([-/.])n\1n|n([-/.])n\2Y|C|nbY|n-b-Y|n [bB] Y|[bB] n, Y|b n Y|b-n-Y|Y-b-n|Y-n|Y"
_SHORT_YEARS = r"n([-/.])n\3n|n-b-n|n b n"
#: Java patterns after all separators have become ``-``; the order of two numbers is treated apart.
_PATTERNS = ("yyyy-M-d", "yyyyMMdd", "d-MMM-yyyy", "MMM-d-yyyy", "yyyy-MMM-d", "yyyy-MM", "yyyy")


def _letters(date: Column) -> Column:
    """The date part with Y, C, n, b, B in place of its numbers and names."""
    for regex, letter in ((r"[A-Za-z]{4,}", "%"), (r"[A-Za-z]{3}", "b"), ("%", "B"), ("[0-9]{8}", "C"), ("[0-9]{4}", "Y"), ("[0-9]{1,2}", "n")):
        date = F.regexp_replace(date, regex, letter)
    return date


def _time_letters(time: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(time, r"\.[0-9]+", ".f"), "[0-9]{1,2}", "n")


def _plain(date: Column) -> Column:
    """Separators as single ``-``, names cut to three letters and set apart from numbers; NULL for a name of no month."""
    cut = F.regexp_replace(F.regexp_replace(date, "([A-Za-z]{3})[A-Za-z]*", "-$1-"), "[-/., ]+", "-")
    known = ~date.rlike("[A-Za-z]") | date.rlike(f"(?i)^[^a-z]*{_MONTH}[^a-z]*$")
    return F.when(known, F.btrim(cut, F.lit("-")))


def _day(plain: Column, first: Column, short_years: bool) -> Column:
    """Midnight of a plain date; ``first``: 'M' or 'D' where the order of two numbers is known, else NULL."""
    def read(pattern: str) -> Column:
        return F.try_to_timestamp(plain, F.lit(pattern))

    month_first = F.when(~first.eqNullSafe(F.lit("D")), F.when(plain.rlike("^(1[0-2]|0?[1-9])-"), read("M-d-yyyy")))
    day_first = F.when(~first.eqNullSafe(F.lit("M")), read("d-M-yyyy"))
    ways = [F.when(plain.rlike("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), F.coalesce(month_first, day_first)), *map(read, _PATTERNS)]
    if short_years:
        near = F.coalesce(read("M-d-yy"), read("d-M-yy"), read("d-MMM-yy"))
        late = F.year(near) >= F.year(F.current_date()) + 50  # within 50 years of this one
        ways.insert(0, F.when(plain.rlike("^[0-9]{1,2}-[0-9A-Za-z]{1,3}-[0-9]{2}$"), F.when(late, F.add_months(near, -1200).cast("timestamp")).otherwise(near)))
    return F.coalesce(*ways)


def _moment(day: Column, time: Column) -> Column:
    """The moment of a day (a timestamp at midnight) and a time of day as text, which may be empty."""
    return F.when(time == "", day.cast("timestamp_ntz")).otherwise(
        F.concat(F.date_format(day, "yyyy-MM-dd "), F.substring(time, 2, 20)).try_cast("timestamp_ntz"))


def parse_cell(c: Column) -> Column:
    """Text -> timestamp_ntz, each text in its own form; NULL where it has none. ISO texts, the cheap case, come first."""
    iso = F.when(c.rlike(r"^\s*[0-9]{4}(-|\s*$)"), strip(c).try_cast("timestamp_ntz"))
    return F.coalesce(iso, F.when(F.length(c).between(4, 200) & c.rlike("[0-9]"), let(strip(c), _any_form)))


def _any_form(t: Column) -> Column:
    def read(clock: Column, date: Column) -> Column:
        spelt = F.regexp_replace(F.regexp_replace(F.upper(F.substring(clock, 2, 30)), r"^([0-9]+:[0-9]+) ?([AP])", "$1:00 $2"), "([0-9])([AP])", "$1 $2")
        usual = F.length(t).between(4, _LONGEST) & _letters(date).rlike(f"^(?:{_DATES}|{_SHORT_YEARS})$")

        def moment(day: Column) -> Column:
            late = F.try_to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd "), spelt), F.lit("yyyy-MM-dd h:mm:ss a")).cast("timestamp_ntz")
            return F.when(clock.rlike("(?i)m$"), late).otherwise(_moment(day, clock))

        return F.when(usual, let(let(_plain(date), lambda p: _day(p, F.lit(None).cast("string"), True)), moment))

    return let(F.regexp_extract(t, r"(?i)[T ]" + _TIME + "(?: ?[ap]m)?$", 0),
               lambda clock: let(F.substring(t, F.lit(1), F.length(t) - F.length(clock)), lambda date: read(clock, date)))


def _split(t: Column) -> tuple[Column, Column]:
    """(date part, time of day with the sign before it)."""
    time = F.regexp_extract(t, f"[T ]{_TIME}$", 0)
    return F.substring(t, F.lit(1), F.length(t) - F.length(time)), time


def form_of(c: Column) -> Column:
    """The form of a text, like ``n-b-Y`` or ``n/n/Y n:n M``; NULL where it is not recognised. Names of months must be written
    ``Jan`` or ``January``; May counts as a full name."""
    def named(date: Column, time: Column, letters: Column, plain: Column) -> Column:
        first = F.when(letters.rlike("^n.n.Y$"), F.when(plain.rlike("^(1[0-2]|0?[1-9])-"), F.lit("M")).otherwise(F.lit("D")))
        written = ~date.rlike("[A-Za-z]") | date.rlike("^[^A-Za-z]*[A-Z][a-z]+[^A-Za-z]*$")
        known = letters.rlike(f"^(?:{_DATES})$") & written & _day(plain, first, False).isNotNull()
        full = F.when(date.contains("May"), F.translate(letters, "b", "B")).otherwise(letters)
        return F.when(known, F.concat_ws(" ", F.concat(full, _time_letters(time)), first))

    def parts(t: Column) -> Column:
        date, time = _split(t)
        return let(F.struct(date.alias("d"), time.alias("t")), lambda x: let(
            F.struct(_letters(x["d"]).alias("l"), _plain(x["d"]).alias("p")), lambda y: named(x["d"], x["t"], y["l"], y["p"])))

    return F.when(F.length(c) <= 200, let(strip(c), lambda t: F.when(F.length(t) <= _LONGEST, parts(t))))


def _forms_of(t: Column) -> Column:
    """Map of the forms a text can have to the moments it then means."""
    def entry(form: Column, plain: Column, first: str | None, time: Column) -> Column:
        return F.struct(form.alias("form"), _moment(_day(plain, F.lit(first).cast("string"), False), time).alias("moment"))

    def entries(letters: Column, date: Column, time: Column, plain: Column) -> Column:
        full = F.translate(letters, "b", "B")
        return F.when(date.rlike("^[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}$"), F.array(*[
            entry(F.concat(letters, F.lit(f" {first}")), plain, first, time) for first in "MD"])).when(
                date.rlike("(?i)may"), F.array(entry(letters, plain, None, time), entry(full, plain, None, time))).otherwise(
                    F.array(entry(letters, plain, None, time)))

    date, time = _split(t)
    return F.map_from_entries(let(F.struct(F.concat(_letters(date), _time_letters(time)).alias("l"), date.alias("d"), time.alias("t"), _plain(date).alias("p")),
                                  lambda x: entries(x["l"], x["d"], x["t"], x["p"])))


def parse_as(c: Column, form: Column) -> Column:
    """Texts of one form -> timestamp_ntz, all others NULL. A NULL form: every text in its own form."""
    return _in_form(c, form, parse_cell(c), let(strip(c), _forms_of))


def _in_form(c: Column, form: Column, alone: Column, forms: Column) -> Column:
    plain_iso = (form == "Y-n-n") & c.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")  # needs no letters
    return F.when(plain_iso, c.try_cast("timestamp_ntz")).when(form.isNull(), alone).when(
        c.rlike("[0-9]"), F.try_element_at(forms, form))


@lru_cache(maxsize=1024)
def _of_name(name: str) -> tuple[Column, Column]:
    """The long expressions over a column, made once for each name (like ``names.col``)."""
    return parse_cell(col(name)), let(strip(col(name)), _forms_of)


def parse_column(name: str, form: Column | None) -> Column:
    """``parse_cell`` or, with a form, ``parse_as`` of a column by its name."""
    alone, forms = _of_name(name)
    return alone if form is None else _in_form(col(name), form, alone, forms)


def first_texts(frame: DataFrame, text: Column, order: list[Column], by: list[Column]) -> DataFrame:
    """``first``: the first text in row order that is not blank (one row, or one for each value of ``by``)."""
    some = F.when(strip(text) != "", F.struct(*order))
    first = F.min_by(text, some).alias("first")  # rows without an order are left out
    return frame.groupBy(*by).agg(first) if by else frame.agg(first)


def column_form(frame: DataFrame, text: Column, order: list[Column]) -> Column:
    """The form of a whole column, found in the plan that uses it (a scalar subquery)."""
    return first_texts(frame, text, order, []).select(form_of(F.col("first"))).scalar()
