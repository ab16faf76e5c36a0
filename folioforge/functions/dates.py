"""Column expressions for calendar values and ISO date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso(value: Column) -> Column:
    """ISO text of a date, the form in which the corpus stores and compares dates."""
    return F.date_format(value, "yyyy-MM-dd")


def to_date(value: Column) -> Column:
    """Typed date of ISO text; null when the text is not a date."""
    return value.try_cast("date")


def filled(value: Column) -> Column:
    """Neither null nor empty."""
    return value.isNotNull() & (value != "")


def format_api_date(value: Column) -> Column:
    """``YYYY-MM-DD`` or ``ddmmyyyy`` text -> ``ddmmyyyy`` text; else null."""
    parsed = F.coalesce(
        F.try_to_date(value, "yyyy-MM-dd"), F.try_to_date(value, "ddMMyyyy")
    )
    return F.date_format(parsed, "ddMMyyyy")


def month_start(value: Column) -> Column:
    return F.trunc(value, "MM")


def month_end(value: Column) -> Column:
    return F.last_day(value)


def decade(value: Column) -> Column:
    return F.year(value) - F.pmod(F.year(value), F.lit(10))


def coverage_year(value: Column) -> Column:
    return F.substring(value, 1, 4)


def floor_day(value: Column) -> Column:
    """The last calendar day whose ISO text is not after ``value`` in text order; null before year 1.

    Ranges of days compare texts. A text that is no day lies between two days: it is inside a
    range exactly when its floor day is, and isn't the range's last day.
    """
    start = F.substring(value, 1, 10)
    valid = start.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & (start >= "0001-01-01") & start.try_cast("date").isNotNull()
    year = F.regexp_extract(value, "^([0-9]{4})", 1)

    def last_of(first: int, last: Column, text) -> Column:
        return F.array_max(F.filter(F.transform(F.sequence(F.lit(first), last), text), lambda x: x <= value))

    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    year_end = lambda n: F.when(n > 0, F.concat(F.lpad(n.cast("string"), 4, "0"), F.lit("-12-31")))
    month = last_of(1, F.lit(12), lambda n: F.concat_ws("-", year, two(n), F.lit("01")))
    length = F.day(F.last_day(month.cast("date")))
    day = last_of(1, length, lambda n: F.concat(F.substring(month, 1, 8), two(n)))
    in_year = F.when(month.isNull(), year_end(year.cast("int") - 1)).otherwise(day)
    # Fewer than four digits: what follows them decides on which side of that century or decade.
    digits = F.regexp_extract(value, "^([0-9]{0,3})", 1)
    follows = F.substring(value, F.length(digits) + 1, F.lit(1))
    before = year_end(F.rpad(digits, 4, "0").cast("int") - 1)
    irregular = F.when(year > "0000", in_year).when(year != "", None).when(follows > "9", year_end(F.rpad(digits, 4, "9").cast("int"))).otherwise(before)
    return F.when(valid, start).otherwise(irregular)
