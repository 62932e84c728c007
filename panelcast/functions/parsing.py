"""Month, quarter, year and free-form date parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names, full and three-letter, case-sensitive.
MONTH_NAMES = {
    "January": 1, "February": 2, "March": 3, "April": 4, "May": 5, "June": 6,
    "July": 7, "August": 8, "September": 9, "October": 10, "November": 11, "December": 12,
    "Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "Jun": 6, "Jul": 7,
    "Aug": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Dec": 12,
}

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_TIME = r"(?:[T ].*)?$"
_ISO = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})" + _TIME
_DAY_FIRST = r"^([0-9]{1,2})[/.\-]([0-9]{1,2})[/.\-]([0-9]{4})" + _TIME


def to_number(text: Column) -> Column:
    """Numeric value of a string, null when it is not a plain number."""
    text = text.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_whole(text: Column) -> Column:
    """Number truncated toward zero, null when unparseable or out of range."""
    return to_number(text).try_cast("int")


def month_number(month: Column) -> Column:
    """Month 1-12 (or any whole number found) from a name or a number."""
    text = month.cast("string")
    names = F.create_map(*[F.lit(v) for pair in MONTH_NAMES.items() for v in pair])
    return F.coalesce(F.try_element_at(names, text), to_whole(text))


def quarter_month(quarter: Column) -> Column:
    """First month of a quarter given as 1-4 or Q1-Q4; anything else is null."""
    digit = F.regexp_extract(quarter.cast("string"), r"^Q?([1-4])$", 1)
    return F.when(digit != "", (digit.try_cast("int") - 1) * 3 + 1)


def first_of_month(year: Column, month: Column) -> Column:
    """Day 1 of the month; null when year or month is outside the calendar."""
    y = to_whole(year)
    return F.when(month.between(1, 12) & y.between(1, 9999), F.make_date(y, month, F.lit(1)))


def free_date(text: Column, legacy_dayfirst: bool = False) -> Column:
    """Date from ISO or day-first text; null when nothing fits.

    ``legacy_dayfirst`` reads ISO-looking text as year-day-month.
    """
    text = F.trim(text.cast("string"))
    iso_pattern = "yyyy-d-M" if legacy_dayfirst else "yyyy-M-d"
    iso = F.try_to_date(F.regexp_extract(text, _ISO, 1), iso_pattern)
    # Any of the usual separators is accepted and normalised to one pattern.
    parts = F.concat_ws("/", *[F.regexp_extract(text, _DAY_FIRST, i) for i in (1, 2, 3)])
    return F.when(text.rlike(_ISO), iso).when(
        text.rlike(_DAY_FIRST), F.try_to_date(parts, "d/M/yyyy")
    )
