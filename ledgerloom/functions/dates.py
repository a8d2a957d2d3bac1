"""Dates from parts that may be impossible, centuries from two digits, and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_of(year: Column, month: Column, day: Column) -> Column:
    """The date, or null if there is none."""
    parts = F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))
    return _date(parts, year.isNotNull() & month.isNotNull() & day.isNotNull())


def _date(text: Column, there: Column) -> Column:
    return F.when(there, text.try_cast("date"))


def date_from(text: Column, form: str) -> Column:
    """Parsed by a datetime pattern, or null."""
    return F.try_to_date(text, form)


def compact_date(text: Column) -> Column:
    """yyyyMMdd, or null."""
    digits = F.when(F.trim(text).rlike("^[0-9]{8}$"), F.trim(text))
    return _date(F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)), digits.isNotNull())


def century(yy: Column, pivot: int = 79) -> Column:
    """Two digits above the pivot are of the 1900s, others of the 2000s."""
    return F.when(yy > pivot, yy + 1900).otherwise(yy + 2000)


def full_year(year: Column, below: int = 100) -> Column:
    """Years below 100 are of the 1900s."""
    return F.when(year < below, year + 1900).otherwise(year)


def birth_year(yy: Column, court_year: Column, slack: int = 3) -> Column:
    """Two-digit birth years later than the court year, by more than the slack, are of the 1800s."""
    return F.when(yy >= 100, yy).when(yy - (court_year - 1900) > slack, yy + 1800).otherwise(yy + 1900)


def age_at(birth: Column, at: Column) -> Column:
    """Completed years."""
    return F.year(at) - F.year(birth) - F.when((F.month(at) < F.month(birth)) | ((F.month(at) == F.month(birth)) & (F.dayofmonth(at) < F.dayofmonth(birth))), 1).otherwise(0)


def age_by_month(birth_y: Column, birth_m: Column, at_y: Column, at_m: Column) -> Column:
    """Completed years by months; an unknown month counts as passed."""
    return at_y - birth_y - F.when(at_m < birth_m, 1).otherwise(0)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def year_of_number(c: Column) -> Column:
    """The year of a yyyymmdd number."""
    return F.floor(c / 10000).cast("int")


def year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))
