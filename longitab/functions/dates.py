"""Date parsing and calendar arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .recode import _c


def parse_date(col: Column | str) -> Column:
    """Date part of a date or timestamp text; bad text becomes null."""
    return _c(col).try_cast("date")


def parse_timestamp(col: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text with the seconds; anything else is null."""
    return F.try_to_timestamp(_c(col), F.lit("yyyy-MM-dd HH:mm:ss"))


def years_completed(start: Column | str, end: Column | str) -> Column:
    """Whole years from start to end, towards zero when end lies before."""
    a, b = _c(start).cast("date"), _c(end).cast("date")
    return F.when(b >= a, _whole_years(a, b)).otherwise(-_whole_years(b, a))


def years_fractional(start: Column | str, end: Column | str) -> Column:
    """Whole years plus the share of the running year, by anniversaries."""
    a, b = _c(start).cast("date"), _c(end).cast("date")
    return F.when(b >= a, _part_years(a, b)).otherwise(-_part_years(b, a))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def weeks_between(start: Column | str, end: Column | str, digits: int = 2) -> Column:
    return F.bround(days_between(start, end) / F.lit(7.0), digits)


def _month_day(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def _whole_years(a: Column, b: Column) -> Column:
    return F.year(b) - F.year(a) - F.when(_month_day(b) < _month_day(a), 1).otherwise(0)


def _part_years(a: Column, b: Column) -> Column:
    n = _whole_years(a, b)
    last = F.add_months(a, n * 12)
    following = F.add_months(a, (n + 1) * 12)
    return n + F.datediff(b, last) / F.datediff(following, last)
