"""Date expressions with an explicit as-of date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_before(as_of: date, months: int) -> tuple[int, int]:
    """(year, month) that lies `months` calendar months before the month of `as_of`."""
    index = as_of.year * 12 + (as_of.month - 1) - months
    return index // 12, index % 12 + 1


def from_month(year: Column, month: Column, first: tuple[int, int]) -> Column:
    """Rows of `first` = (year, month) or later; prunes partitions stored by year and month."""
    first_year, first_month = first
    return (year > first_year) | ((year == first_year) & (month >= first_month))


def trailing_months(year: Column, month: Column, as_of: date, months: int) -> Column:
    """Rows of the month `months` before `as_of` up to the as-of month.

    A window of 6 therefore spans seven calendar months, the last of them unfinished.
    """
    past = (year < as_of.year) | ((year == as_of.year) & (month <= as_of.month))
    return from_month(year, month, months_before(as_of, months)) & past


def known_by(day: Column, as_of: date) -> Column:
    """Rows of the as-of date or earlier, and those without a date."""
    return F.coalesce(day <= F.lit(as_of), F.lit(True))


def days_since(day: Column, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), day)


def event_parts(ts: Column) -> dict[str, Column]:
    """Partition columns of an event time."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }
