"""Exact money, mean and rate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"
MEAN = "decimal(22,6)"


def money_total(value: Column) -> Column:
    return F.sum(value).cast(TOTAL)


def money_mean(value: Column) -> Column:
    return F.avg(value).cast(MEAN)


def mean_of_total(total: Column, count: Column) -> Column:
    """Mean from an already summed total, in the same type as `money_mean`."""
    return F.try_divide(total, count).cast(MEAN)


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole of two counts, rounded half up, NULL where whole is 0.

    The division is done on decimals so that the rounding sees the exact quotient.
    """
    exact = F.try_divide(part.cast("decimal(18,0)"), whole.cast("decimal(18,0)"))
    return F.round(exact, digits).cast("double")


def failure_rate(failed: Column, total: Column) -> Column:
    """failed / total, 0.0 on empty input."""
    return F.coalesce(F.try_divide(failed.cast("double"), total.cast("double")), F.lit(0.0))


def flag(condition: Column) -> Column:
    """True where the condition holds, False where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False))
