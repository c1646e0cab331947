"""Row validity rules, reject accounting and the high-value flag."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.functions.numbers import flag


def sale_rules(
    statuses: Sequence[str] = rules.STATUSES, *, require_customer: bool = True
) -> dict[str, Column]:
    """Rule name -> condition a valid sale meets. An unknown value meets no condition.

    The batch job asks for a customer; the SQL model form (`require_customer=False`) does not.
    """
    named = {
        "sale_id": F.col("sale_id").isNotNull(),
        "customer_id": F.col("customer_id").isNotNull(),
        "quantity": F.col("quantity") > 0,
        "total_value": F.col("total_value") >= 0,
        "status": F.col("status").isin(*statuses),
    }
    if not require_customer:
        del named["customer_id"]
    return {name: flag(condition) for name, condition in named.items()}


def all_met(named: dict[str, Column]) -> Column:
    return reduce(lambda left, right: left & right, named.values())


def valid_sales(sales: DataFrame, named: dict[str, Column] | None = None) -> DataFrame:
    return sales.filter(all_met(named or sale_rules()))


def rejected_sales(sales: DataFrame, named: dict[str, Column] | None = None) -> DataFrame:
    """Rows that break a rule, with `broken_rules` naming each rule broken."""
    named = named or sale_rules()
    return sales.filter(~all_met(named)).withColumn("broken_rules", broken_rules(named))


def broken_rules(named: dict[str, Column]) -> Column:
    """Names of the rules a sale breaks."""
    return F.array_compact(
        F.array(*[F.when(~condition, F.lit(name)) for name, condition in named.items()])
    )


def reject_counts(sales: DataFrame, named: dict[str, Column] | None = None) -> DataFrame:
    """One row: total, approved, rejected, and rejected per rule, from a single pass."""
    return sales.agg(*reject_count_columns(named))


def reject_count_columns(named: dict[str, Column] | None = None) -> list[Column]:
    named = named or sale_rules()
    valid = all_met(named)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("approved"),
        F.count_if(~valid).alias("rejected"),
        *[F.count_if(~condition).alias(f"rejected_{name}") for name, condition in named.items()],
    ]


def with_high_value_flag(sales: DataFrame, above=rules.HIGH_VALUE_ABOVE) -> DataFrame:
    return sales.withColumn("is_high_value", flag(F.col("total_value") > above))
