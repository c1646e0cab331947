"""Per-customer measures of the sales history, one block each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.functions.calendar import days_since, known_by, trailing_months
from marlstone.functions.numbers import money_mean, money_total, ratio
from marlstone.operators.marts import completed


def active_months(sales: DataFrame) -> DataFrame:
    """Number of distinct months with a completed sale."""
    return (
        completed(sales)
        .select("customer_id", "year", "month")
        .distinct()
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("active_months"))
    )


def orders_in_trailing_months(
    sales: DataFrame, as_of: date, months: int = rules.TRAILING_MONTHS
) -> DataFrame:
    """Mean completed orders per month over the trailing months that have any."""
    return (
        completed(sales.filter(known_by(F.col("sale_date"), as_of)))
        .filter(trailing_months(F.col("year"), F.col("month"), as_of, months))
        .groupBy("customer_id", "year", "month")
        .agg(F.count("sale_id").alias("_orders"))
        .groupBy("customer_id")
        .agg(ratio(F.sum("_orders"), F.count(F.lit(1))).alias("orders_per_month_6m"))
    )


def channel_counts(sales: DataFrame) -> DataFrame:
    return (
        completed(sales)
        .groupBy("customer_id", "channel")
        .agg(F.count(F.lit(1)).alias("channel_orders"))
    )


def preferred_channel(sales: DataFrame) -> DataFrame:
    """The channel with most completed sales; of equals, the first by name."""
    first = F.min_by("channel", F.struct(-F.col("channel_orders"), "channel"))
    return channel_counts(sales).groupBy("customer_id").agg(first.alias("preferred_channel"))


def preferred_channel_ties(sales: DataFrame) -> DataFrame:
    """Every channel with most completed sales: several rows per customer where counts tie."""
    by_count = Window.partitionBy("customer_id").orderBy(F.desc("channel_orders"))
    return (
        channel_counts(sales)
        .withColumn("_rank", F.rank().over(by_count))
        .filter(F.col("_rank") == 1)
        .select("customer_id", F.col("channel").alias("preferred_channel"))
    )


def latest_profile(sales: DataFrame) -> DataFrame:
    """Segment and state of the latest sale, whatever its status.

    Where sales of the same day disagree, the greatest (segment, state) is taken. Grouping by
    profile first leaves one row per customer and profile to choose from.
    """
    profile = F.struct("segment", "state")
    return (
        sales.groupBy("customer_id", "segment", "state")
        .agg(F.max("sale_date").alias("_last"))
        .groupBy("customer_id")
        .agg(F.max_by(profile, F.struct("_last", profile)).alias("_profile"))
        .select(
            "customer_id",
            F.col("_profile.segment").alias("customer_segment"),
            F.col("_profile.state").alias("customer_state"),
        )
    )


def monetary(sales: DataFrame) -> DataFrame:
    """Orders, revenue and ticket statistics of completed sales."""
    value = F.col("total_value")
    return (
        completed(sales)
        .groupBy("customer_id")
        .agg(
            F.count("sale_id").alias("orders"),
            money_total(value).alias("total_revenue"),
            money_mean(value).alias("ticket_mean"),
            F.max(value).alias("ticket_max"),
            F.min(value).alias("ticket_min"),
        )
    )


def distinct_categories(sales: DataFrame) -> DataFrame:
    return (
        completed(sales)
        .groupBy("customer_id")
        .agg(F.count_distinct("category").alias("category_count"))
    )


def high_value_orders(sales: DataFrame) -> DataFrame:
    return (
        completed(sales)
        .groupBy("customer_id")
        .agg(F.count_if("is_high_value").alias("high_value_orders"))
    )


def recency(sales: DataFrame, as_of: date) -> DataFrame:
    """Days from the last completed sale to the as-of date; later sales are not known yet."""
    return (
        completed(sales.filter(known_by(F.col("sale_date"), as_of)))
        .groupBy("customer_id")
        .agg(days_since(F.max("sale_date"), as_of).alias("days_since_purchase"))
    )


def cancel_rate(sales: DataFrame) -> DataFrame:
    """Cancelled sales over sales of any status."""
    return sales.groupBy("customer_id").agg(
        ratio(F.count_if(F.col("status") == rules.CANCELLED), F.count("sale_id")).alias(
            "cancel_rate"
        )
    )


def with_churn_label(features: DataFrame, after_days: int = rules.CHURN_AFTER_DAYS) -> DataFrame:
    """1 where the last purchase is more than `after_days` ago, 0 otherwise or where unknown."""
    return features.withColumn(
        "churn_label",
        F.when(F.col("days_since_purchase") > after_days, 1).otherwise(0).cast("int"),
    )
