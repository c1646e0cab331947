"""Sales mart and the reports drawn from it or from the sales themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.functions.numbers import MEAN, MONEY, TOTAL, mean_of_total, money_mean, money_total

MART_KEYS = ("category", "region_name", "channel", "year", "month")


def completed(sales: DataFrame, status: str = rules.COMPLETED) -> DataFrame:
    return sales.filter(F.col("status") == status)


def sales_mart(
    enriched: DataFrame,
    *,
    year: int | None = None,
    month: int | None = None,
    fill_unknown: str | None = None,
    generated_at=None,
) -> DataFrame:
    """KPIs of completed sales per category, region, channel, year and month.

    `year` and `month` restrict the run to a year or month and prune partitions. `fill_unknown`
    names the group of sales without category or region (rules.NOT_INFORMED, say); they form a
    NULL group otherwise.
    """
    df = completed(enriched)
    if year is not None:
        df = df.filter(F.col("year") == year)
    if month is not None:
        df = df.filter(F.col("month") == month)
    if fill_unknown is not None:
        df = df.fillna(fill_unknown, subset=["category", "region_name"])
    mart = df.groupBy(*MART_KEYS).agg(
        F.count("sale_id").alias("orders"),
        F.sum("quantity").alias("units"),
        money_total(F.col("total_value")).alias("revenue"),
        money_mean(F.col("total_value")).alias("ticket_mean"),
        F.max("total_value").alias("largest_sale"),
        F.min("total_value").alias("smallest_sale"),
    )
    if generated_at is not None:
        mart = mart.withColumn("_gold_generated_at", F.lit(generated_at))
    return mart


def sales_mart_from_fact(
    sales: DataFrame, products: DataFrame, regions: DataFrame
) -> DataFrame:
    """The same mart straight from valid sales, aggregating before the dimensions are joined.

    The first aggregation is on product and region keys, so the joins see one row per product,
    region, channel and month instead of one per sale, and a product with a third of all sales is
    collapsed within each task before it is shuffled.
    """
    by_key = completed(sales).groupBy("product_id", "region_id", "channel", "year", "month").agg(
        F.count("sale_id").alias("orders"),
        F.sum("quantity").alias("units"),
        money_total(F.col("total_value")).alias("revenue"),
        F.count("total_value").alias("priced"),
        F.max("total_value").alias("largest_sale"),
        F.min("total_value").alias("smallest_sale"),
    )
    return (
        by_key.join(products.select("product_id", "category"), "product_id", "left")
        .join(regions.select("region_id", "region_name"), "region_id", "left")
        .groupBy(*MART_KEYS)
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").cast(TOTAL).alias("revenue"),
            mean_of_total(F.sum("revenue").cast(TOTAL), F.sum("priced")).alias("ticket_mean"),
            F.max("largest_sale").alias("largest_sale"),
            F.min("smallest_sale").alias("smallest_sale"),
        )
    )


# Reports over the mart. A plain mean of group means weighs every group alike, whatever its number
# of orders; `weighted_ticket` next to it is revenue per order.


def _plain_ticket() -> Column:
    return F.round(F.avg("ticket_mean"), 2).cast(MONEY)


def _weighted_ticket() -> Column:
    return mean_of_total(F.sum("revenue").cast(TOTAL), F.sum("orders"))


def _mart_report(mart: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return mart.groupBy(*keys).agg(
        F.sum("revenue").cast(TOTAL).alias("revenue"),
        F.sum("orders").alias("orders"),
        F.sum("units").alias("units"),
        _plain_ticket().alias("ticket_mean"),
        _weighted_ticket().alias("weighted_ticket"),
    )


def revenue_by_category(mart: DataFrame) -> DataFrame:
    return _mart_report(mart, ("category",)).orderBy(
        F.desc_nulls_last("revenue"), F.asc_nulls_last("category")
    )


def revenue_by_channel_region(mart: DataFrame) -> DataFrame:
    return (
        _mart_report(mart, ("channel", "region_name"))
        .drop("units")
        .orderBy(F.desc_nulls_last("revenue"), "channel", "region_name")
    )


def ticket_by_category_month(mart: DataFrame) -> DataFrame:
    return (
        _mart_report(mart, ("year", "month", "category"))
        .select("year", "month", "category", "ticket_mean", "weighted_ticket", "orders")
        .orderBy(F.desc("year"), F.desc("month"), F.asc_nulls_last("category"))
    )


def top_products(enriched: DataFrame, limit: int = 10) -> DataFrame:
    """Products by units sold; equal units are ordered by revenue, name and category."""
    return (
        completed(enriched)
        .groupBy("product_name", "category")
        .agg(
            F.sum("quantity").alias("units"),
            money_total(F.col("total_value")).alias("revenue"),
            F.count("sale_id").alias("orders"),
        )
        .orderBy(
            F.desc("units"),
            F.desc("revenue"),
            F.asc_nulls_last("product_name"),
            F.asc_nulls_last("category"),
        )
        .limit(limit)
    )


def cancelled_by_month(sales: DataFrame) -> DataFrame:
    return (
        completed(sales, rules.CANCELLED)
        .groupBy("year", "month")
        .agg(
            F.count("sale_id").alias("cancelled"),
            money_total(F.col("total_value")).alias("cancelled_value"),
            F.round(F.avg("total_value"), 2).cast(MONEY).alias("cancelled_ticket_mean"),
        )
        .orderBy(F.desc("year"), F.desc("month"))
    )


def customers_by_segment(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("segment", "state")
        .agg(F.count("customer_id").alias("customers"))
        .orderBy(F.desc("customers"), "segment", "state")
    )


def kpi_totals(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.sum("revenue").cast(TOTAL).alias("revenue"),
        F.sum("orders").alias("orders"),
        F.avg("ticket_mean").cast(MEAN).alias("ticket_mean"),
        _weighted_ticket().alias("weighted_ticket"),
    )


def top_plus_other(
    mart: DataFrame, dimension: str, limit: int = 10, other: str = "other"
) -> DataFrame:
    """Revenue of the `limit` strongest values of a dimension, all others in one extra row.

    Only the names of the kept values are broadcast, `limit` of them. `is_other` tells the extra
    row from a value that happens to carry the same name.
    """
    totals = mart.groupBy(dimension).agg(F.sum("revenue").cast(TOTAL).alias("revenue"))
    strongest = (
        totals.orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last(dimension))
        .limit(limit)
        .select(F.col(dimension).alias("_kept"), F.lit(False).alias("_other"))
    )
    is_other = F.coalesce(F.col("_other"), F.lit(True))
    return (
        totals.join(F.broadcast(strongest), F.col(dimension).eqNullSafe(F.col("_kept")), "left")
        .select(
            is_other.alias("is_other"),
            F.when(is_other, F.lit(other)).otherwise(F.col(dimension)).alias(dimension),
            "revenue",
        )
        .groupBy("is_other", dimension)
        .agg(F.sum("revenue").cast(TOTAL).alias("revenue"))
        .orderBy("is_other", F.desc_nulls_last("revenue"), F.asc_nulls_last(dimension))
    )


def monthly_trend(mart: DataFrame) -> DataFrame:
    """Revenue per calendar month and category, the same month of all years together."""
    return (
        mart.groupBy("month", "category")
        .agg(F.sum("revenue").cast(TOTAL).alias("revenue"))
        .orderBy("month", F.asc_nulls_last("category"))
    )
