"""Star enrichment of the sales fact."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators.joins import frequent_keys, salted_left_join
from marlstone.operators.sizing import hashed_if_large
from marlstone.operators.validity import with_high_value_flag


class Dimension(NamedTuple):
    key: str
    columns: tuple[str, ...]


CUSTOMER = Dimension("customer_id", ("customer_name", "segment", "state"))
PRODUCT = Dimension("product_id", ("product_name", "category"))
REGION = Dimension("region_id", ("region_name",))

# Column order of the enriched fact.
ENRICHED = (
    "sale_id",
    "sale_date",
    "year",
    "month",
    "product_id",
    "product_name",
    "category",
    "customer_id",
    "customer_name",
    "segment",
    "state",
    "region_id",
    "region_name",
    "channel",
    "status",
    "quantity",
    "unit_price",
    "discount",
    "total_value",
    "is_high_value",
)


def enrich(
    sales: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    regions: DataFrame | None = None,
    *,
    processed_at=None,
    salt: tuple[str, ...] = (),
) -> DataFrame:
    """Sales LEFT JOIN the dimensions given, with the high-value flag.

    Sales whose key is in no dimension keep NULLs. Leave out a dimension whose columns the next
    step does not use: nothing tells Spark that a dimension has one row per key, so it cannot drop
    the join by itself. A dimension that is small enough is broadcast by its size, any other is
    shuffled and hashed, and adaptive execution splits hot keys. Name keys in `salt`
    (customer_id, say) to split their hot keys up front instead, which costs one more pass over those
    columns, however many, at once. `processed_at` adds the audit timestamp.
    """
    given = ((CUSTOMER, customers), (PRODUCT, products), (REGION, regions))
    salted = [dimension.key for dimension, table in given if table is not None and dimension.key in salt]
    hot = frequent_keys(sales, salted) if salted else {}
    df = with_high_value_flag(sales)
    for dimension, table in given:
        if table is None:
            continue
        looked_up = table.select(dimension.key, *dimension.columns)
        if dimension.key in hot:
            spread_by = F.struct("sale_id", "sale_date")
            df = salted_left_join(df, looked_up, dimension.key, hot[dimension.key], spread_by=spread_by)
        else:
            df = df.join(hashed_if_large(looked_up), dimension.key, "left")
    df = df.select(*[c for c in ENRICHED if c in df.columns])
    if processed_at is not None:
        df = df.withColumn("_silver_processed_at", F.lit(processed_at))
    return df
