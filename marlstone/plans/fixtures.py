"""The test tables seen as sales, customers, products, regions and clicks.

One order line is one sale. The tables are clean, so `dirty_sales` and `raw_*` break some values by
fixed rules over the whole table; the SQL oracles apply the same rules.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.functions.numbers import MONEY
from marlstone.operators import staging
from marlstone.operators.enrich import enrich
from marlstone.operators.sizing import hashed_if_large, spread_pair
from marlstone.operators.validity import valid_sales

AS_OF = date(2001, 8, 1)
EARLIER = date(2001, 2, 1)
NOW = datetime(2001, 8, 1, 12, 0)


# Stated, so that no job has to read file footers before a query is planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order, customer and nation.

    Orders find their region first, so the lines, the large side, are shuffled once. Sorted merging
    is asked for because orders grow with lines; sizes estimated through two joins mislead here.
    """
    orders = table(spark, sf_dir, "orders")
    customers = hashed_if_large(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    lines, placed = spread_pair(table(spark, sf_dir, "lineitem"), "l_orderkey", placed, "o_orderkey")
    price = F.col("l_extendedprice").cast(MONEY)
    discount = F.col("l_discount").cast("decimal(5,4)")
    return lines.hint("merge").join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("n_regionkey").alias("region_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("unit_price"),
        discount.alias("discount"),
        F.round(price * (1 - discount), 2).cast(MONEY).alias("total_value"),
        F.col("o_orderpriority").alias("channel"),
        F.when(F.col("o_orderstatus") == "F", rules.COMPLETED)
        .when(F.col("o_orderstatus") == "P", rules.CANCELLED)
        .when(F.col("o_orderstatus") == "O", rules.IN_PROGRESS)
        .alias("status"),
    )


def _every(n: int) -> Column:
    return F.col("sale_id") % n == 0


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with missing customers, zero quantities, negative values, odd states, orphans."""
    return sales(spark, sf_dir).withColumns(
        {
            "customer_id": F.when(~_every(97), F.col("customer_id")),
            "quantity": F.when(_every(89), 0).otherwise(F.col("quantity")),
            "total_value": F.when(_every(83), -F.col("total_value"))
            .otherwise(F.col("total_value"))
            .cast(MONEY),
            "status": F.when(_every(79), "Invalid").otherwise(F.col("status")),
            "product_id": F.when(_every(73), -F.col("product_id") - 1).otherwise(
                F.col("product_id")
            ),
        }
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped sales; some have no id, some a quantity that is no number."""
    df = dirty_sales(spark, sf_dir)
    df = df.withColumn("quantity", F.when(_every(71), "n/a").otherwise(F.col("quantity").cast("string")))
    df = df.withColumn("sale_id", F.when(~_every(101), F.col("sale_id")))
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    df = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 11, "0")
    cpf = F.concat(
        digits.substr(1, 3), F.lit("."), digits.substr(4, 3), F.lit("."), digits.substr(7, 3),
        F.lit("-"), digits.substr(10, 2),
    )
    email = F.concat(F.translate("c_name", "#", "."), F.lit("@Mail.Example"))
    return df.select(
        key.cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(key % 50 != 0, email).alias("email"),
        cpf.alias("cpf"),
        F.col("c_mktsegment").alias("segment"),
        F.lower("n_name").alias("state"),
        F.col("n_regionkey").cast("string").alias("region_id"),
        F.date_add(F.lit(date(1995, 1, 1)), (key % 365).cast("int"))
        .cast("string")
        .alias("registered_on"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).cast("string").alias("list_price"),
        F.col("p_brand").alias("supplier"),
        F.when(key % 10 == 9, None)
        .when(key % 3 == 0, " s ")
        .when(key % 3 == 1, "N")
        .otherwise("S")
        .alias("active"),
    )


def raw_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("region_id"), F.col("r_name").alias("region_name")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(raw_customers(spark, sf_dir), staging.CUSTOMERS)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(raw_products(spark, sf_dir), staging.PRODUCTS)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(raw_regions(spark, sf_dir), staging.REGIONS)


def enriched_sales(
    spark: SparkSession,
    sf_dir: str,
    dimensions: tuple[str, ...] = ("customers", "products", "regions"),
    **options,
) -> DataFrame:
    """Valid rows of the dirty sales with the named dimensions; orphans keep NULLs."""
    tables = {"customers": customers, "products": products, "regions": regions}
    looked_up = {name: tables[name](spark, sf_dir) for name in dimensions}
    return enrich(valid_sales(dirty_sales(spark, sf_dir)), **looked_up, **options)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumnRenamed("ts", "event_timestamp")
