from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.operators import marts
from marlstone.operators.enrich import enrich
from marlstone.operators.joins import frequent_keys, hot_keys, salted_left_join
from marlstone.operators.validity import valid_sales
from marlstone.plans import fixtures
from tests.conftest import rows

SALES = (
    "sale_id bigint, sale_date date, year int, month int, product_id bigint, customer_id bigint, "
    "region_id int, quantity int, unit_price decimal(18,2), discount decimal(5,4), "
    "total_value decimal(18,2), channel string, status string"
)


def sale(i, product=1, customer=100, region=1, value="10.00", status=rules.COMPLETED, month=1,
         quantity=1, channel="Online", year=2024):
    return (i, date(year, month, 1), year, month, product, customer, region, quantity,
            Decimal("1.00"), Decimal("0.0000"), Decimal(value), channel, status)


@pytest.fixture
def dims(spark):
    return {
        "customers": spark.createDataFrame(
            [(100, "Maria Silva", "SMB", "SP")],
            "customer_id bigint, customer_name string, segment string, state string",
        ),
        "products": spark.createDataFrame(
            [(1, "bolt", "tools"), (2, "ring", "jewels")],
            "product_id bigint, product_name string, category string",
        ),
        "regions": spark.createDataFrame([(1, "Sul")], "region_id int, region_name string"),
    }


def test_dimensions_are_looked_up_and_orphans_kept(spark, dims):
    df = spark.createDataFrame([sale(1), sale(2, product=9, customer=None, region=7)], SALES)
    found = {r.sale_id: r for r in enrich(df, **dims).collect()}
    assert found[1].customer_name == "Maria Silva" and found[1].category == "tools"
    assert (found[2].customer_name, found[2].category, found[2].region_name) == (None, None, None)


def test_salting_changes_nothing(spark, dims):
    data = [sale(i, product=1 if i % 3 else 2, customer=None if i % 5 == 0 else 100)
            for i in range(60)]
    df = spark.createDataFrame(data, SALES)
    keys = ("customer_id", "product_id", "region_id")
    assert rows(enrich(df, **dims)) == rows(enrich(df, **dims, salt=keys))


def test_hot_keys_are_bounded_and_joined_whole(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id")).alias("k"),
    )
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = hot_keys(left, "k", share=0.1, partitions=30)
    assert [(r.k, r._salts) for r in hot.collect()] == [(7, 11)], "a third of 30, rounded up"
    salted = salted_left_join(left, right, "k", hot, spread_by=F.col("id"))
    assert rows(salted.select("id", "k", "v")) == rows(
        left.join(right, "k", "left").select("id", "k", "v")
    )


def test_mart_measures(spark, dims):
    df = spark.createDataFrame(
        [sale(1, value="10.00"), sale(2, value="20.01", quantity=4), sale(3, status="Cancelada"),
         sale(4, product=9, value="5.00"), sale(5, month=2)],
        SALES,
    )
    mart = {(r.category, r.month): r for r in marts.sales_mart(enrich(df, **dims)).collect()}
    assert set(mart) == {("tools", 1), (None, 1), ("tools", 2)}
    row = mart[("tools", 1)]
    assert (row.orders, row.units, row.revenue) == (2, 5, Decimal("30.01"))
    assert row.ticket_mean == Decimal("15.005000")
    assert (row.largest_sale, row.smallest_sale) == (Decimal("20.01"), Decimal("10.00"))
    one_month = marts.sales_mart(enrich(df, **dims), year=2024, month=2)
    assert one_month.count() == 1
    named = marts.sales_mart(enrich(df, **dims), fill_unknown=rules.NOT_INFORMED)
    assert named.filter(F.col("category") == rules.NOT_INFORMED).count() == 1


def test_mart_total_is_that_of_the_completed_sales(spark, sf_dir):
    enriched = fixtures.enriched_sales(spark, sf_dir)
    expected = marts.completed(enriched).agg(F.sum("total_value"), F.count("sale_id")).first()
    mart = marts.sales_mart(enriched).agg(F.sum("revenue"), F.sum("orders")).first()
    assert tuple(mart) == tuple(expected)


def test_both_ways_to_the_mart_agree(spark, sf_dir):
    valid = valid_sales(fixtures.dirty_sales(spark, sf_dir))
    products, regions = fixtures.products(spark, sf_dir), fixtures.regions(spark, sf_dir)
    direct = marts.sales_mart_from_fact(valid, products, regions)
    assert rows(direct) == rows(
        marts.sales_mart(enrich(valid, products=products, regions=regions)).select(*direct.columns)
    )


MART = "category string, revenue decimal(38,2)"


def test_top_plus_other(spark):
    data = [("a", 5), ("b", 9), ("c", 1), ("d", 2), ("a", 3), (None, 4), ("other", 8)]
    df = spark.createDataFrame([(c, Decimal(v)) for c, v in data], MART)
    found = [tuple(r) for r in marts.top_plus_other(df, "category", limit=3).collect()]
    assert found == [
        (False, "b", Decimal("9.00")), (False, "a", Decimal("8.00")),
        (False, "other", Decimal("8.00")), (True, "other", Decimal("7.00")),
    ]
    assert marts.top_plus_other(df, "category", limit=10).filter("is_other").count() == 0


def test_top_products_breaks_ties(spark, dims):
    df = spark.createDataFrame([sale(1, product=1), sale(2, product=2)], SALES)
    names = [r.product_name for r in marts.top_products(enrich(df, **dims), 1).collect()]
    assert names == ["bolt"]


def test_frequent_keys_of_all_columns_miss_no_hot_key(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("x")).otherwise(F.col("id").cast("string")).alias("t"),
        F.col("id").alias("unique"),
    ).repartition(7)
    found = frequent_keys(df, ["k", "t", "unique"], share=0.1, partitions=30)
    assert rows(found["k"]) == rows(hot_keys(df, "k", share=0.1, partitions=30)) == [(7, 11)]
    assert rows(found["t"]) == [("x", 15)]
    assert rows(found["unique"]) == []
    none = frequent_keys(df.limit(0), ["k"])
    assert rows(none["k"]) == [] and none["k"].schema["k"].dataType == df.schema["k"].dataType
