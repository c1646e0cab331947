"""What the physical plans must look like for large inputs."""

import re

from pyspark.sql import functions as F

from marlstone.operators import marts
from marlstone.operators.enrich import enrich
from marlstone.plans import features, fixtures
from marlstone.sources.scratch import scratch_path
from tests.conftest import plan

def test_filters_and_columns_reach_the_files(spark):
    path = scratch_path(spark, "silver")
    spark.range(10).selectExpr(
        "id as sale_id", "'x' as status", "1 as quantity", "cast(1 as decimal(18,2)) as total_value",
        "'c' as category", "'r' as region_name", "'o' as channel", "'unused' as customer_name",
        "2024 as year", "cast(id % 3 as int) as month",
    ).write.partitionBy("year", "month").parquet(path)
    text = plan(marts.sales_mart(spark.read.parquet(path), year=2024, month=1))
    assert "EqualTo(status,Concluída)" in text
    assert "customer_name" not in re.search(r"ReadSchema: \S+", text).group()
    assert re.search(r"PartitionFilters: \[.*year.*month", text)


def test_the_mart_from_the_fact_aggregates_before_it_joins(spark, sf_dir):
    from marlstone.operators.validity import valid_sales

    df = marts.sales_mart_from_fact(
        valid_sales(fixtures.dirty_sales(spark, sf_dir)),
        fixtures.products(spark, sf_dir),
        fixtures.regions(spark, sf_dir),
    )
    tree = df._jdf.queryExecution().optimizedPlan().toString()
    top, below = tree.find("Join LeftOuter"), tree.rfind("Aggregate")
    assert 0 < top < below, "an aggregate lies below the joins with the dimensions"


def test_feature_base_reads_the_sales_once(spark, sf_dir):
    text = plan(features.customer_base(fixtures.sales(spark, sf_dir).withColumns(
        {c: F.lit("x") for c in ("category", "segment", "state")}
    ).withColumn("is_high_value", F.lit(False)), fixtures.AS_OF))
    assert text.count("lineitem.parquet") == 1
    assert "Expand" not in text


def test_salting_all_keys_reads_the_sales_twice(spark, sf_dir):
    # Once for the frequent keys of all columns, before the plan, and once in the plan.
    df = fixtures.enriched_sales(spark, sf_dir, salt=("customer_id", "product_id", "region_id"))
    assert plan(df).count("lineitem.parquet") == 1


def test_a_hot_key_is_split_at_run_time(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        sales = spark.range(0, 40_000, 1, 8).select(
            F.col("id").alias("sale_id"),
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("customer_id"),
            F.lit(5).alias("total_value"),
            F.md5(F.col("id").cast("string")).alias("channel"),
        )
        customers = spark.range(500).select(
            F.col("id").alias("customer_id"), F.lit("n").alias("customer_name"),
            F.lit("s").alias("segment"), F.lit("t").alias("state"),
        )
        df = enrich(sales, customers)
        assert len(df.collect()) == 40_000
        assert "skew=true" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
