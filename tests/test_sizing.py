from pyspark.sql import functions as F

from marlstone.operators import sizing
from marlstone.operators.enrich import enrich
from marlstone.plans import fixtures
from marlstone.sources.scratch import scratch_path
from tests.conftest import plan, rows


def test_tasks_that_merge_lines_and_orders_grow_with_the_stored_bytes(spark, sf_dir, monkeypatch):
    left_to_spark = fixtures.sales(spark, sf_dir)
    whole = rows(left_to_spark)
    assert "REPARTITION_BY_NUM" not in plan(left_to_spark)
    monkeypatch.setattr(sizing, "TASK_BYTES", 10_000)
    sized = fixtures.sales(spark, sf_dir)
    assert "REPARTITION_BY_NUM" in plan(sized)
    assert rows(sized) == whole


def test_sales_stream_past_a_large_dimension_unsorted(spark, monkeypatch):
    path = scratch_path(spark, "customers of a test")
    spark.range(500).filter("id != 9").select(
        F.col("id").alias("customer_id"), F.lit("n").alias("customer_name"),
        F.lit("s").alias("segment"), F.md5(F.col("id").cast("string")).alias("state"),
    ).write.parquet(path)
    customers = spark.read.parquet(path)
    sales = spark.range(0, 4_000, 1, 8).select(
        F.col("id").alias("sale_id"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 500).alias("customer_id"),
        F.lit(5).alias("total_value"),
    )
    whole = rows(enrich(sales, customers))
    assert len(whole) == 4_000
    monkeypatch.setattr(sizing, "HASHED_BYTES", 100)
    df = enrich(sales, customers)
    assert rows(df) == whole
    assert "ShuffledHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)


def test_stored_bytes_are_those_of_the_files(spark, tmp_path):
    path = str(tmp_path / "a b")
    spark.range(10).coalesce(1).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "a b").glob("*.parquet"))
    assert sizing.stored_bytes(spark.read.parquet(path)) == size
    assert sizing.stored_bytes(spark.range(3)) == 0
