from datetime import date

from pyspark.sql import functions as F

from marlstone.plans import sketches
from marlstone.sources.scratch import scratch_path
from tests.conftest import rows


def sales(spark, month, low, high):
    ids = spark.range(low, high).select((F.col("id") % 3).alias("part"), F.col("id").alias("buyer"))
    return ids.withColumn("sale_date", F.lit(date(2024, month, 5)))


def test_months_merge_within_the_error(spark):
    path = scratch_path(spark, "sketches")
    sketches.write_sketches(sales(spark, 1, 0, 60_000), path, ("part",), "buyer")
    sketches.write_sketches(sales(spark, 2, 30_000, 90_000), path, ("part",), "buyer")
    found = sketches.distinct_between(spark, path, ("part",), "2024-01", "2024-02")
    for _, estimate in rows(found):
        assert abs(estimate - 30_000) <= 3 * sketches.relative_error() * 30_000
    one = sketches.distinct_between(spark, path, ("part",), "2024-02", "2024-02")
    assert "PartitionFilters: [isnotnull(sold_in" in one._jdf.queryExecution().toString()
    assert all(abs(n - 20_000) <= 3 * sketches.relative_error() * 20_000 for _, n in rows(one))


def test_a_month_is_replaced(spark):
    path = scratch_path(spark, "sketches")
    for high in (500, 30):
        sketches.write_sketches(sales(spark, 1, 0, high), path, (), "buyer")
    assert rows(sketches.distinct_between(spark, path, (), "2024-01", "2024-12")) == [(30,)]


def test_nulls_are_not_counted(spark):
    path = scratch_path(spark, "sketches")
    some = spark.createDataFrame([("a", None, None), ("a", 1, None), (None, 2, None)], "part string, buyer long, sale_date date")
    sketches.write_sketches(some, path, ("part",), "buyer")
    assert rows(sketches.distinct_between(spark, path, ("part",), "0000-00", "9999-99")) == [("a", 1), (None, 1)]
