"""A table is replaced at once or not at all."""

import pytest
from pyspark.sql import functions as F

from marlstone.sources import versions
from marlstone.sources.scratch import scratch_path
from tests.conftest import rows


def test_a_write_that_fails_halfway_leaves_the_old_rows(spark):
    root = scratch_path(spark, "versioned")
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, root)
    versions.replace(spark.range(10), root)
    # Some tasks write all their rows, one fails.
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        versions.replace(broken, root)
    assert rows(versions.read_current(spark, root)) == [(i,) for i in range(10)]
    versions.replace(spark.range(3), root)
    assert rows(versions.read_current(spark, root)) == [(0,), (1,), (2,)]


def test_a_version_may_be_made_of_the_one_before(spark):
    root = scratch_path(spark, "versioned")
    versions.replace(spark.range(4).selectExpr("id", "id % 2 as part"), root, ("part",))
    reader = versions.read_current(spark, root)
    versions.replace(reader.withColumn("id", F.col("id") + 10), root, ("part",))
    assert sorted(r.id for r in reader.collect()) == [0, 1, 2, 3], "a reader keeps its version"
    assert sorted(r.id for r in versions.read_current(spark, root).collect()) == [10, 11, 12, 13]
    assert [r.number for r in versions.commits(spark, root).orderBy("number").collect()] == [1, 2]


def test_a_registered_table_moves_to_the_new_version(spark):
    root = scratch_path(spark, "versioned")
    versions.replace_table(spark.range(4).selectExpr("id", "id % 2 as part"), "versioned_numbers", root, ("part",))
    assert spark.table("versioned_numbers").count() == 4
    versions.replace_table(spark.range(3).selectExpr("id", "7 as part"), "versioned_numbers", root, ("part",))
    assert rows(spark.table("versioned_numbers").select("id", "part")) == [(0, 7), (1, 7), (2, 7)]
