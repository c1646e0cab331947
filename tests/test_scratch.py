import time

import pytest
from pyspark.sql import functions as F

from marlstone.operators import sizing
from marlstone.plans import fixtures, registered_history
from marlstone.plans import history as cells_of
from marlstone.sources import scratch, writers
from marlstone.sources.scratch import scratch_path, written
from tests.conftest import rows


def shuffle_files(spark):
    """Shuffle files on disk, as (shuffle, map task, what) in their names."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (blocks.apply(i).getName() for i in range(blocks.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left(spark, before):
    """Shuffle files that a finished write has left; they are removed at its end, but not in the same instant."""
    for _ in range(50):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return found


def shuffled(spark):
    return spark.range(0, 5_000, 1, 4).withColumn("k", F.col("id") % 7).repartition(3, "k").groupBy("k").agg(F.sum("id").alias("total"))


@pytest.mark.parametrize("put_away", [
    lambda df: written(df, "t"),
    lambda df: writers.write_parquet(df, scratch_path(df.sparkSession, "t"), ("k",)),
])
def test_a_stored_table_leaves_no_shuffle_files(spark, put_away):
    before = shuffle_files(spark)
    setting = spark.conf.get(scratch._CLEANUP, None)
    put_away(shuffled(spark))
    assert not left(spark, before)
    assert spark.conf.get(scratch._CLEANUP, None) == setting


def test_what_shuffled_into_a_stored_table_can_be_read_again(spark):
    df = shuffled(spark)
    stored = written(df, "t")
    assert rows(df) == rows(stored) == rows(df)


def test_rounds_write_every_row_once(spark):
    df = spark.range(300).select(F.when(F.col("id") % 5 != 0, F.col("id") % 40).alias("key"), "id")
    stored = written(df, "t", rounds=4, dealt_by="key")
    assert rows(stored) == rows(df)
    assert not rows(written(df.limit(0), "t", rounds=2, dealt_by="key"))


def test_features_of_past_days_are_the_same_in_rounds_and_small_tasks(spark, sf_dir, monkeypatch):
    query = registered_history.customer_features_backfill
    whole = rows(query(spark, sf_dir))
    monkeypatch.setattr(sizing, "ROUND_BYTES", 10_000)
    monkeypatch.setattr(cells_of, "TASK_SALES", 50)
    seen = []
    monkeypatch.setattr(cells_of, "write_cells", lambda sales, path, f=cells_of.write_cells: seen.append((sales, path)) or f(sales, path))
    assert rows(query(spark, sf_dir)) == whole
    [(sales, path)] = seen
    assert len(sales.columns) == len(cells_of.SALE), "columns that no cell needs are not stored"
    stored = spark.read.parquet(path)
    # Large months are written by several tasks, and each cell is whole.
    assert len(stored.inputFiles()) > stored.select(cells_of.SOLD_IN).distinct().count() + 20
    assert stored.count() == stored.select(*cells_of.CELL, cells_of.SOLD_IN).distinct().count()


def test_months_are_dealt_to_tasks_by_their_sales(spark, sf_dir):
    dealt, tasks = cells_of._dealt({"a": 10, "b": cells_of.TASK_SALES * 3, "c": 5, "d": cells_of.TASK_SALES - 5, "e": 1})
    assert dealt == [("a", 0, 1), ("b", 1, 3), ("c", 4, 1), ("d", 4, 1), ("e", 5, 1)] and tasks == 6
    enriched = written(fixtures.enriched_sales(spark, sf_dir, ("customers", "products")), "sales")
    path = scratch_path(spark, "cells")
    cells_of.write_cells(enriched, path)
    assert rows(cells_of.fold(spark.read.parquet(path), fixtures.AS_OF)) == rows(cells_of.customer_base(enriched, fixtures.AS_OF))
