"""Layer tables bucketed and sorted by a key: joined and aggregated by it without a shuffle.

A bucket is read by one task. Rows whose key owns more than the share of a bucket, and rows without
a key, would make such a task too long, so they are stored in a plain table beside the bucketed one.
There are fewer such keys than buckets, which bounds what a join with them has to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators.joins import frequent_keys


class Bucketed(NamedTuple):
    """Two tables that hold the rows of one model: by bucket, and those kept out of the buckets."""

    key: str
    buckets: int
    settled: str
    beside: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.settled).unionByName(spark.table(self.beside))


def buckets_for(total_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """A power of two, so that tables of unequal numbers still meet without a shuffle."""
    return 1 << max(ceil(total_bytes / bucket_bytes) - 1, 0).bit_length()


def save_bucketed(
    df: DataFrame, layer: str, model: str, root: str, key: str, buckets: int, *, unique: bool = False
) -> Bucketed:
    """Materialise `df` as table `model` of database `layer`, bucketed by `key`, and `model_beside`.

    `unique` says that no key repeats (a dimension): then only rows without a key stay beside.
    Otherwise the frequent keys are looked for first, a pass over the key column of `df`, which
    should be a stored table. One task writes one bucket, so a table has one file per bucket.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}'")
    saved = Bucketed(key, buckets, f"{layer}.{model}", f"{layer}.{model}_beside")
    marked = df.withColumn("_salts", F.lit(None).cast("int"))
    if not unique and buckets > 1:
        hot = frequent_keys(df, [key], 1 / buckets, buckets)[key]
        marked = df.join(F.broadcast(hot), key, "left").select(*df.columns, "_salts")
    kept_out = F.col(key).isNull() | F.col("_salts").isNotNull()
    settled = marked.filter(~kept_out).select(*df.columns).repartition(buckets, key)
    writer = settled.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", f"{root}/{layer}/{model}").saveAsTable(saved.settled)
    beside = marked.filter(kept_out).select(*df.columns)
    beside.write.mode("overwrite").option("path", f"{root}/{layer}/{model}_beside").saveAsTable(saved.beside)
    return saved


def left_join(
    spark: SparkSession, facts: Bucketed, dimension: Bucketed, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Facts LEFT JOIN `columns` of a dimension with one row per key: the settled rows and those beside.

    The settled rows meet bucket by bucket, whatever the size of the dimension. For the rows beside
    only the dimension's rows of their keys are broadcast, fewer than there are buckets of facts.
    No key is in both results.
    """
    key = facts.key
    looked_up = spark.table(dimension.settled).select(F.col(dimension.key).alias(key), *columns)
    settled = spark.table(facts.settled).hint("merge").join(looked_up, key, "left")
    beside = spark.table(facts.beside)
    theirs = looked_up.join(beside.select(key).distinct(), key, "left_semi")
    return settled, beside.join(F.broadcast(theirs), key, "left")


def per_key(
    spark: SparkSession,
    facts: Bucketed,
    dimension: Bucketed,
    columns: Sequence[str],
    aggregates: Sequence[Column],
    rows: Column | None = None,
) -> DataFrame:
    """`aggregates` of the facts by key and the `columns` of its dimension; `rows` restricts the facts.

    Settled keys are summed where they lie. The few keys beside are summed within each task first.
    """
    settled, beside = (
        (df if rows is None else df.filter(rows)).groupBy(facts.key, *columns).agg(*aggregates)
        for df in left_join(spark, facts, dimension, columns)
    )
    return settled.unionByName(beside)
