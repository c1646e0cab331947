"""Left joins that hold when a few keys own a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The most that Spark's frequent-items summary takes.
_MOST_COUNTERS = 1 << 19


def hot_keys(
    df: DataFrame, key: str, share: float | None = None, partitions: int | None = None
) -> DataFrame:
    """Keys that own at least `share` of all rows: never more than 1 / share of them.

    By default that is the share of one partition, whatever their number: any larger key would
    make its task longer than the others.

    Each comes with `_salts`, the number of the `partitions` (those of the session by default)
    that its rows would fill. Reads the key column only, and counts within each task before
    anything is shuffled.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_of_counts(counted, key, "_rows", share, partitions)


def frequent_keys(
    df: DataFrame, keys: Sequence[str], share: float | None = None, partitions: int | None = None
) -> dict[str, DataFrame]:
    """For each key column what `hot_keys` gives, all from one pass that shuffles no keys.

    Every task keeps a bounded number of counters per column (a frequent-items summary), and the
    summaries are merged. With 16 / share counters a count is off by less than a quarter of the
    share, so no key above it is missed; keys just below it may be listed, which splits them
    needlessly and changes no result. Runs at once: at most 2 / share keys a column reach the driver.
    """
    spark = df.sparkSession
    partitions = partitions or _shuffle_partitions(df)
    share = share or 1 / partitions
    most = ceil(2 / share)
    counters = min(1 << ceil(16 / share).bit_length(), _MOST_COUNTERS)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"approx_top_k(`{key}`, {min(most, counters)}, {counters})").alias(key) for key in keys],
    ).first()
    found = {}
    for key in keys:
        shares = [(item["item"], item["count"] / counted["rows"]) for item in counted[key] or ()]
        hot = [(k, ceil(own * partitions)) for k, own in shares if k is not None and own >= share]
        schema = f"`{key}` {df.schema[key].dataType.simpleString()}, _salts int"
        found[key] = spark.createDataFrame(hot, schema)
    return found


def hot_of_counts(
    counted: DataFrame,
    key: str,
    rows: str,
    share: float | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """`hot_keys` from counts per key that are at hand already."""
    share = share or 1 / (partitions or _shuffle_partitions(counted))
    own_share = F.col(rows) / counted.agg(F.sum(rows)).scalar()
    salts = F.ceil(own_share * (partitions or _shuffle_partitions(counted))).cast("int")
    return (
        counted.filter(F.col(key).isNotNull())
        .withColumn("_share", own_share)
        .filter(F.col("_share") >= share)
        .select(key, salts.alias("_salts"))
    )


def salted_left_join(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame, *, spread_by: Column
) -> DataFrame:
    """left LEFT JOIN right on `key`, `right` holding one row per key.

    Rows of the `hot` keys are spread over their number of salts, rows without a key over all
    partitions, by `spread_by`, an expression of the left row that varies within a key. Only the
    right rows of hot keys are repeated, once per salt, which adds up to little more than the
    number of partitions. `hot` must come from `hot_keys`, `frequent_keys` or `hot_of_counts`: the share bounds its
    size, which is what allows broadcasting it.
    """
    marked = F.broadcast(hot)
    hashed = F.xxhash64(spread_by)
    salt = (
        F.when(F.col(key).isNull(), F.pmod(hashed, F.lit(_shuffle_partitions(left))))
        .when(F.col("_salts").isNotNull(), F.pmod(hashed, F.col("_salts")))
        .otherwise(F.lit(0))
    )
    last_salt = F.coalesce(F.col("_salts") - 1, F.lit(0))
    left_salted = (
        left.join(marked, key, "left").withColumn("_salt", salt.cast("int")).drop("_salts")
    )
    right_salted = (
        right.join(marked, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last_salt)))
        .drop("_salts")
    )
    return left_salted.join(right_salted, [key, "_salt"], "left").drop("_salt")


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
