"""Distinct counts over any range of months, estimated from sketches stored once per month.

An exact distinct count cannot be added up over months; a sketch can be merged. A month's sketches
are a few kilobytes per group whatever its sales, and a new month adds its own and changes no others.
`customers.distinct_categories` and the like stay exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.plans.history import SOLD_IN, UNDATED
from marlstone.sources.writers import write_parquet

# Logarithm of the buckets of a sketch.
PRECISION = 14


def relative_error(precision: int = PRECISION) -> float:
    """Standard error of an estimate from merged sketches, as a share of the count."""
    return 1.04 / math.sqrt(1 << precision)


def write_sketches(
    sales: DataFrame, path: str, by: Sequence[str], counted: str, *,
    precision: int = PRECISION, whole: bool = False,
) -> None:
    """Store a sketch of the `counted` values per group and month of sale. NULLs are not counted.

    Months that are stored already are replaced, so the sales must hold whole months; `whole`
    replaces all of them. Sales are sketched within each task before sketches are shuffled.
    """
    sold_in = F.coalesce(F.date_format("sale_date", "yyyy-MM"), F.lit(UNDATED))
    sketched = sales.withColumn(SOLD_IN, sold_in).groupBy(SOLD_IN, *by)
    sketched = sketched.agg(F.hll_sketch_agg(counted, precision).alias("sketch"))
    write_parquet(sketched, path, (SOLD_IN,), whole=whole)


def distinct_between(
    spark: SparkSession, path: str, by: Sequence[str], first: str, last: str, into: str = "estimate"
) -> DataFrame:
    """Estimated distinct values per group over the months `first` to `last` (yyyy-MM, inclusive).

    Only the folders of these months are read.
    """
    types = spark.read.parquet(path).drop(SOLD_IN).schema
    stored = spark.read.schema(types.add(SOLD_IN, "string")).parquet(path)
    merged = stored.filter(F.col(SOLD_IN).between(first, last)).groupBy(*by)
    return merged.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(into))
