"""Registered queries on the stored, mergeable history."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators.sizing import rounds
from marlstone.plans import features, fixtures, history
from marlstone.plans.oracle_ctes import with_ctes
from marlstone.plans.registry import register
from marlstone.sources import versions
from marlstone.sources.scratch import scratch_path, written

# A day inside a month and the last day of one.
_DAYS = (date(1996, 5, 17), date(1998, 9, 30))
_FEATURE_COLUMNS = ", ".join(features.FEATURES[:-1])


def _as_of_sql(day: date) -> str:
    """The feature query, with sales known by a day only, as of that day."""
    first = day.replace(day=1)
    start = date(first.year + (first.month - 7) // 12, (first.month - 7) % 12 + 1, 1)
    text = with_ctes(f"select date '{day}' as as_of, {_FEATURE_COLUMNS} from scored", "scored")
    text = text.replace("date '2001-08-01'", f"date '{day}'").replace(
        "year > 2001 or (year = 2001 and month >= 2)",
        f"year > {start.year} or (year = {start.year} and month >= {start.month})",
    )
    return text.replace("\nfrom valid v left join", f"\nfrom (select * from valid where sale_date <= date '{day}') v left join")


@register(
    "customer_features_backfill",
    " union all ".join(f"select * from ({_as_of_sql(day)}) d{i}" for i, day in enumerate(_DAYS)),
)
def customer_features_backfill(spark, sf_dir):
    """Features as of two past days, from cells that were stored once."""
    enriched = fixtures.enriched_sales(spark, sf_dir, ("customers", "products")).select(*history.SALE)
    sales = written(enriched, "enriched-sales", rounds=rounds(enriched), dealt_by="sale_id")
    path = scratch_path(spark, "cells")
    history.write_cells(sales, path)

    def as_of(day: date) -> DataFrame:
        base = history.fold(history.cells_as_of(spark, path, sales, day), day)
        found = features.customer_features(sales, day, extracted_at=fixtures.NOW, base=base)
        return found.drop("feature_extraction_ts").withColumn("as_of", F.lit(day))

    return reduce(DataFrame.unionByName, [as_of(day) for day in _DAYS])


@register(
    "versioned_replace",
    with_ctes("select * exclude (list_price), list_price * 2 as list_price from products where active", "products"),
)
def versioned_replace(spark, sf_dir):
    """The products as a second version, made of the first one while that is still being read."""
    root = scratch_path(spark, "products-versions")
    versions.replace(fixtures.products(spark, sf_dir), root)
    first = versions.read_current(spark, root)
    doubled = first.filter("active").withColumn("list_price", (F.col("list_price") * 2).cast("decimal(18,2)"))
    versions.replace(doubled, root)
    return versions.read_current(spark, root)
