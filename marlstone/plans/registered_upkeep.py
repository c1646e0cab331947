"""Registered queries on what is kept up step by step: compacted streams, scanned files, sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import rescan
from marlstone.plans import fixtures, sketches
from marlstone.plans.oracle_ctes import with_ctes
from marlstone.plans.registered import _scanned_tables
from marlstone.plans.registry import REGISTRY, register
from marlstone.sources.scratch import scratch_path
from marlstone.streaming import clicks as stream
from marlstone.streaming import compaction


@register("pii_scan_incremental", REGISTRY["pii_scan"].sql)
def pii_scan_incremental(spark, sf_dir):
    """The findings of tables that grew between two scans, the second of which read new files only."""
    root, book = scratch_path(spark, "lake"), scratch_path(spark, "scan-ledger")
    tables = _scanned_tables(spark, sf_dir)
    lake = {"lake": {name: f"{root}/{name}" for name in tables}}
    for half in range(2):
        for name, df in tables.items():
            later = F.pmod(F.xxhash64(*df.columns), F.lit(2)) == half
            df.filter(later).write.mode("append").parquet(lake["lake"][name])
        rescan.scan(spark, book, lake)
    return rescan.findings(spark, book, lake)


@register("clicks_compacted", REGISTRY["clicks_stream"].sql)
def clicks_compacted(spark, sf_dir):
    """Streamed events read from compacted hours, which two arrivals filled."""
    events = fixtures.table(spark, sf_dir, "events")
    source, landing, progress, root = (scratch_path(spark, n) for n in ("arrivals", "landing", "progress", "compacted"))
    schema = stream.with_event_partitions(events, "ts").schema
    # The second half of each month comes second, and with it some late events of the first.
    second = F.coalesce((F.dayofmonth("ts") > 15) | (F.col("event_id") % 50 == 0), F.lit(True))
    for part in (~second, second):
        events.filter(part).write.mode("append").parquet(source)
        arrived = stream.file_clicks(spark, source, events.schema)
        stream.start_ingest(arrived, landing, progress, event_time="ts", interval=None).awaitTermination()
        compaction.compact(spark, landing, root, schema)
    columns = ("event_id", "user_id", "event_type", "value", "props", *stream.PARTITIONS)
    return compaction.read_compacted(spark, root, schema).select(*columns)


_MONTHS = ("1995-03", "1997-08")


@register(
    "distinct_customers_sketched",
    with_ctes(
        "select category, count(distinct customer_id) as customers, true as is_close from enriched "
        f"where strftime(sale_date, '%Y-%m') between '{_MONTHS[0]}' and '{_MONTHS[1]}' group by category",
        "enriched",
    ),
)
def distinct_customers_sketched(spark, sf_dir):
    """Customers per category over some months, counted, and whether merged sketches come within
    three standard errors."""
    sales = fixtures.enriched_sales(spark, sf_dir, ("products",))
    path = scratch_path(spark, "sketches")
    sketches.write_sketches(sales, path, ("category",), "customer_id")
    estimated = sketches.distinct_between(spark, path, ("category",), *_MONTHS)
    known = sales.filter(F.date_format("sale_date", "yyyy-MM").between(*_MONTHS))
    exact = known.groupBy("category").agg(F.count_distinct("customer_id").alias("customers"))
    off = F.abs(F.col("o.estimate") - F.col("e.customers")) / F.greatest(F.col("e.customers"), F.lit(1))
    close = F.coalesce(off <= 3 * sketches.relative_error(), F.lit(False))
    joined = exact.alias("e").join(estimated.alias("o"), F.col("e.category").eqNullSafe(F.col("o.category")), "left")
    return joined.select("e.category", "e.customers", close.alias("is_close"))
