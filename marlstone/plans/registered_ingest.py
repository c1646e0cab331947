"""Registered queries on input that does not fit, and on counts taken while writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import quality, validity
from marlstone.operators.observed import watch_checks, watch_rejects
from marlstone.plans import fixtures, suites
from marlstone.plans.oracle_ctes import with_ctes
from marlstone.plans.registered import REGISTRY
from marlstone.plans.registry import register
from marlstone.sources import quarantine, writers
from marlstone.sources.scratch import scratch_path, written
from marlstone.streaming import clicks as stream

_TEXT_COLUMNS = (
    "sale_id", "sale_date", "year", "month", "product_id", "customer_id", "region_id", "quantity",
    "unit_price", "discount", "total_value", "channel", "status",
)
# Some lines lose their last two fields, others have one more.
_LINE = f"concat_ws(',', {', '.join(f'''coalesce(cast({c} as varchar), '')''' for c in _TEXT_COLUMNS)})"
_SHORT_LINE = f"concat_ws(',', {', '.join(f'''coalesce(cast({c} as varchar), '')''' for c in _TEXT_COLUMNS[:-2])})"
_TEXT_SALES = f"select {', '.join(f'cast({c} as varchar) as {c}' for c in _TEXT_COLUMNS)} from dirty_sales"
_BAD_LINES = f"""
select case when sale_id % 61 = 0 then {_SHORT_LINE} else {_LINE} || ',extra' end as record
from dirty_sales where sale_id % 61 = 0 or sale_id % 67 = 0"""


def _damaged_csv(spark, sf_dir) -> str:
    """The dirty sales as CSV lines, some with too few or too many fields."""
    sales = fixtures.dirty_sales(spark, sf_dir)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _TEXT_COLUMNS]
    line = (
        F.when(F.col("sale_id") % 61 == 0, F.concat_ws(",", *fields[:-2]))
        .when(F.col("sale_id") % 67 == 0, F.concat_ws(",", *fields, F.lit("extra")))
        .otherwise(F.concat_ws(",", *fields))
    )
    folder = scratch_path(spark, "damaged")
    # Every file needs the header in front of its lines.
    lines = sales.select(F.struct(line.alias(",".join(_TEXT_COLUMNS))).alias("line")).select("line.*")
    lines.write.option("header", True).option("quote", "\0").option("sep", "\x01").csv(folder)
    return folder


def _ingested(spark, sf_dir):
    target, aside = scratch_path(spark, "bronze"), scratch_path(spark, "quarantine")
    counts = quarantine.ingest_csv(spark, _damaged_csv(spark, sf_dir), target, aside)
    return target, aside, counts


@register("csv_bad_records", with_ctes(_BAD_LINES, "dirty_sales"))
def csv_bad_records(spark, sf_dir):
    return spark.read.parquet(_ingested(spark, sf_dir)[1]).select("record")


@register(
    "csv_good_records",
    with_ctes(
        "select * from text_sales where cast(sale_id as bigint) % 61 <> 0 and cast(sale_id as bigint) % 67 <> 0",
        "dirty_sales",
        text_sales=_TEXT_SALES,
    ),
)
def csv_good_records(spark, sf_dir):
    return spark.read.parquet(_ingested(spark, sf_dir)[0]).select(*_TEXT_COLUMNS)


@register(
    "csv_ingest_counts",
    with_ctes(
        f"select count(*) as rows, count(*) - (select count(*) from bad) as good, (select count(*) from bad) as bad "
        "from dirty_sales",
        "dirty_sales",
        bad=_BAD_LINES,
    ),
)
def csv_ingest_counts(spark, sf_dir):
    counts = _ingested(spark, sf_dir)[2]
    return spark.createDataFrame([tuple(counts)], "rows bigint, good bigint, bad bigint")


@register("reject_counts_observed", REGISTRY["reject_counts"].sql)
def reject_counts_observed(spark, sf_dir):
    """The reject counts, taken by the job that stores the rejected sales."""
    watch = watch_rejects()
    # Stored first, as bronze is in the batch run, so that the counting tasks are those that write.
    sales = written(fixtures.dirty_sales(spark, sf_dir), "bronze-sales")
    rejected = validity.rejected_sales(watch.on(sales))
    writers.write_parquet(rejected, scratch_path(spark, "rejects"))
    return watch.row(spark)


@register("dq_suite_silver_observed", REGISTRY["dq_suite_silver"].sql)
def dq_suite_silver_observed(spark, sf_dir):
    """The silver suite: row checks counted by the job that stores silver, keys read from it."""
    checks = suites.SILVER["enriched_sales"]
    enriched = fixtures.enriched_sales(spark, sf_dir)
    watch = watch_checks(enriched, checks)
    target = scratch_path(spark, "silver")
    by_month = ("year", "month")
    writers.write_parquet(enriched, target, by_month, observed=(watch.seen, watch.counts))
    stored = spark.read.parquet(target)
    return quality.run_suite(
        {"enriched_sales": stored}, suites.SILVER, "silver", {"enriched_sales": watch.row(spark)}
    )


_CLICK = "event_id bigint, user_id bigint, event_type string"
_MESSAGE = (
    "'{\"event_id\": ' || event_id || ', \"user_id\": ' || user_id || ', \"event_type\": \"' || event_type || '\"}'"
)
_MESSAGES = f"""
select event_id, event_id % 3 as part,
  case when event_id % 41 = 0 then null when event_id % 37 = 0 then substr({_MESSAGE}, 1, 20)
    when event_id % 43 = 0 then replace({_MESSAGE}, '"user_id": ', '"user_id": "u') else {_MESSAGE} end as body
from events"""


def _messages(spark, sf_dir):
    """Events as messages of a topic; some are empty, cut off, or hold text where a number belongs."""
    events = fixtures.table(spark, sf_dir, "events")
    number = F.col("event_id")
    whole = F.concat(
        F.lit('{"event_id": '), number, F.lit(', "user_id": '), F.col("user_id"),
        F.lit(', "event_type": "'), F.col("event_type"), F.lit('"}'),
    )
    body = (
        F.when(number % 41 == 0, F.lit(None))
        .when(number % 37 == 0, F.substring(whole, 1, 20))
        .when(number % 43 == 0, F.replace(whole, F.lit('"user_id": '), F.lit('"user_id": "u')))
        .otherwise(whole)
    )
    return events.select(
        body.cast("binary").alias("value"),
        F.lit("clicks").alias("topic"),
        (number % 3).cast("int").alias("partition"),
        number.alias("offset"),
    )


@register(
    "clicks_parsed",
    with_ctes(
        "select event_id, user_id, event_type from events "
        "where event_id % 41 <> 0 and event_id % 37 <> 0 and event_id % 43 <> 0"
    ),
)
def clicks_parsed(spark, sf_dir):
    return stream.parsed_clicks(stream.parse_messages(_messages(spark, sf_dir), _CLICK))


@register(
    "clicks_dead_letters",
    with_ctes(
        "select 'clicks' as topic, cast(part as integer) as partition, event_id as \"offset\", body, "
        "case when body is null then 'empty' else 'unparsed' end as reason from messages "
        "where event_id % 41 = 0 or event_id % 37 = 0 or event_id % 43 = 0",
        messages=_MESSAGES,
    ),
)
def clicks_dead_letters(spark, sf_dir):
    dead = stream.dead_letters(stream.parse_messages(_messages(spark, sf_dir), _CLICK))
    return dead.select("topic", "partition", "offset", F.col("value").cast("string").alias("body"), "reason")
