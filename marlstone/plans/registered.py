"""Every operator as a named query over the test tables, next to the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.operators import customers as cust
from marlstone.operators import evaluation, marts, pii, quality, ranking, staging, validity
from marlstone.plans import churn, features, fixtures, suites
from marlstone.plans.fixtures import AS_OF, EARLIER, NOW
from marlstone.plans.oracle_ctes import mean2, mean2_of_means, mean6, rate4, restated, with_ctes
from marlstone.plans.registry import REGISTRY, register
from marlstone.sources import readers, writers
from marlstone.sources.catalog import tables_of
from marlstone.sources.scratch import scratch_path, written
from marlstone.streaming import clicks as stream


def _enriched(spark, sf_dir, *dimensions: str) -> DataFrame:
    """Enriched sales with just the dimensions a query draws on."""
    return fixtures.enriched_sales(spark, sf_dir, dimensions)


def _mart(spark, sf_dir) -> DataFrame:
    return marts.sales_mart(_enriched(spark, sf_dir, "products", "regions"))


def _base(spark, sf_dir) -> DataFrame:
    return features.customer_base(_enriched(spark, sf_dir, "customers", "products"), AS_OF)


# --- sources and sinks -------------------------------------------------------------------------

_SALES_COLUMNS = (
    "sale_id, sale_date, year, month, product_id, customer_id, region_id, quantity, unit_price, "
    "discount, total_value, channel, status"
)


@register("csv_ingest", with_ctes(f"select {_SALES_COLUMNS} from sales", "sales"))
def csv_ingest(spark, sf_dir):
    df = fixtures.sales(spark, sf_dir)
    source, target = scratch_path(spark, "raw-sales"), scratch_path(spark, "bronze-sales")
    df.write.option("header", True).csv(source)
    writers.csv_to_parquet(spark, source, target, ("year", "month"), schema=df.schema)
    return readers.read_parquet(spark, target).select(*df.columns)


@register("dim_roundtrip", with_ctes("select * from products", "products"))
def dim_roundtrip(spark, sf_dir):
    target = scratch_path(spark, "products")
    writers.write_parquet(fixtures.products(spark, sf_dir), target)
    return readers.read_parquet(spark, target)


def _partitioned_sales(spark, sf_dir) -> str:
    """Sales stored by year and month, written once per half of the history."""
    df = fixtures.sales(spark, sf_dir)
    target = scratch_path(spark, "sales-by-month")
    for part in (df, df.filter(F.col("year") >= 1998)):
        writers.write_parquet(part, target, ("year", "month"))
    return target


@register("partitioned_roundtrip", with_ctes(f"select {_SALES_COLUMNS} from sales", "sales"))
def partitioned_roundtrip(spark, sf_dir):
    target = _partitioned_sales(spark, sf_dir)
    columns = [c.strip() for c in _SALES_COLUMNS.split(",")]
    return readers.read_parquet(spark, target).select(*columns)


@register(
    "partition_scan_year", with_ctes(f"select {_SALES_COLUMNS} from sales where year = 1999", "sales")
)
def partition_scan_year(spark, sf_dir):
    df = readers.scan_year(spark, _partitioned_sales(spark, sf_dir), 1999)
    return df.select(*[c.strip() for c in _SALES_COLUMNS.split(",")])


@register(
    "register_table",
    with_ctes(
        "select year, month, count(*) as sales_count, cast(sum(total_value) as decimal(38,2)) "
        "as value from sales group by year, month",
        "sales",
    ),
)
def register_table(spark, sf_dir):
    name = _fresh("sales_by_month")
    writers.register_parquet_table(spark, name, _partitioned_sales(spark, sf_dir))
    return (
        readers.read_table(spark, name)
        .groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("sales_count"),
            F.sum("total_value").cast("decimal(38,2)").alias("value"),
        )
    )


def _fresh(prefix: str) -> str:
    import uuid

    return f"{prefix}_{uuid.uuid4().hex[:12]}"


_MONETARY = f"""
select customer_id, count(sale_id) as orders,
  cast(sum(total_value) as decimal(38,2)) as total_revenue,
  {mean6("sum(total_value)", "count(total_value)")} as ticket_mean,
  max(total_value) as ticket_max, min(total_value) as ticket_min
from done group by customer_id"""


@register("feature_table_read", with_ctes(_MONETARY, "done"))
def feature_table_read(spark, sf_dir):
    name = _fresh("customer_monetary")
    path = scratch_path(spark, name)
    writers.write_parquet(cust.monetary(_enriched(spark, sf_dir)), path)
    writers.register_parquet_table(spark, name, path)
    return readers.read_table(spark, name)


_STAGED_SALES = """
select try_cast(sale_id as bigint) as sale_id, try_cast(sale_date as date) as sale_date,
  try_cast(year as integer) as year, try_cast(month as integer) as month,
  try_cast(product_id as bigint) as product_id, try_cast(customer_id as bigint) as customer_id,
  try_cast(region_id as integer) as region_id, try_cast(quantity as integer) as quantity,
  try_cast(unit_price as decimal(18,2)) as unit_price,
  try_cast(discount as decimal(5,4)) as discount,
  try_cast(total_value as decimal(18,2)) as total_value, channel, status
from raw_sales where sale_id is not null"""

# Of raw tables staged by type: a sale may lack its key or its quantity.
_STAGED_CTES = {
    "staged_valid": restated("valid", dirty_sales="staged"),
    "staged_enriched": restated("enriched", valid="staged_valid"),
    "staged_done": restated("done", enriched="staged_enriched"),
    "staged_mart": restated("mart", done="staged_done"),
}


def _model_sql(layer: str, model: str, source: str, key: str, value: str) -> str:
    return (
        f"select '{layer}' as layer, '{model}' as model, count(*) as row_count, "
        f"cast(sum({key}) as bigint) as key_sum, cast(sum({value}) as decimal(38,2)) as value_sum from {source}"
    )


@register(
    "model_layers",
    with_ctes(
        " union all ".join(
            (
                _model_sql("bronze", "stg_sales", "staged", "sale_id", "total_value"),
                _model_sql("bronze", "stg_customers", "customers", "customer_id", "region_id"),
                _model_sql("bronze", "stg_products", "products", "product_id", "list_price"),
                _model_sql("bronze", "stg_regions", "regions", "region_id", "region_id"),
                _model_sql("silver", "enriched_sales", "staged_enriched", "sale_id", "total_value"),
                _model_sql("gold", "sales_mart", "staged_mart", "orders", "revenue"),
            )
        ),
        "raw_sales", "customers", "products", "regions",
        staged=_STAGED_SALES, **_STAGED_CTES,
    ),
)
def model_layers(spark, sf_dir):
    """Each model as a table of its layer's database; later models read the earlier tables."""
    run = _fresh("run")
    root = scratch_path(spark, run)
    sums = []

    def save(layer, model, df, key, value):
        saved = spark.table(writers.save_model(df, f"{run}_{layer}", model, root))
        counted = saved.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(key).cast("bigint").alias("key_sum"),
            F.sum(value).cast("decimal(38,2)").alias("value_sum"),
        )
        sums.append(counted.select(F.lit(layer).alias("layer"), F.lit(model).alias("model"), *counted.columns))
        return saved

    staged = [
        save("bronze", f"stg_{name}", df, key, value)
        for name, df, key, value in (
            ("sales", staging.stage(fixtures.raw_sales(spark, sf_dir), staging.SALES), "sale_id", "total_value"),
            ("customers", fixtures.customers(spark, sf_dir), "customer_id", "region_id"),
            ("products", fixtures.products(spark, sf_dir), "product_id", "list_price"),
            ("regions", fixtures.regions(spark, sf_dir), "region_id", "region_id"),
        )
    ]
    from marlstone.operators.enrich import enrich

    enriched = enrich(validity.valid_sales(staged[0]), *staged[1:])
    enriched = save("silver", "enriched_sales", enriched, "sale_id", "total_value")
    save("gold", "sales_mart", marts.sales_mart(enriched), "orders", "revenue")
    return _union(sums)


def _union(parts: list[DataFrame]) -> DataFrame:
    from functools import reduce

    return reduce(DataFrame.unionByName, parts)


# --- staging, validity, masking ----------------------------------------------------------------

@register("stg_sales", with_ctes(_STAGED_SALES, "raw_sales"))
def stg_sales(spark, sf_dir):
    return staging.stage(fixtures.raw_sales(spark, sf_dir), staging.SALES)


@register(
    "stg_sales_rejects",
    with_ctes(
        "select sale_id, quantity, 'quantity' as failed from raw_sales where sale_id is not null "
        "and quantity is not null and try_cast(quantity as integer) is null",
        "raw_sales",
    ),
)
def stg_sales_rejects(spark, sf_dir):
    failures = staging.cast_failures(fixtures.raw_sales(spark, sf_dir), staging.SALES)
    return failures.select("sale_id", "quantity", F.concat_ws(",", "failed_columns").alias("failed"))


@register("stg_customers", with_ctes("select * from customers", "customers"))
def stg_customers(spark, sf_dir):
    return fixtures.customers(spark, sf_dir)


@register("stg_products", with_ctes("select * from products", "products"))
def stg_products(spark, sf_dir):
    return fixtures.products(spark, sf_dir)


@register("stg_regions", with_ctes("select * from regions", "regions"))
def stg_regions(spark, sf_dir):
    return fixtures.regions(spark, sf_dir)


@register("valid_sales", with_ctes(f"select {_SALES_COLUMNS} from valid", "valid"))
def valid_sales(spark, sf_dir):
    return validity.valid_sales(fixtures.dirty_sales(spark, sf_dir))


_VALID = (
    "sale_id is not null and customer_id is not null and quantity > 0 and total_value >= 0 "
    "and status in ('Concluída', 'Cancelada', 'Em andamento')"
)


@register(
    "reject_counts",
    with_ctes(
        f"""
select count(*) as total, count(*) filter (where coalesce({_VALID}, false)) as approved,
  count(*) filter (where not coalesce({_VALID}, false)) as rejected,
  count(*) filter (where sale_id is null) as rejected_sale_id,
  count(*) filter (where customer_id is null) as rejected_customer_id,
  count(*) filter (where not coalesce(quantity > 0, false)) as rejected_quantity,
  count(*) filter (where not coalesce(total_value >= 0, false)) as rejected_total_value,
  count(*) filter (where not coalesce(status in ('Concluída', 'Cancelada', 'Em andamento'), false))
    as rejected_status
from dirty_sales""",
        "dirty_sales",
    ),
)
def reject_counts(spark, sf_dir):
    return validity.reject_counts(fixtures.dirty_sales(spark, sf_dir))


@register(
    "rejected_sales",
    with_ctes(
        """
select sale_id, customer_id, quantity, total_value, status, broken_rules from (
  select *, concat_ws(',',
    case when sale_id is null then 'sale_id' end,
    case when customer_id is null then 'customer_id' end,
    case when not coalesce(quantity > 0, false) then 'quantity' end,
    case when not coalesce(total_value >= 0, false) then 'total_value' end,
    case when not coalesce(status in ('Concluída', 'Cancelada', 'Em andamento'), false)
      then 'status' end) as broken_rules
  from dirty_sales)
where broken_rules <> ''""",
        "dirty_sales",
    ),
)
def rejected_sales(spark, sf_dir):
    return validity.rejected_sales(fixtures.dirty_sales(spark, sf_dir)).select(
        "sale_id", "customer_id", "quantity", "total_value", "status",
        F.array_join("broken_rules", ",").alias("broken_rules"),
    )


@register(
    "high_value_flag",
    with_ctes(
        "select sale_id, total_value, coalesce(total_value > 10000, false) as is_high_value "
        "from dirty_sales",
        "dirty_sales",
    ),
)
def high_value_flag(spark, sf_dir):
    flagged = validity.with_high_value_flag(fixtures.dirty_sales(spark, sf_dir))
    return flagged.select("sale_id", "total_value", "is_high_value")


_CUSTOMERS_WITHOUT_CPF = (
    "select customer_id, customer_name, email, {cpf} segment, state, region_id, registered_on "
    "from customers"
)


@register(
    "masked_customers",
    with_ctes(_CUSTOMERS_WITHOUT_CPF.format(cpf="cast(null as varchar) as cpf,"), "customers"),
)
def masked_customers(spark, sf_dir):
    return pii.mask_as_null(fixtures.customers(spark, sf_dir), {"cpf": "string"})


@register("column_excluded_view", with_ctes(_CUSTOMERS_WITHOUT_CPF.format(cpf=""), "customers"))
def column_excluded_view(spark, sf_dir):
    name = _fresh("customers_for_marketing")
    return pii.column_excluded_view(fixtures.customers(spark, sf_dir), name, ["cpf"])


# --- enrichment, mart, reports -----------------------------------------------------------------


@register("enriched_sales", with_ctes("select * from enriched", "enriched"))
def enriched_sales(spark, sf_dir):
    return fixtures.enriched_sales(spark, sf_dir)


@register("enriched_sales_salted", with_ctes("select * from enriched", "enriched"))
def enriched_sales_salted(spark, sf_dir):
    return fixtures.enriched_sales(spark, sf_dir, salt=("customer_id", "product_id", "region_id"))


@register("sales_mart", with_ctes("select * from mart", "mart"))
def sales_mart(spark, sf_dir):
    return _mart(spark, sf_dir)


@register("sales_mart_from_fact", with_ctes("select * from mart", "mart"))
def sales_mart_from_fact(spark, sf_dir):
    return marts.sales_mart_from_fact(
        validity.valid_sales(fixtures.dirty_sales(spark, sf_dir)),
        fixtures.products(spark, sf_dir),
        fixtures.regions(spark, sf_dir),
    )


_WEIGHTED = f"{mean6('sum(revenue)', 'cast(sum(orders) as hugeint)')} as weighted_ticket"
_REVENUE = "cast(sum(revenue) as decimal(38,2)) as revenue"
_ORDERS = "cast(sum(orders) as bigint) as orders"
_PLAIN = f"{mean2_of_means('ticket_mean')} as ticket_mean"


@register(
    "revenue_by_category",
    with_ctes(
        f"select category, {_REVENUE}, {_ORDERS}, cast(sum(units) as bigint) as units, {_PLAIN}, "
        f"{_WEIGHTED} from mart group by category",
        "mart",
    ),
)
def revenue_by_category(spark, sf_dir):
    return marts.revenue_by_category(_mart(spark, sf_dir))


@register(
    "revenue_by_channel_region",
    with_ctes(
        f"select channel, region_name, {_REVENUE}, {_ORDERS}, {_PLAIN}, {_WEIGHTED} "
        "from mart group by channel, region_name",
        "mart",
    ),
)
def revenue_by_channel_region(spark, sf_dir):
    return marts.revenue_by_channel_region(_mart(spark, sf_dir))


@register(
    "ticket_by_category_month",
    with_ctes(
        f"select year, month, category, {_PLAIN}, {_WEIGHTED}, {_ORDERS} "
        "from mart group by year, month, category",
        "mart",
    ),
)
def ticket_by_category_month(spark, sf_dir):
    return marts.ticket_by_category_month(_mart(spark, sf_dir))


@register(
    "top10_products",
    with_ctes(
        """
select product_name, category, cast(sum(quantity) as bigint) as units,
  cast(sum(total_value) as decimal(38,2)) as revenue, count(sale_id) as orders
from done group by product_name, category
order by units desc, revenue desc, product_name asc nulls last, category asc nulls last limit 10""",
        "done",
    ),
)
def top10_products(spark, sf_dir):
    return marts.top_products(_enriched(spark, sf_dir, "products"))


@register(
    "cancelled_by_month",
    with_ctes(
        f"""
select year, month, count(sale_id) as cancelled,
  cast(sum(total_value) as decimal(38,2)) as cancelled_value,
  {mean2("sum(total_value)", "count(total_value)")} as cancelled_ticket_mean
from enriched where status = 'Cancelada' group by year, month""",
        "enriched",
    ),
)
def cancelled_by_month(spark, sf_dir):
    return marts.cancelled_by_month(_enriched(spark, sf_dir))


@register(
    "customers_by_segment",
    with_ctes(
        "select segment, state, count(customer_id) as customers from customers "
        "group by segment, state",
        "customers",
    ),
)
def customers_by_segment(spark, sf_dir):
    return marts.customers_by_segment(fixtures.customers(spark, sf_dir))


@register(
    "kpi_totals",
    with_ctes(
        f"""
select {_REVENUE}, {_ORDERS},
  cast(cast((cast(cast(sum(ticket_mean) as decimal(38,6)) * 1000000 as hugeint) * 2 + count(*))
    // (2 * count(*)) as double) / 1000000 as decimal(22,6)) as ticket_mean, {_WEIGHTED}
from mart""",
        "mart",
    ),
)
def kpi_totals(spark, sf_dir):
    return marts.kpi_totals(_mart(spark, sf_dir))


def _top_plus_other_sql(dimension: str, limit: int = 10) -> str:
    return with_ctes(
        f"""
select rn > {limit} as is_other, case when rn > {limit} then 'other' else {dimension} end
    as {dimension}, cast(sum(revenue) as decimal(38,2)) as revenue
from (
  select {dimension}, sum(revenue) as revenue, row_number() over (
    order by sum(revenue) desc nulls last, {dimension} asc nulls last) as rn
  from mart group by {dimension}) totals
group by 1, 2""",
        "mart",
    )


@register("top10_plus_other_category", _top_plus_other_sql("category"))
def top10_plus_other_category(spark, sf_dir):
    return marts.top_plus_other(_mart(spark, sf_dir), "category")


@register("top10_plus_other_region", _top_plus_other_sql("region_name"))
def top10_plus_other_region(spark, sf_dir):
    return marts.top_plus_other(_mart(spark, sf_dir), "region_name")


@register("top3_plus_other_channel", _top_plus_other_sql("channel", 3))
def top3_plus_other_channel(spark, sf_dir):
    return marts.top_plus_other(_mart(spark, sf_dir), "channel", limit=3)


@register(
    "monthly_trend",
    with_ctes(f"select month, category, {_REVENUE} from mart group by month, category", "mart"),
)
def monthly_trend(spark, sf_dir):
    return marts.monthly_trend(_mart(spark, sf_dir))


# --- customer features -------------------------------------------------------------------------


@register(
    "active_months",
    with_ctes(
        "select customer_id, count(*) as active_months from months group by customer_id", "months"
    ),
)
def active_months(spark, sf_dir):
    return cust.active_months(_enriched(spark, sf_dir))


@register(
    "orders_last_6m",
    with_ctes(
        f"select customer_id, {rate4('sum(month_orders)', 'count(*)')} as orders_per_month_6m "
        "from months where year > 2001 or (year = 2001 and month >= 2) group by customer_id",
        "months",
    ),
)
def orders_last_6m(spark, sf_dir):
    return cust.orders_in_trailing_months(_enriched(spark, sf_dir), AS_OF)


@register(
    "preferred_channel",
    with_ctes(
        "select customer_id, channel as preferred_channel from channels where rn = 1", "channels"
    ),
)
def preferred_channel(spark, sf_dir):
    return cust.preferred_channel(_enriched(spark, sf_dir))


@register(
    "preferred_channel_ties",
    with_ctes(
        "select customer_id, channel as preferred_channel from channels where rk = 1", "channels"
    ),
)
def preferred_channel_ties(spark, sf_dir):
    return cust.preferred_channel_ties(_enriched(spark, sf_dir))


@register(
    "customer_dim_latest",
    with_ctes(
        """
select customer_id, segment as customer_segment, state as customer_state from (
  select customer_id, segment, state, row_number() over (partition by customer_id
    order by sale_date desc, segment desc nulls last, state desc nulls last) as rn
  from enriched) ordered where rn = 1""",
        "enriched",
    ),
)
def customer_dim_latest(spark, sf_dir):
    return cust.latest_profile(_enriched(spark, sf_dir, "customers"))


@register("customer_monetary", with_ctes(_MONETARY, "done"))
def customer_monetary(spark, sf_dir):
    return cust.monetary(_enriched(spark, sf_dir))


@register(
    "distinct_categories",
    with_ctes(
        "select customer_id, count(distinct category) as category_count from done "
        "group by customer_id",
        "done",
    ),
)
def distinct_categories(spark, sf_dir):
    return cust.distinct_categories(_enriched(spark, sf_dir, "products"))


@register(
    "high_value_orders",
    with_ctes(
        "select customer_id, count(*) filter (where is_high_value) as high_value_orders from done "
        "group by customer_id",
        "done",
    ),
)
def high_value_orders(spark, sf_dir):
    return cust.high_value_orders(_enriched(spark, sf_dir))


_RECENCY = (
    "select customer_id, cast(date_diff('day', max(sale_date), date '2001-08-01') as integer) "
    "as days_since_purchase from done group by customer_id"
)


@register("recency", with_ctes(_RECENCY, "done"))
def recency(spark, sf_dir):
    return cust.recency(_enriched(spark, sf_dir), AS_OF)


@register(
    "churn_label",
    with_ctes(
        "select customer_id, days_since_purchase, "
        "cast(case when days_since_purchase > 90 then 1 else 0 end as integer) as churn_label "
        f"from ({_RECENCY}) r",
        "done",
    ),
)
def churn_label(spark, sf_dir):
    return cust.with_churn_label(cust.recency(_enriched(spark, sf_dir), AS_OF))


@register(
    "cancel_rate",
    with_ctes(
        "select customer_id, "
        + rate4("count(*) filter (where status = 'Cancelada')", "count(sale_id)")
        + " as cancel_rate from enriched group by customer_id",
        "enriched",
    ),
)
def cancel_rate(spark, sf_dir):
    return cust.cancel_rate(_enriched(spark, sf_dir))


def _rfm_input(spark, sf_dir) -> DataFrame:
    columns = ("customer_id", "days_since_purchase", "orders", "total_revenue")
    return written(_base(spark, sf_dir).select(*columns), "rfm-input")


@register(
    "rfm_percent_ranks",
    with_ctes(
        "select customer_id, recency_rank, frequency_rank, monetary_rank from scored", "scored"
    ),
)
def rfm_percent_ranks(spark, sf_dir):
    return ranking.percent_ranks(_rfm_input(spark, sf_dir), "customer_id", ranking.RFM)


@register("rfm_score", with_ctes("select customer_id, rfm_score from scored", "scored"))
def rfm_score(spark, sf_dir):
    ranks = ranking.percent_ranks(_rfm_input(spark, sf_dir), "customer_id", ranking.RFM)
    return ranking.rfm_score(ranks).select("customer_id", "rfm_score")


def _features(spark, sf_dir, **options) -> DataFrame:
    enriched = _enriched(spark, sf_dir, "customers", "products")
    return features.customer_features(enriched, AS_OF, extracted_at=NOW, **options)


_FEATURE_COLUMNS = ", ".join(features.FEATURES[:-1])


@register("customer_base", with_ctes("select * from base", "base"))
def customer_base(spark, sf_dir):
    return _base(spark, sf_dir)


@register("customer_features", with_ctes(f"select {_FEATURE_COLUMNS} from scored", "scored"))
def customer_features(spark, sf_dir):
    return _features(spark, sf_dir).drop("feature_extraction_ts")


@register(
    "customer_features_tied",
    with_ctes(
        f"select {_FEATURE_COLUMNS} from scored",
        "base",
        tied="select b.* exclude (preferred_channel), k.channel as preferred_channel from base b "
        "left join channels k on b.customer_id = k.customer_id and k.rk = 1",
        scored=with_ctes("", "scored").split("scored as (", 1)[1].rsplit(")", 1)[0].replace(
            "from base)", "from tied)"
        ),
    ),
)
def customer_features_tied(spark, sf_dir):
    return _features(spark, sf_dir, all_tied_channels=True).drop("feature_extraction_ts")


@register(
    "latest_snapshot",
    with_ctes(
        "select customer_id, orders, total_revenue, date '2001-08-01' as extracted_on from "
        f"({_MONETARY}) m",
        "done",
    ),
)
def latest_snapshot(spark, sf_dir):
    """Two extractions, half a year apart, of which the later one is kept."""
    enriched = _enriched(spark, sf_dir)
    snapshots = _union(
        [
            cust.monetary(enriched.filter(F.col("sale_date") <= day)).select(
                "customer_id", "orders", "total_revenue", F.lit(day).alias("extracted_on")
            )
            for day in (EARLIER, AS_OF)
        ]
    )
    return features.latest_snapshot(written(snapshots, "snapshots"), "extracted_on")


_SUMMARISED = ("rfm_score", "orders_per_month_6m", "cancel_rate", "days_since_purchase")


def _summary_sql(columns: tuple[str, ...]) -> str:
    one = """
select '{c}' as "column", count({c}) as count, round(avg(cast({c} as double)), 6) as mean,
  round(stddev_samp(cast({c} as double)), 6) as std, min(cast({c} as double)) as min,
  max(cast({c} as double)) as max,
  round(quantile_cont(cast({c} as double), 0.25), 6) as q25,
  round(quantile_cont(cast({c} as double), 0.5), 6) as q50,
  round(quantile_cont(cast({c} as double), 0.75), 6) as q75
from scored"""
    return with_ctes(" union all ".join(one.format(c=c) for c in columns), "scored")


@register("feature_summary", _summary_sql(_SUMMARISED))
def feature_summary(spark, sf_dir):
    df = evaluation.summary(written(_features(spark, sf_dir), "features"), _SUMMARISED)
    rounded = ("mean", "std", "q25", "q50", "q75")
    return df.withColumns({c: F.round(c, 6) for c in rounded})


@register(
    "label_rate",
    with_ctes(
        'select count(*) as "rows", avg(churn_label) as label_rate from scored', "scored"
    ),
)
def label_rate(spark, sf_dir):
    labelled = cust.with_churn_label(_base(spark, sf_dir))
    return evaluation.label_rate(labelled, "churn_label")


# --- data quality ------------------------------------------------------------------------------

_SALES_TOTAL = "select count(*) from dirty_sales"


def _check_sql(name: str, failed: str, source: str = "dirty_sales") -> str:
    return (
        f"select '{name}' as \"check\", count(*) as total, cast({failed} as bigint) as failed, "
        f"coalesce(cast({failed} as double) / nullif(count(*), 0), 0.0) as rate from {source}"
    )


def _failing(condition: str) -> str:
    return f"count(*) filter (where {condition})"


_OUTSIDE = "status not in ('Concluída', 'Cancelada', 'Em andamento')"


def _unique_failed(column: str) -> str:
    return (
        f"(count(*) - count(distinct {column}) "
        f"- least(count(*) filter (where {column} is null), 1))"
    )


def _checked(spark, sf_dir, *checks) -> DataFrame:
    results = quality.run_checks(fixtures.dirty_sales(spark, sf_dir), checks, "bronze", "sales")
    return results.select("check", "total", "failed", "rate")


@register(
    "dq_not_null",
    with_ctes(
        " union all ".join(
            _check_sql(f"not_null:{c}", _failing(f"{c} is null"))
            for c in ("customer_id", "sale_id", "status")
        ),
        "dirty_sales",
    ),
)
def dq_not_null(spark, sf_dir):
    return _checked(spark, sf_dir, *map(quality.not_null, ("customer_id", "sale_id", "status")))


@register(
    "dq_unique",
    with_ctes(
        " union all ".join(
            _check_sql(f"unique:{c}", _unique_failed(c)) for c in ("sale_id", "customer_id")
        ),
        "dirty_sales",
    ),
)
def dq_unique(spark, sf_dir):
    return _checked(spark, sf_dir, *map(quality.unique, ("sale_id", "customer_id")))


@register(
    "dq_accepted_values",
    with_ctes(_check_sql("accepted_values:status", _failing(_OUTSIDE)), "dirty_sales"),
)
def dq_accepted_values(spark, sf_dir):
    return _checked(spark, sf_dir, quality.accepted_values("status", rules.STATUSES))


@register(
    "dq_non_negative",
    with_ctes(_check_sql("non_negative:total_value", _failing("total_value < 0")), "dirty_sales"),
)
def dq_non_negative(spark, sf_dir):
    return _checked(spark, sf_dir, quality.non_negative("total_value"))


@register(
    "dq_positive",
    with_ctes(_check_sql("positive:quantity", _failing("quantity <= 0")), "dirty_sales"),
)
def dq_positive(spark, sf_dir):
    return _checked(spark, sf_dir, quality.positive("quantity"))


_SQL_TABLE = {
    "sales": "dirty_sales",
    "customers": "customers",
    "products": "products",
    "regions": "regions",
    "enriched_sales": "enriched",
    "sales_mart": "mart",
    "stg_sales": "dirty_sales",
    "stg_customers": "customers",
    "stg_customers_marketing": "customers",
    "stg_products": "products",
    "stg_regions": "regions",
}


def _failed_sql(check: quality.Check) -> str:
    column = check.column
    listed = ", ".join(str(v).lower() if isinstance(v, bool) else f"'{v}'" for v in check.values)
    return {
        "not_null": lambda: _failing(f"{column} is null"),
        "unique": lambda: _unique_failed(column),
        "unique_values": lambda: _unique_failed(column),
        "accepted_values": lambda: _failing(f"{column} not in ({listed})"),
        "non_negative": lambda: _failing(f"{column} < 0"),
        "positive": lambda: _failing(f"{column} <= 0"),
    }[check.kind]()


def _suite_sql(suite: dict, layer: str, tables: dict[str, str] | None = None) -> str:
    """One select per check: the SQL stays as plain as the checks are."""
    parts = []
    for table, checks in suite.items():
        source = (tables or _SQL_TABLE)[table]
        for position, check in enumerate(checks):
            head = (
                f"select '{layer}' as layer, '{table}' as \"table\", {position} as position, "
                f"'{check.category}' as category, "
            )
            if check.kind == "unique_values":
                body = (
                    f"'{check.name}' as \"check\", (select count(*) from {source}) as total, "
                    f"count(*) as failed, coalesce(cast(count(*) as double) / "
                    f"nullif((select count(*) from {source}), 0), 0.0) as rate from "
                    f"(select {check.column} from {source} where {check.column} is not null "
                    f"group by {check.column} having count(*) > 1) repeated"
                )
            else:
                body = _check_sql(check.name, _failed_sql(check), source)[len("select ") :]
            parts.append(head + body)
    return " union all ".join(parts)


def _bronze_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "sales": fixtures.dirty_sales(spark, sf_dir),
        "customers": fixtures.customers(spark, sf_dir),
        "products": fixtures.products(spark, sf_dir),
        "regions": fixtures.regions(spark, sf_dir),
    }


def _bronze_results(spark, sf_dir) -> DataFrame:
    return quality.run_suite(_bronze_tables(spark, sf_dir), suites.BRONZE, "bronze")


def _silver_results(spark, sf_dir) -> DataFrame:
    return quality.run_suite(
        {"enriched_sales": fixtures.enriched_sales(spark, sf_dir)}, suites.SILVER, "silver"
    )


_BRONZE_SQL = _suite_sql(suites.BRONZE, "bronze")
_SILVER_SQL = _suite_sql(suites.SILVER, "silver")
_LAYER_CTES = ("dirty_sales", "customers", "products", "regions")


@register("dq_suite_bronze", with_ctes(_BRONZE_SQL, *_LAYER_CTES))
def dq_suite_bronze(spark, sf_dir):
    return _bronze_results(spark, sf_dir)


@register("dq_suite_silver", with_ctes(_SILVER_SQL, "enriched"))
def dq_suite_silver(spark, sf_dir):
    return _silver_results(spark, sf_dir)


_EVALUATED_SQL = """
select c.layer, c."table", c.position, c.category, c."check", c.total, c.failed, c.rate,
  t.threshold, c.rate <= t.threshold as passed,
  case when c.rate > t.threshold then '[' || t.label || '] ' || c."check" || ': taxa='
    || cast(cast(round(cast(c.rate * 100 as decimal(20,8)), 2) as decimal(20,2)) as varchar)
    || '% (limiar=' || t.shown || ', falhas=' || cast(c.failed as varchar) || '/'
    || cast(c.total as varchar) || ')' end as message
from checks c join (values ('integrity', 0.0::double, 'INTEGRIDADE', '0%'),
  ('completeness', 0.05::double, 'COMPLETUDE', '5%'), ('business', 0.0::double, 'NEGÓCIO', '0%'))
  t(category, threshold, label, shown) on c.category = t.category"""


@register(
    "dq_evaluate",
    with_ctes(
        _EVALUATED_SQL,
        "enriched",
        checks=f"{_BRONZE_SQL} union all {_SILVER_SQL}",
    ),
)
def dq_evaluate(spark, sf_dir):
    results = _bronze_results(spark, sf_dir).unionByName(_silver_results(spark, sf_dir))
    return quality.evaluate(results)


# Sources are checked as they come, staged models after their types are set.
_CONTRACT_TABLE = _SQL_TABLE | {
    "sales": "raw_sales", "customers": "raw_customers", "products": "raw_products", "stg_sales": "staged",
}


@register(
    "dq_contract_models",
    with_ctes(
        " union all ".join(
            _suite_sql(suite, layer, _CONTRACT_TABLE) for layer, suite in suites.CONTRACTS.items()
        ),
        "mart", "raw_sales",
        staged=_STAGED_SALES,
    ),
)
def dq_contract_models(spark, sf_dir):
    raw = {
        "sales": written(fixtures.raw_sales(spark, sf_dir), "raw-sales"),
        "customers": fixtures.raw_customers(spark, sf_dir),
        "products": fixtures.raw_products(spark, sf_dir),
        "regions": fixtures.raw_regions(spark, sf_dir),
    }
    typed = {
        "stg_sales": staging.stage(raw["sales"], staging.SALES),
        "stg_customers": staging.stage(raw["customers"], staging.CUSTOMERS),
        "stg_products": staging.stage(raw["products"], staging.PRODUCTS),
        "stg_regions": staging.stage(raw["regions"], staging.REGIONS),
    }
    enriched = written(fixtures.enriched_sales(spark, sf_dir), "enriched")
    models = {
        **raw,
        **typed,
        "stg_customers_marketing": pii.mask_as_null(typed["stg_customers"], ["cpf"]),
        "enriched_sales": enriched,
        "sales_mart": marts.sales_mart(enriched),
    }
    return _union(
        [quality.run_suite(models, suite, layer) for layer, suite in suites.CONTRACTS.items()]
    )


@register(
    "dq_assert_no_negative_completed",
    with_ctes("select sale_id, total_value from done where total_value < 0", "done"),
)
def dq_assert_no_negative_completed(spark, sf_dir):
    return _negative_completed(_enriched(spark, sf_dir))


@register(
    "dq_assert_no_negative_unfiltered",
    with_ctes(
        "select sale_id, total_value from dirty_sales where status = 'Concluída' "
        "and total_value < 0",
        "dirty_sales",
    ),
)
def dq_assert_no_negative_unfiltered(spark, sf_dir):
    return _negative_completed(fixtures.dirty_sales(spark, sf_dir))


def _negative_completed(df: DataFrame) -> DataFrame:
    broken = (F.col("status") == rules.COMPLETED) & (F.col("total_value") < 0)
    return quality.assert_empty(df, broken, "sale_id", "total_value")


@register(
    "quality_report",
    with_ctes(
        'select layer, category, "check", total, failed, rate from checks',
        "enriched",
        checks=f"{_BRONZE_SQL} union all {_SILVER_SQL}",
    ),
)
def quality_report(spark, sf_dir):
    """The details of the published gate report, read back from its dated path."""
    results = _bronze_results(spark, sf_dir).unionByName(_silver_results(spark, sf_dir))
    evaluated = written(quality.evaluate(results), "gate")
    path = writers.dated_path(scratch_path(spark, "reports"), NOW, "quality_gate_report.json")
    layers = ["bronze", "silver"]
    writers.write_document(quality.gate_report(evaluated, NOW, layers), path)
    entry = "array<struct<check: string, total: bigint, failed: bigint, rate: double>>"
    categories = ", ".join(f"{c}: {entry}" for c in rules.THRESHOLDS)
    schema = f"details struct<{', '.join(f'{la}: struct<{categories}>' for la in layers)}>"
    read = spark.read.schema(schema).json(path)
    return _union(
        [
            read.select(
                F.lit(layer).alias("layer"),
                F.lit(category).alias("category"),
                F.inline(f"details.{layer}.{category}"),
            )
            for layer in layers
            for category in rules.THRESHOLDS
        ]
    )


# --- personal data -----------------------------------------------------------------------------


def _stored_customers(spark, sf_dir) -> DataFrame:
    from marlstone.naming import to_stored

    return to_stored(fixtures.customers(spark, sf_dir))


def _scanned_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "clientes": _stored_customers(spark, sf_dir),
        **{
            name: fixtures.table(spark, sf_dir, name)
            for name in ("documents", "conversations", "pages", "supplier")
        },
    }


_TEXT_COLUMNS = (
    ("documents", "text"),
    ("documents", "lang"),
    ("documents", "source"),
    ("conversations", "role"),
    ("conversations", "text"),
    ("pages", "url"),
    ("pages", "html"),
    ("supplier", "s_name"),
)


def _pattern_sql(table: str, column: str, pattern: rules.Pattern) -> str:
    flag = ", 'i'" if pattern.ignore_case else ""
    matched = f"count(*) filter (where regexp_matches({column}, '{pattern.regex}'{flag}))"
    return (
        f"select '{table}' as \"table\", '{column}' as \"column\", '{pattern.pii_type}' as "
        f'pii_type, {matched} as matched, count({column}) as "values", coalesce(cast({matched} '
        f"as double) / nullif(count({column}), 0), 0.0) as match_rate from {table}"
    )


@register(
    "pii_name_hints",
    with_ctes(
        """
select 'lake' as "database", 'clientes' as "table", 'email' as "column", 'Email' as pii_type,
  'dado_pessoal' as lgpd_class, 'high' as confidence, cast(null as double) as match_rate,
  count(email) as exposed from customers
union all select 'lake', 'clientes', 'cpf', 'CPF', 'dado_pessoal', 'high', null, count(cpf)
from customers
union all select 'lake', 'clientes', 'nome_cliente', 'NomePessoa', 'dado_pessoal', 'high', null,
  count(customer_name) from customers""",
        "customers",
    ),
)
def pii_name_hints(spark, sf_dir):
    return pii.name_findings(_stored_customers(spark, sf_dir), "lake", "clientes")


@register(
    "pii_regex_rates",
    " union all ".join(_pattern_sql(t, c, p) for t, c in _TEXT_COLUMNS for p in rules.PATTERNS),
)
def pii_regex_rates(spark, sf_dir):
    tables = _scanned_tables(spark, sf_dir)
    names = ("documents", "conversations", "pages", "supplier")
    return _union([pii.pattern_rates(tables[name], name) for name in names])


def _detected_sql(columns) -> str:
    rates = " union all ".join(
        f"select {i} as pattern_no, '{p.lgpd_class}' as lgpd_class, r.* from "
        f"({_pattern_sql(t, c, p)}) r"
        for t, c in columns
        for i, p in enumerate(rules.PATTERNS)
    )
    return (
        "select 'lake' as \"database\", \"table\", \"column\", pii_type, lgpd_class, "
        "'medium' as confidence, match_rate from (select *, row_number() over (partition by "
        f'"table", "column" order by pattern_no) as rn from ({rates}) rates '
        'where match_rate >= 0.20 and "values" > 0) ordered where rn = 1'
    )


@register("pii_regex_detect", _detected_sql(_TEXT_COLUMNS))
def pii_regex_detect(spark, sf_dir):
    tables = _scanned_tables(spark, sf_dir)
    names = ("documents", "conversations", "pages", "supplier")
    return _union([pii.scan_table(tables[n], "lake", n, hints=()) for n in names])


_SCAN_SQL = (
    """
select 'lake' as "database", 'clientes' as "table", 'email' as "column", 'Email' as pii_type,
  'dado_pessoal' as lgpd_class, 'high' as confidence, cast(null as double) as match_rate
union all select 'lake', 'clientes', 'cpf', 'CPF', 'dado_pessoal', 'high', null
union all select 'lake', 'clientes', 'nome_cliente', 'NomePessoa', 'dado_pessoal', 'high', null
union all """
    + _detected_sql((*_TEXT_COLUMNS, ("customers", "segment"), ("customers", "state")))
)


@register("pii_scan", with_ctes(_SCAN_SQL, "customers"))
def pii_scan(spark, sf_dir):
    return pii.scan_databases({"lake": _scanned_tables(spark, sf_dir)})


@register(
    "pii_report",
    with_ctes(
        'select "table", "column", pii_type, lgpd_class, confidence, match_rate, '
        f"cast(count(*) over () as integer) as total_pii_cols from ({_SCAN_SQL}) found",
        "customers",
    ),
)
def pii_report(spark, sf_dir):
    """The findings of the published report on a registered database, read back."""
    database = _fresh("lake")
    root = scratch_path(spark, database)
    for name, df in _scanned_tables(spark, sf_dir).items():
        writers.save_model(df, database, name, root)
    found = pii.scan_databases({database: tables_of(spark, database, f"{root}/{database}")})
    path = writers.dated_path(scratch_path(spark, "reports"), NOW, "pii_report.json")
    writers.write_document(pii.findings_report(found, NOW, [database]), path)
    schema = f"total_pii_cols int, findings array<struct<{pii.FINDING}>>"
    read = spark.read.schema(schema).json(path)
    return read.select("total_pii_cols", F.inline("findings")).drop("database")


def _customer_findings(spark, sf_dir) -> tuple[DataFrame, list]:
    df = _stored_customers(spark, sf_dir)
    found = pii.scan_table(df, "lake", "clientes")
    return df, pii.findings_of(found, "lake", "clientes")


_STORED_CUSTOMERS = (
    "select customer_id as id_cliente, {name} as nome_cliente, {email} as email, {cpf} as cpf, "
    "segment as segmento, state as estado, region_id as id_regiao, "
    "registered_on as data_cadastro from customers"
)


@register(
    "pii_tag_metadata",
    with_ctes(
        _STORED_CUSTOMERS.format(name="customer_name", email="email", cpf="cpf"), "customers"
    ),
)
def pii_tag_metadata(spark, sf_dir):
    """The customers with tagged columns, written and read back with their tags."""
    df, found = _customer_findings(spark, sf_dir)
    path = scratch_path(spark, "tagged")
    writers.write_parquet(pii.tag_columns(df, found, NOW), path)
    return readers.read_parquet(spark, path)


@register(
    "pii_masked_table",
    with_ctes(
        _STORED_CUSTOMERS.format(
            name="cast(null as varchar)", email="cast(null as varchar)", cpf="cast(null as varchar)"
        ),
        "customers",
    ),
)
def pii_masked_table(spark, sf_dir):
    return pii.mask_found(*_customer_findings(spark, sf_dir))


# --- stream ------------------------------------------------------------------------------------


@register(
    "clicks_stream",
    "select event_id, user_id, event_type, value, props, cast(year(ts) as integer) as year, "
    "cast(month(ts) as integer) as month, cast(day(ts) as integer) as day, "
    "cast(hour(ts) as integer) as hour from events",
)
def clicks_stream(spark, sf_dir):
    """Events streamed from their file into partitioned JSON; a second run adds nothing."""
    schema = fixtures.table(spark, sf_dir, "events").schema
    target, checkpoint = scratch_path(spark, "clicks"), scratch_path(spark, "clicks-progress")
    for _ in range(2):
        source = stream.file_clicks(spark, sf_dir, schema, "events.parquet*")
        query = stream.start_ingest(source, target, checkpoint, event_time="ts", interval=None)
        query.awaitTermination()
    columns = ("event_id", "user_id", "event_type", "value", "props", *stream.PARTITIONS)
    written_schema = stream.with_event_partitions(
        fixtures.table(spark, sf_dir, "events"), "ts"
    ).schema
    return spark.read.schema(written_schema).json(target).select(*columns)


@register(
    "clicks_partitioned",
    "select cast(year(ts) as integer) as year, cast(month(ts) as integer) as month, "
    "cast(day(ts) as integer) as day, cast(hour(ts) as integer) as hour, count(*) as clicks "
    "from events group by 1, 2, 3, 4",
)
def clicks_partitioned(spark, sf_dir):
    parted = stream.with_event_partitions(fixtures.clicks(spark, sf_dir))
    return parted.groupBy(*stream.PARTITIONS).agg(F.count(F.lit(1)).alias("clicks"))


# --- churn model -------------------------------------------------------------------------------

_SPLIT = """
select customer_id, churn_label, rn <= round(0.8 * total) as is_train from (
  select customer_id, churn_label, count(*) over (partition by churn_label) as total,
    row_number() over (partition by churn_label
      order by md5('42:' || cast(customer_id as varchar))) as rn
  from scored) placed"""


@register("stratified_split", with_ctes(_SPLIT, "scored"))
def stratified_split(spark, sf_dir):
    labelled = cust.with_churn_label(_base(spark, sf_dir))
    chosen = written(labelled.select("customer_id", "churn_label"), "labelled")
    return evaluation.stratified_split(chosen, "customer_id", "churn_label")


_FORECAST = "cast(orders_per_month_6m <= 1.0 as integer)"


@register(
    "classification_report",
    with_ctes(
        f"""
select class, precision, recall, f1, support from (
  select class, coalesce(hit / nullif(predicted, 0), 0.0) as precision,
    coalesce(hit / nullif(support, 0), 0.0) as recall,
    coalesce(2 * hit / nullif(predicted + support, 0), 0.0) as f1, support from counted)
union all select 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support),
  sum(hit) / sum(support), cast(sum(support) as bigint) from counted
union all select 'macro avg', avg(coalesce(hit / nullif(predicted, 0), 0.0)),
  avg(coalesce(hit / nullif(support, 0), 0.0)),
  avg(coalesce(2 * hit / nullif(predicted + support, 0), 0.0)), cast(sum(support) as bigint)
from counted
union all select 'weighted avg',
  sum(coalesce(hit / nullif(predicted, 0), 0.0) * support) / sum(support),
  sum(coalesce(hit / nullif(support, 0), 0.0) * support) / sum(support),
  sum(coalesce(2 * hit / nullif(predicted + support, 0), 0.0) * support) / sum(support),
  cast(sum(support) as bigint) from counted""",
        "scored",
        guessed=f"select churn_label as label, {_FORECAST} as guess from scored",
        counted="""
select 'Ativo' as class, cast(count(*) filter (where label = 0 and guess = 0) as double) as hit,
  count(*) filter (where guess = 0) as predicted, count(*) filter (where label = 0) as support
from guessed
union all select 'Churn', cast(count(*) filter (where label = 1 and guess = 1) as double),
  count(*) filter (where guess = 1), count(*) filter (where label = 1) from guessed""",
    ),
)
def classification_report(spark, sf_dir):
    df = _forecast(spark, sf_dir)
    return evaluation.classification_report(df, "churn_label", "guess", churn.CLASS_NAMES)


def _forecast(spark, sf_dir) -> DataFrame:
    """A guess from recent orders alone, in the place of a model's prediction."""
    labelled = cust.with_churn_label(_base(spark, sf_dir))
    guess = (F.col("orders_per_month_6m") <= 1.0).cast("int")
    return labelled.withColumn("guess", guess)


@register(
    "roc_auc",
    with_ctes(
        """
select cast(sum(pos) as bigint) as positives, cast(sum(neg) as bigint) as negatives,
  cast(sum(pos * (2 * before + neg)) as double)
    / cast(2 * cast(sum(pos) as hugeint) * cast(sum(neg) as hugeint) as double) as roc_auc
from (
  select pos, neg, cast(coalesce(sum(neg) over (order by orders
    rows between unbounded preceding and 1 preceding), 0) as hugeint) as before
  from (
    select orders, count(*) filter (where churn_label = 1) as pos,
      count(*) filter (where churn_label = 0) as neg
    from scored group by orders) counted) placed""",
        "scored",
    ),
)
def roc_auc(spark, sf_dir):
    labelled = cust.with_churn_label(_base(spark, sf_dir))
    scored = written(labelled.select("churn_label", "orders"), "scored")
    return evaluation.roc_auc(scored, "churn_label", "orders")


def _trained(spark, sf_dir, leak_free: bool):
    inputs = churn.training_columns(leak_free)
    marked = written(
        churn.training_set(written(_features(spark, sf_dir), "features"), inputs), "training-set"
    )
    return marked, inputs, churn.train(marked, inputs)


@register("churn_model_scores")
def churn_model_scores(spark, sf_dir):
    marked, _, model = _trained(spark, sf_dir, leak_free=True)
    return churn.score(model, marked.filter(~F.col("is_train")))


@register("feature_importances")
def feature_importances(spark, sf_dir):
    """Of the full input set, in which days since purchase gives the label away."""
    marked, inputs, model = _trained(spark, sf_dir, leak_free=False)
    return churn.feature_importances(model, marked, inputs)
