"""Registered queries on bucketed layers, and on properties of what a run publishes."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone import rules
from marlstone.functions.numbers import money_total
from marlstone.operators import quality, staging, validity
from marlstone.operators.pii import column_tags, tag_columns
from marlstone.plans import churn, fixtures
from marlstone.plans.fixtures import NOW
from marlstone.plans.oracle_ctes import with_ctes
from marlstone.plans.registered import (
    _BRONZE_SQL,
    _EVALUATED_SQL,
    _SCAN_SQL,
    _SILVER_SQL,
    _SPLIT,
    _bronze_results,
    _customer_findings,
    _features,
    _fresh,
    _silver_results,
    _trained,
    _union,
)
from marlstone.plans.registry import register
from marlstone.sources import buckets, readers, writers
from marlstone.sources.scratch import scratch_path, written

_BUCKETS = 16


@register(
    "customer_sales_bucketed",
    with_ctes(
        "select v.customer_id, c.segment, c.state, count(v.sale_id) as orders, "
        "cast(sum(v.total_value) as decimal(38,2)) as revenue, max(v.sale_date) as last_sale "
        "from valid v left join customers c on v.customer_id = c.customer_id "
        "group by v.customer_id, c.segment, c.state",
        "valid", "customers",
    ),
)
def customer_sales_bucketed(spark, sf_dir):
    """Valid sales per customer, from tables of the bronze layer that are bucketed by customer."""
    layer = f"{_fresh('run')}_bronze"
    root = scratch_path(spark, layer)
    sales = written(fixtures.dirty_sales(spark, sf_dir), "sales")
    facts = buckets.save_bucketed(sales, layer, "stg_sales", root, "customer_id", _BUCKETS)
    customers = fixtures.customers(spark, sf_dir)
    people = buckets.save_bucketed(customers, layer, "stg_customers", root, "customer_id", _BUCKETS, unique=True)
    sums = (
        F.count("sale_id").alias("orders"),
        money_total(F.col("total_value")).alias("revenue"),
        F.max("sale_date").alias("last_sale"),
    )
    return buckets.per_key(spark, facts, people, ("segment", "state"), sums, validity.all_met(validity.sale_rules()))


_TAGS = {
    "pii_type": "pii_type",
    "lgpd_classification": "lgpd_class",
    "pii_confidence": "confidence",
    "pii_detected_by": "'marlstone'",
    "pii_tagged_at": f"'{NOW}'",
    "PII": "pii_type",
    "LGPD_Classification": "lgpd_class",
}


@register(
    "pii_tags",
    with_ctes(
        " union all ".join(
            f"select \"column\", '{tag}' as tag, {value} as value from found where \"table\" = 'clientes'"
            for tag, value in _TAGS.items()
        ),
        "customers",
        found=_SCAN_SQL,
    ),
)
def pii_tags(spark, sf_dir):
    """(column, tag, value) of the customers, read back from the files they were written to."""
    df, found = _customer_findings(spark, sf_dir)
    path = scratch_path(spark, "tagged")
    writers.write_parquet(tag_columns(df, found, NOW), path)
    tags = column_tags(readers.read_parquet(spark, path))
    rows = [(column, tag, value) for column, own in tags.items() for tag, value in own.items()]
    return spark.createDataFrame(rows, "column string, tag string, value string")


@register(
    "csv_ingest_audited",
    with_ctes(
        "select product_id, product_name, list_price, "
        f"'{NOW:%Y-%m-%d %H:%M:%S}' as ingestion_ts from raw_products",
        "raw_products",
    ),
)
def csv_ingest_audited(spark, sf_dir):
    """Products from CSV with the audit timestamp of a run at a stated time."""
    source, target = scratch_path(spark, "raw-products"), scratch_path(spark, "bronze-products")
    fixtures.raw_products(spark, sf_dir).write.option("header", True).csv(source)
    writers.csv_to_parquet(spark, source, target, ingested_at=NOW)
    stored = F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss").alias("ingestion_ts")
    return readers.read_parquet(spark, target).select("product_id", "product_name", "list_price", stored)


@register(
    "quality_report_failures",
    with_ctes(
        "select (select bool_and(passed) from evaluated) as passed, message as failure "
        "from evaluated where not passed",
        "enriched",
        checks=f"{_BRONZE_SQL} union all {_SILVER_SQL}",
        evaluated=_EVALUATED_SQL,
    ),
)
def quality_report_failures(spark, sf_dir):
    """The verdict of the published gate report and the failures it lists, read back."""
    results = _bronze_results(spark, sf_dir).unionByName(_silver_results(spark, sf_dir))
    evaluated = written(quality.evaluate(results), "gate")
    path = writers.dated_path(scratch_path(spark, "reports"), NOW, "quality_gate_report.json")
    writers.write_document(quality.gate_report(evaluated, NOW, ["bronze", "silver"]), path)
    read = spark.read.schema("passed boolean, failures array<string>").json(path)
    return read.select("passed", F.explode("failures").alias("failure"))


@register(
    "masked_marketing",
    with_ctes(
        "select customer_id as id_cliente, customer_name as nome_cliente, email, "
        "cast(null as varchar) as cpf, segment as segmento, state as estado, region_id as id_regiao, "
        "registered_on as data_cadastro from customers",
        "customers",
    ),
)
def masked_marketing(spark, sf_dir):
    """The stored marketing table of a run, whose cpf is a NULL of its type."""
    from marlstone.plans import medallion

    path = scratch_path(spark, "marketing")
    medallion.write_marketing(staging.stage(fixtures.raw_customers(spark, sf_dir), staging.CUSTOMERS), path)
    return readers.read_parquet(spark, path)


_MATRIX = ", ".join(f"cast({c} as double) as {c}" for c in churn.training_columns())


@register(
    "churn_training_set",
    with_ctes(f"select customer_id, {_MATRIX}, {rules.CHURN_LABEL} from scored", "scored"),
)
def churn_training_set(spark, sf_dir):
    """Key, inputs and label of every customer, whichever side of the split."""
    marked = churn.training_set(written(_features(spark, sf_dir), "features"), churn.training_columns())
    return marked.drop("is_train")


_PROPERTIES = ("scored_once", "class_follows_probability", "probability_in_range")


@register(
    "churn_model_properties",
    with_ctes(
        " union all ".join(
            f"select '{name}' as property, churn_label, count(*) as rows, true as holds "
            "from split where not is_train group by churn_label"
            for name in _PROPERTIES
        )
        + f" union all select 'importances_share_one', null, {len(churn.training_columns())}, true",
        "scored",
        split=_SPLIT,
    ),
)
def churn_model_properties(spark, sf_dir):
    """What must hold for any model: every held-out customer is scored once, the class is that of the
    larger probability, importances are shares of one."""
    marked, inputs, model = _trained(spark, sf_dir, leak_free=True)
    scored = written(churn.score(model, marked.filter(~F.col("is_train"))), "scores")
    chance = F.col("churn_probability")
    holds = {
        "scored_once": F.count_distinct("customer_id") == F.count(F.lit(1)),
        "class_follows_probability": F.bool_and(F.col("predicted") == (chance > 0.5).cast("int")),
        "probability_in_range": F.bool_and(chance.between(0, 1)),
    }
    parts = [
        scored.groupBy(rules.CHURN_LABEL)
        .agg(F.count(F.lit(1)).alias("rows"), holds[name].alias("holds"))
        .select(F.lit(name).alias("property"), rules.CHURN_LABEL, "rows", "holds")
        for name in _PROPERTIES
    ]
    shares = churn.feature_importances(model, marked, inputs).agg(
        F.lit("importances_share_one").alias("property"),
        F.lit(None).cast("int").alias(rules.CHURN_LABEL),
        F.count(F.lit(1)).alias("rows"),
        ((F.min("importance") >= 0) & (F.abs(F.sum("importance") - 1) < 1e-9)).alias("holds"),
    )
    return _union([*parts, shares])
