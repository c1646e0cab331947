"""The batch run from raw files to marts and features."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.naming import LIBRARY_TO_STORED, from_stored, to_stored
from marlstone.operators import staging
from marlstone.operators.enrich import enrich
from marlstone.operators.marts import sales_mart
from marlstone.operators.observed import Watch, watch_checks, watch_rejects
from marlstone.operators.pii import mask_as_null
from marlstone.operators.quality import enforce, evaluate, gate_report, run_suite
from marlstone.operators.validity import rejected_sales, sale_rules, valid_sales
from marlstone.plans import suites
from marlstone.plans.features import customer_features
from marlstone.sources.quarantine import Ingested, ingest_csv
from marlstone.sources.scratch import written
from marlstone.sources.writers import dated_path, register_parquet_table, write_document, write_parquet

_MONTH = ("ano", "mes")
# Stored table name -> (library name, staging rules, stored partition columns).
_TABLES = {
    "vendas": ("sales", staging.SALES, _MONTH),
    "clientes": ("customers", staging.CUSTOMERS, ()),
    "produtos": ("products", staging.PRODUCTS, ()),
    "regioes": ("regions", staging.REGIONS, ()),
}


@dataclass(frozen=True)
class Lake:
    """Folders of the layers and of the reports."""

    raw: str
    bronze: str
    silver: str
    gold: str
    reports: str


def ingest(spark: SparkSession, lake: Lake, schemas: dict | None = None) -> dict[str, Ingested]:
    """Raw CSV folders to bronze, replacing it; the lines read, stored and set aside by table.

    `schemas` maps a stored table name to its CSV schema; without one all columns are text and
    staging types them. Lines that do not fit are kept in `_quarentena` by table.
    """
    return {
        stored: ingest_csv(
            spark,
            f"{lake.raw}/{stored}",
            f"{lake.bronze}/{stored}",
            f"{lake.bronze}/_quarentena/{stored}",
            partitions,
            schema=(schemas or {}).get(stored),
            whole=True,
        )
        for stored, (_, _, partitions) in _TABLES.items()
    }


def bronze_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    return {
        name: from_stored(spark.read.parquet(f"{lake.bronze}/{stored}"))
        for stored, (name, _, _) in _TABLES.items()
    }


def staged_tables(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: staging.stage(bronze[name], rules) for name, rules, _ in _TABLES.values()}


def rejects(bronze: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Sales that silver leaves out, as JSON of the raw row, and the rules they break.

    A sale whose key is no key breaks the rule of the key only. `watch` counts all sales on the way.
    """
    sales = staging.staged_beside_raw(bronze, staging.SALES)
    named = {
        name: condition if name == staging.SALES.key else condition | ~F.col("has_key")
        for name, condition in (sale_rules() | {staging.SALES.key: F.col("has_key")}).items()
    }
    if watch:
        sales = watch.on(sales)
    record = F.to_json("raw").alias("record")
    return rejected_sales(sales, named).select(record, "broken_rules")


def build_silver(
    spark: SparkSession,
    lake: Lake,
    processed_at: datetime,
    counted: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Valid sales, enriched, and next to them the rejected ones and the customers for marketing.

    `counted`, if given, receives what was counted while writing: `rejects`, the reject counts of
    bronze sales, and `enriched_sales`, the row checks of the silver suite.
    """
    bronze = bronze_tables(spark, lake)
    watch = watch_rejects()
    write_parquet(rejects(bronze["sales"], watch), f"{lake.silver}/vendas_rejeitadas")
    staged = staged_tables(bronze)
    enriched = enrich(
        valid_sales(staged["sales"]),
        staged["customers"],
        staged["products"],
        staged["regions"],
        processed_at=processed_at,
    )
    checks = tuple(
        check._replace(column=LIBRARY_TO_STORED.get(check.column, check.column))
        for check in suites.SILVER["enriched_sales"]
    )
    stored = to_stored(enriched)
    checked = watch_checks(stored, checks)
    write_marketing(staged["customers"], f"{lake.silver}/clientes_marketing")
    target = f"{lake.silver}/vendas"
    write_parquet(stored, target, _MONTH, whole=True, observed=(checked.seen, checked.counts))
    if counted is not None:
        counted |= {"rejects": watch.row(spark), "enriched_sales": checked.row(spark)}
    return silver_sales(spark, lake)


def silver_sales(spark: SparkSession, lake: Lake) -> DataFrame:
    return from_stored(spark.read.parquet(f"{lake.silver}/vendas"))


def gate(
    spark: SparkSession,
    lake: Lake,
    executed_at: datetime,
    counted: dict[str, DataFrame] | None = None,
) -> None:
    """Check bronze and silver, publish the report, then raise if a check failed.

    With the row checks counted while silver was written, only its keys are read again.
    """
    results = run_suite(bronze_tables(spark, lake), suites.BRONZE, "bronze").unionByName(
        run_suite({"enriched_sales": silver_sales(spark, lake)}, suites.SILVER, "silver", counted)
    )
    evaluated = written(evaluate(results), "gate")
    path = dated_path(f"{lake.reports}/quality-reports", executed_at, "quality_gate_report.json")
    write_document(gate_report(evaluated, executed_at, ["bronze", "silver"]), path)
    enforce(evaluated)


def build_gold(
    spark: SparkSession, lake: Lake, generated_at: datetime, year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """The sales mart, all of it, or one year or month while other months on disk stay."""
    mart = sales_mart(
        silver_sales(spark, lake), year=year, month=month, generated_at=generated_at
    )
    target = f"{lake.gold}/relatorio_vendas"
    write_parquet(to_stored(mart), target, _MONTH, whole=year is None)
    return from_stored(spark.read.parquet(target))


def build_features(
    spark: SparkSession, lake: Lake, as_of: date, extracted_at: datetime
) -> DataFrame:
    features = customer_features(silver_sales(spark, lake), as_of, extracted_at=extracted_at)
    target = f"{lake.gold}/features_clientes"
    write_parquet(to_stored(features), target)
    return from_stored(spark.read.parquet(target))


def write_marketing(customers: DataFrame, target: str) -> None:
    """Customers for marketing: the tax number is NULL, every other column stays."""
    write_parquet(to_stored(mask_as_null(customers, ["cpf"])), target)


# The masked column keeps the length it has in the catalog of the source.
_MARKETING_TYPES = {"cpf": "VARCHAR(14)"}


def register(spark: SparkSession, lake: Lake, prefix: str) -> list[str]:
    """Register what a run wrote as tables of `<prefix>_bronze`, `_silver` and `_gold`; their names.

    Run again, it picks up new months and moved folders.
    """
    layers = {
        "bronze": (lake.bronze, tuple(_TABLES)),
        "silver": (lake.silver, ("vendas", "vendas_rejeitadas", "clientes_marketing")),
        "gold": (lake.gold, ("relatorio_vendas", "features_clientes")),
    }
    names = []
    for layer, (root, tables) in layers.items():
        database = f"{prefix}_{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for table in tables:
            types = _MARKETING_TYPES if table == "clientes_marketing" else None
            register_parquet_table(spark, f"{database}.{table}", f"{root}/{table}", types)
            names.append(f"{database}.{table}")
    return names


def run(
    spark: SparkSession,
    lake: Lake,
    as_of: date,
    now: datetime,
    schemas: dict | None = None,
    *,
    register_as: str | None = None,
) -> dict[str, DataFrame]:
    """Ingest, silver, gate, gold, features, in this order; a failed gate ends the run.

    With `register_as` the tables of all layers are registered at the end, in databases of that prefix.
    """
    ingest(spark, lake, schemas)
    counted: dict[str, DataFrame] = {}
    silver = build_silver(spark, lake, now, counted)
    gate(spark, lake, now, counted)
    out = {
        "silver": silver,
        "mart": build_gold(spark, lake, now),
        "features": build_features(spark, lake, as_of, now),
    }
    if register_as:
        register(spark, lake, register_as)
    return out
