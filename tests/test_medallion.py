"""The batch run on stored column names, from CSV to features, and what users query after it."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

from marlstone.naming import from_stored, to_stored
from marlstone.operators.quality import QualityGateError
from marlstone.plans import medallion
from marlstone.plans.medallion import Lake
from marlstone.sources import readers, writers
from marlstone.sources.scratch import scratch_path, shared_folder
from tests.conftest import rows

NOW = datetime(2024, 7, 1, 6)
AS_OF = date(2024, 7, 1)

SALES_HEAD = (
    "id_venda,data_venda,ano,mes,id_produto,id_cliente,id_regiao,quantidade,valor_unitario,"
    "desconto,valor_total,canal_venda,status_venda"
)
SALES = [
    "1,2024-01-17,2024,1,1,100,1,7,4302.29,0.19,24393.98,Online,Concluída",
    "2,2024-01-20,2024,1,2,100,1,1,50.00,0,50.00,Televendas,Concluída",
    "3,2024-06-02,2024,6,2,101,2,2,50.00,0,100.00,Online,Cancelada",
    "4,2024-06-03,2024,6,1,101,2,1,10.00,0.5,5.00,Online,Concluída",
]
CUSTOMERS = [
    "id_cliente,nome_cliente,email,cpf,segmento,estado,id_regiao,data_cadastro",
    "100,Maria Silva,Maria@X.com,123.456.789-09,SMB,sp,1,2020-01-01",
    "101,João Souza,joao@x.com,987.654.321-00,Varejo,rj,2,2021-01-01",
]
PRODUCTS = [
    "id_produto,nome_produto,categoria,preco_unitario,fornecedor,ativo",
    "1,Notebook,Eletrônicos,4302.29,ACME,S",
    "2,Caneca,Casa,50.00,ACME,N",
]
REGIONS = ["id_regiao,nome_regiao", "1,Sudeste", "2,Sul"]


def lake(spark, tmp_path, sales):
    for name, lines in (
        ("vendas", [SALES_HEAD, *sales]), ("clientes", CUSTOMERS), ("produtos", PRODUCTS),
        ("regioes", REGIONS),
    ):
        folder = tmp_path / "raw" / name
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text("\n".join(lines), encoding="utf-8")
    root = scratch_path(spark, "lake")
    return Lake(str(tmp_path / "raw"), *[f"{root}/{n}" for n in ("bronze", "silver", "gold", "rep")])


def test_the_whole_run(spark, tmp_path):
    layers = lake(spark, tmp_path, SALES)
    out = medallion.run(spark, layers, AS_OF, NOW, register_as="whole_run")
    assert out["silver"].count() == 4
    assert spark.table("whole_run_silver.vendas").count() == 4
    assert spark.table("whole_run_gold.relatorio_vendas").filter("ano = 2024 AND mes = 6").count() == 1
    marketing = spark.table("whole_run_silver.clientes_marketing")
    assert [(r.email, r.cpf) for r in marketing.orderBy("id_cliente").collect()] == [
        ("maria@x.com", None), ("joao@x.com", None)
    ]
    described = spark.sql("DESCRIBE whole_run_silver.clientes_marketing").filter("col_name = 'cpf'")
    assert described.first().data_type == "varchar(14)"
    for name in medallion.register(spark, layers, "whole_run"):
        spark.sql(f"DROP TABLE {name}")
    mart = {(r.category, r.year, r.month): r for r in out["mart"].collect()}
    assert set(mart) == {("Eletrônicos", 2024, 1), ("Casa", 2024, 1), ("Eletrônicos", 2024, 6)}
    features = {r.customer_id: r for r in out["features"].collect()}
    assert features[100].high_value_orders == 1 and features[100].churn_label == 1
    assert features[101].cancel_rate == 0.5 and features[101].churn_label == 0
    report = spark.read.text(f"{layers.reports}/quality-reports/2024/07/01/quality_gate_report.json").first()
    assert json.loads(report.value)["passed"] is True

    # Saved queries on the stored names run as they are.
    to_stored(out["mart"]).createOrReplaceTempView("relatorio_vendas")
    found = spark.sql(
        "select categoria, sum(receita_bruta) as total from relatorio_vendas "
        "group by categoria order by total desc"
    ).collect()
    assert [tuple(r) for r in found] == [
        ("Eletrônicos", Decimal("24398.98")), ("Casa", Decimal("50.00")),
    ]


def test_a_failed_gate_publishes_its_report_and_stops_the_run(spark, tmp_path):
    bad = [*SALES, "5,2024-06-03,2024,6,1,101,2,-1,10.00,0,-5.00,Online,Concluída"]
    layers = lake(spark, tmp_path, bad)
    with pytest.raises(QualityGateError, match="non_negative:total_value"):
        medallion.run(spark, layers, AS_OF, NOW)
    report = spark.read.text(f"{layers.reports}/quality-reports/2024/07/01/quality_gate_report.json").first()
    assert json.loads(report.value)["passed"] is False
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{layers.gold}/relatorio_vendas")
    assert medallion.silver_sales(spark, layers).count() == 4, "the bad sale stays out of silver"


def test_building_one_month_leaves_the_others(spark, tmp_path):
    layers = lake(spark, tmp_path, SALES)
    medallion.ingest(spark, layers)
    medallion.build_silver(spark, layers, NOW)
    medallion.build_gold(spark, layers, NOW)
    mart = medallion.build_gold(spark, layers, NOW, year=2024, month=6)
    assert {r.month for r in mart.collect()} == {1, 6}


def test_names_map_both_ways(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id_venda int, receita_bruta int, other int")
    assert from_stored(df).columns == ["sale_id", "revenue", "other"]
    assert to_stored(from_stored(df)).columns == df.columns


def test_partition_overwrite_and_year_scan(spark):
    df = spark.createDataFrame([(1, 2023, 1), (2, 2024, 1), (3, 2024, 2)], "k int, year int, month int")
    path = scratch_path(spark, "parts")
    writers.write_parquet(df, path, ("year", "month"))
    writers.write_parquet(df.filter("year = 2024 and month = 2").selectExpr("k + 10 as k", "year", "month"), path, ("year", "month"))
    assert {r.k for r in spark.read.parquet(path).collect()} == {1, 2, 13}
    scan = readers.scan_year(spark, path, 2024)
    assert {(r.k, r.year) for r in scan.collect()} == {(2, 2024), (13, 2024)}
    assert len(scan.inputFiles()) == 3 and "PartitionFilters: [isnotnull(year" in plan(scan)
    assert {r.k for r in readers.scan_year(spark, path, 2024, 2).collect()} == {13}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_registered_table_has_its_partitions(spark):
    path = scratch_path(spark, "table")
    spark.range(6).selectExpr("id", "id % 2 as part").write.partitionBy("part").parquet(path)
    writers.register_parquet_table(spark, "parts_table", path)
    assert readers.read_table(spark, "parts_table").count() == 6
    spark.range(3).selectExpr("id", "7 as part").write.mode("append").partitionBy("part").parquet(path)
    writers.register_parquet_table(spark, "parts_table", path)
    assert readers.read_table(spark, "parts_table").count() == 9


def test_csv_types_are_inferred_only_when_asked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n1,ção\n", encoding="utf-8")
    assert readers.read_csv(spark, str(tmp_path)).dtypes == [("n", "string"), ("t", "string")]
    assert readers.read_csv(spark, str(tmp_path), infer=True).dtypes == [("n", "int"), ("t", "string")]
    typed = readers.read_csv(spark, str(tmp_path), "n string, t string")
    assert typed.first().t == "ção" and typed.dtypes[0] == ("n", "string")
    stamped = readers.with_ingestion_time(typed, NOW)
    assert stamped.first().ingestion_ts == NOW


def test_gathering_leaves_few_files(spark):
    df = spark.range(1000).selectExpr("id", "id % 2 as part").repartition(8)
    gathered, scattered = scratch_path(spark, "files"), scratch_path(spark, "files")
    writers.write_parquet(df, gathered, ("part",))
    writers.write_parquet(df, scattered, ("part",), gather=False)
    assert len(spark.read.parquet(gathered).inputFiles()) == 2
    assert len(spark.read.parquet(scattered).inputFiles()) == 16
    assert rows(spark.read.parquet(gathered)) == rows(spark.read.parquet(scattered))


def test_schema_changes_are_named(spark):
    table = spark.createDataFrame([], "a int, b string, c date")
    files = spark.createDataFrame([], "a bigint, c date, d string")
    assert writers.schema_changes(table, files) == [
        "column d string added", "column b removed", "column a int is now bigint",
    ]


def test_scratch_tables_go_to_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark) + "/x-")


def test_a_month_that_is_gone_goes_from_all_layers_and_rejects_are_kept(spark, tmp_path):
    layers = lake(spark, tmp_path, SALES)
    medallion.run(spark, layers, AS_OF, NOW)
    bad = [
        "5,2024-01-21,2024,1,1,100,1,0,10.00,0,10.00,Online,Concluída",
        "x6,2024-01-21,2024,1,1,100,1,1,10.00,0,10.00,Online,Concluída",
    ]
    raw = tmp_path / "raw" / "vendas" / "part.csv"
    raw.write_text("\n".join([SALES_HEAD, *SALES[:2], *bad]), encoding="utf-8")
    medallion.ingest(spark, layers)
    silver = medallion.build_silver(spark, layers, NOW)
    mart = medallion.build_gold(spark, layers, NOW)
    assert medallion.bronze_tables(spark, layers)["sales"].filter("month = 6").isEmpty()
    assert silver.count() == 2 and silver.filter("month = 6").isEmpty()
    assert mart.filter("month = 6").isEmpty()
    kept = spark.read.parquet(f"{layers.silver}/vendas_rejeitadas").collect()
    assert sorted(r.broken_rules for r in kept) == [["quantity"], ["sale_id"]]
