"""Inputs that the test tables lack: late rows, missing labels, keys of the wrong type, unknown names."""

from datetime import date

from marlstone.operators import customers, evaluation, quality, staging
from marlstone.sources import writers


def test_sales_after_the_as_of_day_are_unknown(spark):
    sales = spark.createDataFrame(
        [(1, 1, "concluida", date(2024, 3, 1), 2024, 3), (1, 2, "concluida", date(2024, 9, 1), 2024, 9)],
        "customer_id int, sale_id int, status string, sale_date date, year int, month int",
    ).replace("concluida", customers.rules.COMPLETED, "status")
    assert customers.recency(sales, date(2024, 3, 11)).first()["days_since_purchase"] == 10
    assert customers.orders_in_trailing_months(sales, date(2024, 3, 11)).first()["orders_per_month_6m"] == 1


def test_a_key_that_does_not_fit_its_type_is_a_failure_and_no_row(spark):
    columns = (staging.StagedColumn("k", "int"), staging.StagedColumn("v", "int"))
    table = staging.StagedTable("k", columns)
    raw = spark.createDataFrame([("1", "2"), ("abc", "3")], "k string, v string")
    assert [tuple(r) for r in staging.stage(raw, table).collect()] == [(1, 2)]
    assert [r.failed_columns for r in staging.cast_failures(raw, table).collect()] == [["k"]]


def test_a_check_without_threshold_has_not_passed(spark):
    results = spark.createDataFrame(
        [("nowhere", "c", 1.0, 5, 5)], "category string, check string, rate double, failed long, total long"
    )
    assert quality.evaluate(results).first()["passed"] is False


def test_rows_without_a_label_are_split_too(spark):
    rows = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "id int, label int")
    assert evaluation.stratified_split(rows, "id", "label").count() == 4


def test_classes_without_a_name_count(spark):
    rows = spark.createDataFrame([(0, 0), (0, 0), (7, 7), (7, 0)], "label int, prediction int")
    report = {r["class"]: r for r in evaluation.classification_report(rows, "label", "prediction", {0: "zero"}).collect()}
    assert report["7"].support == 2
    assert report["zero"].support == 2


def test_a_table_moves_with_its_folder(spark, tmp_path):
    name = "moved_table"
    for n in (1, 2):
        spark.range(n).write.mode("overwrite").parquet(f"{tmp_path}/{n}")
        writers.register_parquet_table(spark, name, f"{tmp_path}/{n}")
        assert spark.table(name).count() == n
    spark.sql(f"DROP TABLE {name}")
