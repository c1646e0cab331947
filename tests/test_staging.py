from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from marlstone import rules
from marlstone.operators import staging, validity
from tests.conftest import rows

RAW = (
    "sale_id string, sale_date string, year string, month string, product_id string, "
    "customer_id string, region_id string, quantity string, unit_price string, discount string, "
    "total_value string, channel string, status string"
)


def raw(spark, *changes):
    good = {
        "sale_id": "1", "sale_date": "2024-01-17", "year": "2024", "month": "1",
        "product_id": "37", "customer_id": "100", "region_id": "1", "quantity": "7",
        "unit_price": "4302.29", "discount": "0.19", "total_value": "24393.98",
        "channel": "Online", "status": rules.COMPLETED,
    }
    data = [{**good, **change} for change in changes]
    return spark.createDataFrame([tuple(d.values()) for d in data], RAW)


def test_sales_are_typed_and_rows_without_id_dropped(spark):
    staged = staging.stage(raw(spark, {}, {"sale_id": None}), staging.SALES).collect()
    assert len(staged) == 1
    row = staged[0]
    assert (row.sale_id, row.sale_date, row.quantity) == (1, date(2024, 1, 17), 7)
    assert row.unit_price == Decimal("4302.29") and row.discount == Decimal("0.1900")


def test_a_value_that_does_not_fit_is_null_and_listed(spark):
    df = raw(spark, {"quantity": "seven", "sale_date": "soon"}, {"quantity": None}, {})
    staged = staging.stage(df, staging.SALES)
    assert staged.filter("quantity is null").count() == 2
    failures = staging.cast_failures(df, staging.SALES)
    assert [r.failed_columns for r in failures.collect()] == [["sale_date", "quantity"]]


def test_active_flag(spark):
    df = spark.createDataFrame([("S",), (" s ",), ("N",), ("",), (None,)], "v string")
    found = [r[0] for r in df.select(staging.is_yes(F.col("v"))).collect()]
    assert found == [True, True, False, False, False]


def test_customers_are_normalised(spark):
    df = spark.createDataFrame(
        [("5", "Ana", "ANA@X.COM", "1", "SMB", "sp", "2", "2020-02-30")],
        "customer_id string, customer_name string, email string, cpf string, segment string, "
        "state string, region_id string, registered_on string",
    )
    row = staging.stage(df, staging.CUSTOMERS).first()
    assert (row.email, row.state, row.registered_on) == ("ana@x.com", "SP", None)


SALE = "sale_id bigint, customer_id bigint, quantity int, total_value double, status string"


def sales(spark):
    return spark.createDataFrame(
        [
            (1, 1, 3, 100.0, rules.COMPLETED),
            (2, 1, 0, 100.0, rules.COMPLETED),
            (3, 1, 1, -50.0, rules.CANCELLED),
            (4, 1, 1, 0.0, rules.IN_PROGRESS),
            (5, 1, 1, 10.0, "Invalido"),
            (6, None, 1, 10.0, rules.COMPLETED),
            (None, 1, 1, 10.0, rules.COMPLETED),
            (8, 1, None, None, None),
        ],
        SALE,
    )


def test_valid_sales(spark):
    assert [r.sale_id for r in validity.valid_sales(sales(spark)).collect()] == [1, 4]
    model = validity.sale_rules(require_customer=False)
    assert [r.sale_id for r in validity.valid_sales(sales(spark), model).collect()] == [1, 4, 6]


def test_rejects_name_the_broken_rules_and_add_up(spark):
    rejected = {r.sale_id: r.broken_rules for r in validity.rejected_sales(sales(spark)).collect()}
    assert rejected[2] == ["quantity"] and rejected[5] == ["status"]
    assert rejected[8] == ["quantity", "total_value", "status"]
    counts = validity.reject_counts(sales(spark)).first()
    assert (counts.total, counts.approved, counts.rejected) == (8, 2, 6)
    assert counts.rejected_status == 2


def test_reject_counts_of_nothing(spark):
    counts = validity.reject_counts(spark.createDataFrame([], SALE)).first()
    assert (counts.total, counts.approved, counts.rejected) == (0, 0, 0)


def test_high_value_is_strict_and_unknown_is_not(spark):
    df = spark.createDataFrame([(1, 15000.0), (2, 10000.0), (3, None)], "i int, total_value double")
    assert rows(validity.with_high_value_flag(df).select("i", "is_high_value")) == [
        (1, True), (2, False), (3, False),
    ]
