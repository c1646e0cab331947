from datetime import date, datetime
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.functions.calendar import months_before
from marlstone.operators import customers as cust
from marlstone.plans import features, fixtures
from marlstone.plans import history as cells_of
from marlstone.sources.scratch import scratch_path
from tests.conftest import plan, rows

AS_OF = date(2024, 7, 15)
ENRICHED = (
    "sale_id bigint, sale_date date, year int, month int, category string, customer_id bigint, "
    "segment string, state string, channel string, status string, total_value decimal(18,2), "
    "is_high_value boolean"
)


def sale(i, customer, day, value="10.00", status=rules.COMPLETED, channel="Online",
         category="tools", segment="SMB", state="SP"):
    amount = Decimal(value)
    return (i, day, day.year, day.month, category, customer, segment, state, channel, status,
            amount, amount > 10000)


@pytest.fixture
def history(spark):
    return spark.createDataFrame(
        [
            sale(1, 1, date(2023, 12, 5), "100.00"),
            sale(2, 1, date(2024, 1, 9), "20000.00", category="toys"),
            sale(3, 1, date(2024, 1, 10), "50.00", channel="Televendas"),
            sale(4, 1, date(2024, 7, 1), "30.00", channel="Televendas", category=None),
            sale(5, 1, date(2024, 7, 9), status=rules.CANCELLED, segment="Varejo"),
            sale(6, 2, date(2024, 7, 14), "70.00", channel="Parceiros"),
            sale(7, 3, date(2024, 7, 14), status=rules.IN_PROGRESS),
            sale(8, 4, date(2022, 2, 1), "5.00"),
        ],
        ENRICHED,
    )


def test_cutoff_crosses_the_year():
    assert months_before(date(2024, 7, 1), 6) == (2024, 1)
    assert months_before(date(2024, 6, 30), 6) == (2023, 12)
    assert months_before(date(2024, 1, 31), 6) == (2023, 7)


def test_feature_values(spark, history):
    now = datetime(2024, 7, 15, 8)
    table = features.customer_features(history, AS_OF, extracted_at=now)
    assert tuple(table.columns) == features.FEATURES
    found = {r.customer_id: r for r in table.collect()}
    assert set(found) == {1, 2, 4}, "customers without a purchase have no features"
    one = found[1]
    assert one.orders == 4 and one.total_revenue == Decimal("20180.00")
    assert one.orders_per_month == pytest.approx(4 / 3, abs=1e-4)
    # January is the first of the seven calendar months; 2 sales there, 1 in July.
    assert one.orders_per_month_6m == 1.5
    assert one.category_count == 2 and one.high_value_orders == 1
    assert one.preferred_channel == "Online", "of two equal channels the first by name"
    assert one.cancel_rate == 0.2 and one.days_since_purchase == 14
    assert one.customer_segment == "Varejo", "the latest sale counts, whatever its status"
    assert (one.churn_label, found[4].churn_label) == (0, 1)
    assert found[4].orders_per_month_6m == 0.0
    # Ranks of three customers are 0, 50 and 100.
    assert found[4].rfm_score == 0.0
    assert found[2].rfm_score == pytest.approx(100 * 0.35 + 0 + 50 * 0.30)
    assert one.rfm_score == pytest.approx(50 * 0.35 + 100 * 0.35 + 100 * 0.30)


def test_tied_channels_can_be_kept(spark, history):
    table = features.customer_features(history, AS_OF, all_tied_channels=True)
    assert [r.preferred_channel for r in table.orderBy("preferred_channel").filter(
        "customer_id = 1").collect()] == ["Online", "Televendas"]
    assert table.count() == 4


def test_one_pass_equals_the_single_blocks(spark, sf_dir):
    enriched = fixtures.enriched_sales(spark, sf_dir, ("customers", "products"))
    as_of = fixtures.AS_OF
    blocks = [
        cust.monetary(enriched), cust.latest_profile(enriched), cust.preferred_channel(enriched),
        cust.distinct_categories(enriched), cust.high_value_orders(enriched),
        cust.recency(enriched, as_of), cust.cancel_rate(enriched),
        cust.orders_in_trailing_months(enriched, as_of), cust.active_months(enriched),
    ]
    joined = reduce(lambda left, right: left.join(right, "customer_id", "left"), blocks)
    expected = joined.fillna(0.0, ["orders_per_month_6m"])
    base = features.customer_base(enriched, as_of)
    shared = [c for c in base.columns if c in expected.columns]
    assert len(shared) == 14
    assert rows(base.select(*shared)) == rows(expected.select(*shared))
    months = expected.select("customer_id", F.round(F.col("orders") / F.col("active_months"), 4))
    assert rows(base.select("customer_id", "orders_per_month")) == rows(months)
    assert base.count() == base.select("customer_id").distinct().count()


def test_no_sales_no_features(spark):
    assert features.customer_features(spark.createDataFrame([], ENRICHED), AS_OF).count() == 0


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9)], "k int, feature_extraction_ts int")
    assert [r.k for r in features.latest_snapshot(df).orderBy("k").collect()] == [2, 3]


def test_stored_cells_fold_to_the_history_of_any_day(spark, history):
    undated = sale(9, 2, date(2024, 7, 14), "1.00")
    undated = spark.createDataFrame([(undated[0], None, None, None, *undated[4:])], ENRICHED)
    sales = history.unionByName(undated)
    path = scratch_path(spark, "cells")
    cells_of.write_cells(sales, path)
    for day in (date(2022, 1, 1), date(2023, 12, 31), date(2024, 1, 9), date(2024, 1, 31), date(2024, 7, 14), date(2024, 7, 31)):
        folded = cells_of.fold(cells_of.cells_as_of(spark, path, sales, day), day)
        assert rows(folded) == rows(cells_of.customer_base(sales, day)), day


def test_a_new_month_adds_cells_and_leaves_the_others(spark, history):
    path = scratch_path(spark, "cells")
    early = history.filter("sale_date < '2024-07-01'")
    cells_of.write_cells(early, path)
    before = set(spark.read.parquet(path).inputFiles())
    cells_of.write_cells(history.filter("sale_date >= '2024-07-01'"), path)
    stored = spark.read.parquet(path)
    assert before < set(stored.inputFiles())
    assert rows(cells_of.fold(stored, AS_OF)) == rows(cells_of.customer_base(history, AS_OF))
    # A month stored again takes the place of what was there.
    cells_of.write_cells(history.filter("sale_date >= '2024-07-01'"), path)
    assert rows(cells_of.fold(spark.read.parquet(path), AS_OF)) == rows(cells_of.customer_base(history, AS_OF))


def test_folding_reads_earlier_months_only_and_expands_no_sales(spark, history):
    path = scratch_path(spark, "cells")
    cells_of.write_cells(history, path)
    text = plan(cells_of.fold(cells_of.cells_as_of(spark, path, history, date(2024, 1, 31)), date(2024, 1, 31)))
    assert "PartitionFilters: [isnotnull(sold_in" in text and "ExistingRDD" not in text
    assert text.count("Exchange hashpartitioning(customer_id") == 1
    assert "Expand" not in plan(cells_of.customer_base(history, AS_OF))


def test_the_order_of_sales_and_of_merging_does_not_matter(spark, history):
    whole = rows(cells_of.fold(cells_of.cells(history), AS_OF))
    halves = cells_of.cells(history.filter("sale_id % 2 = 0")).unionByName(cells_of.cells(history.filter("sale_id % 2 = 1")))
    assert rows(cells_of.fold(halves, AS_OF)) == whole


def test_tasks_of_the_fold_grow_with_the_stored_bytes(spark, history, monkeypatch):
    path = scratch_path(spark, "sales of a day")
    history.repartition(3).write.parquet(path)
    sales = spark.read.parquet(path)
    whole = rows(cells_of.customer_base(history, AS_OF))
    assert rows(cells_of.customer_base(sales, AS_OF)) == whole
    assert "REPARTITION_BY_NUM" in plan(cells_of.customer_base(sales, AS_OF))
    monkeypatch.setattr(cells_of, "TASK_BYTES", 100)
    assert cells_of._spread(sales, "customer_id").rdd.getNumPartitions() > 4
    assert rows(cells_of.customer_base(sales, AS_OF)) == whole
