import random
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from marlstone.operators import evaluation
from marlstone.operators.ordered import (
    _with_numbers_below,
    exact_quantiles,
    running_totals,
    value_counts,
)
from marlstone.operators.ranking import RankSpec, percent_ranks
from tests.conftest import rows

SPECS = (RankSpec("up", "v"), RankSpec("down", "v", ascending=False))


def built_in(df):
    up = F.percent_rank().over(Window.orderBy(F.asc("v")))
    down = F.percent_rank().over(Window.orderBy(F.desc("v")))
    return df.select("k", up.alias("up_rank"), down.alias("down_rank"))


def frame(spark, values):
    data = [(i, None if v is None else Decimal(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "k bigint, v decimal(18,2)")


@pytest.mark.parametrize(
    "values",
    [
        [],
        [5],
        [None],
        [3, 3, 3],
        [1, None, 2, None, 2],
        [7] * 400 + list(range(600)),
        random.Random(3).sample(range(100_000), 1500),
    ],
)
def test_percent_ranks_equal_the_built_in(spark, values):
    df = frame(spark, values)
    assert rows(percent_ranks(df, "k", SPECS)) == rows(built_in(df))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20)), min_size=1, max_size=60))
def test_percent_ranks_of_any_values(spark, values):
    df = frame(spark, values)
    found = percent_ranks(df, "k", SPECS)
    assert rows(found) == rows(built_in(df))


def test_running_totals_do_not_depend_on_the_number_of_ranges(spark):
    values = [random.Random(i).randrange(500) for i in range(2000)]
    counted = value_counts(frame(spark, values), "v")
    few, many = (running_totals(counted, "v", ranges=r) for r in (2, 300))
    assert rows(few) == rows(many)
    before = {r.v: r.n_before for r in few.collect()}
    assert all(before[Decimal(v)] == sum(x < v for x in values) for v in set(values))


@pytest.fixture(params=[1, 4, 400])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_results_do_not_depend_on_the_partitions_of_the_session(spark, partitions):
    values = [random.Random(i).randrange(300) for i in range(1500)] + [None] * 20 + [7] * 500
    df = frame(spark, values)
    assert rows(percent_ranks(df, "k", SPECS)) == rows(built_in(df))
    split = evaluation.stratified_split(df.withColumn("label", F.col("v") > 9), "k", "label")
    trained = {r.label: (r.train, r.n) for r in split.groupBy("label").agg(F.count_if("is_train").alias("train"), F.count("*").alias("n")).collect()}
    assert all(train == int(0.8 * n + 0.5) for train, n in trained.values()) and None in trained
    digest = split.agg(F.sum(F.xxhash64("k", "is_train").cast("decimal(38,0)"))).first()[0]
    assert digest == _DIGESTS.setdefault("split", digest)


_DIGESTS: dict = {}


@pytest.mark.parametrize("count", [1, 2, 3, 7, 8, 100])
def test_binary_search_finds_the_number_of_limits_below(spark, count):
    limits = [i * 2 for i in range(count)]
    df = spark.range(-3, 2 * count + 3).select("id", F.array(*[F.lit(x) for x in limits]).alias("limits"))
    for most in (count, count + 5):
        found = _with_numbers_below(df, "limits", "id", most)
        assert all(r._below == sum(x < r.id for x in limits) for r in found.collect())


def test_no_single_task_ranks_all_values(spark):
    plan = percent_ranks(frame(spark, range(100)), "k", SPECS)._jdf.queryExecution().toString()
    windows = [line for line in plan.splitlines() if "+- Window" in line or ":- Window" in line]
    assert windows and all(", [_of#" in line for line in windows)


def test_quantiles_equal_numpy(spark):
    values = [random.Random(i).gauss(0, 9) for i in range(777)] + [0.5] * 300
    df = spark.createDataFrame([(v, 1.0) for v in values] + [(None, 1.0)], "v double, one double")
    found = {
        (r.column, r.probability): r.quantile
        for r in exact_quantiles(df, ["v", "one"], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]).collect()
    }
    for p in (0.0, 0.1, 0.25, 0.5, 0.75, 1.0):
        assert found[("v", p)] == pytest.approx(np.quantile(values, p), abs=1e-12)
        assert found[("one", p)] == 1.0


def test_summary(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    row = evaluation.summary(df, ["v"]).first()
    assert (row["count"], row.min, row.q25, row.q50, row.q75, row.max) == (3, 1, 1.5, 2, 3, 4)
    assert row.std == pytest.approx(np.std([1, 2, 4], ddof=1))


def brute_auc(pairs):
    positive = [s for label, s in pairs if label]
    negative = [s for label, s in pairs if not label]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


def test_roc_auc_equals_counting_pairs(spark):
    pick = random.Random(5)
    pairs = [(int(pick.random() < 0.4), pick.randrange(12) / 12) for _ in range(300)]
    df = spark.createDataFrame(pairs, "label int, score double")
    row = evaluation.roc_auc(df, "label", "score").first()
    assert row.roc_auc == pytest.approx(brute_auc(pairs), abs=1e-12)
    one_class = df.filter("label = 1")
    assert evaluation.roc_auc(one_class, "label", "score").first().roc_auc is None


def test_split_is_exact_per_label_and_repeatable(spark):
    df = spark.range(1037).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    split = evaluation.stratified_split(df, "id", "label")
    counts = {(r.label, r.is_train): r["count"] for r in split.groupBy("label", "is_train").count().collect()}
    assert counts[(1, True)] == round(0.8 * 149) and counts[(0, True)] == round(0.8 * 888)
    again = evaluation.stratified_split(df.repartition(5), "id", "label")
    assert rows(split.select("id", "is_train")) == rows(again.select("id", "is_train"))


def test_classification_report(spark):
    data = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3
    df = spark.createDataFrame(data, "label int, guess int")
    report = evaluation.classification_report(df, "label", "guess", {0: "no", 1: "yes", 2: "never"})
    found = {r["class"]: r for r in report.collect()}
    assert found["no"].precision == 1.0 and found["no"].recall == pytest.approx(5 / 7)
    assert found["yes"].precision == 0.6 and found["yes"].f1 == pytest.approx(0.75)
    assert found["never"].f1 == 0.0 and found["never"].support == 0
    assert found["accuracy"].recall == 0.8 and found["macro avg"].support == 10
    assert found["weighted avg"].precision == pytest.approx((7 * 1.0 + 3 * 0.6) / 10)
