import json
from datetime import datetime

import pytest

from marlstone import rules
from marlstone.operators import quality as q
from marlstone.plans import suites
from tests.conftest import rows

DATA = [(1, "a", 5), (1, "b", -1), (None, None, 0), (None, "z", None), (2, "a", 3)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(DATA, "k int, s string, v int")


def failed(df, *checks):
    found = q.run_checks(df, checks, "bronze", "t")
    return [(r.check, r.total, r.failed) for r in found.orderBy("position").collect()]


def test_each_check(df):
    assert failed(
        df, q.not_null("k"), q.unique("k"), q.unique_values("k"), q.accepted_values("s", "ab"),
        q.non_negative("v"), q.positive("v"),
    ) == [
        ("not_null:k", 5, 2),
        ("unique:k", 5, 2),
        ("unique_values:k", 5, 1),
        ("accepted_values:s", 5, 1),
        ("non_negative:v", 5, 1),
        ("positive:v", 5, 2),
    ]


def test_an_empty_table_passes(spark):
    empty = spark.createDataFrame([], "k int, s string, v int")
    results = q.run_checks(empty, [q.not_null("k"), q.unique("k"), q.positive("v")], "l", "t")
    assert [(r.total, r.failed, r.rate) for r in results.collect()] == [(0, 0, 0.0)] * 3
    assert all(r.passed for r in q.evaluate(results).collect())


def test_row_checks_share_one_scan(df):
    checks = [q.not_null("k"), q.positive("v"), q.non_negative("v"), q.accepted_values("s", "a")]
    plan = q.run_checks(df, checks, "l", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_a_rate_at_the_limit_passes(spark):
    data = [(None if i < 5 else 1,) for i in range(100)]
    df = spark.createDataFrame(data, "k int")
    at_limit = q.evaluate(q.run_checks(df, [q.not_null("k", rules.COMPLETENESS)], "l", "t"))
    row = at_limit.first()
    assert row.rate == 0.05 and row.passed and row.message is None
    strict = q.evaluate(q.run_checks(df, [q.not_null("k")], "l", "t")).first()
    assert strict.message == "[INTEGRIDADE] not_null:k: taxa=5.00% (limiar=0%, falhas=5/100)"


def test_report_and_gate(spark, df):
    results = q.run_suite({"t": df}, {"t": [q.not_null("k"), q.positive("v")]}, "bronze")
    evaluated = q.evaluate(results)
    report = json.loads(
        q.gate_report(evaluated, datetime(2024, 1, 2), ["bronze", "silver"]).first().json
    )
    assert report["passed"] is False
    assert [m.split("]")[0] for m in report["failures"]] == ["[INTEGRIDADE", "[NEGÓCIO"]
    assert report["details"]["bronze"]["integrity"] == [
        {"check": "not_null:k", "total": 5, "failed": 2, "rate": 0.4}
    ]
    assert report["details"]["silver"]["business"] == []
    assert report["thresholds"] == {"integrity": 0.0, "completeness": 0.05, "business": 0.0}
    with pytest.raises(q.QualityGateError, match="not_null:k"):
        q.enforce(evaluated)
    q.enforce(evaluated.filter("passed"))


def test_suites_have_the_agreed_number_of_checks():
    def count(suite):
        checks = [c for table in suite.values() for c in table]
        return [sum(c.category == k for c in checks) for k in rules.THRESHOLDS]

    assert count(suites.BRONZE) == [15, 11, 2]
    assert count(suites.SILVER) == [9, 3, 2]
    contracts = [c for suite in suites.CONTRACTS.values() for t in suite.values() for c in t]
    kinds = [c.kind for c in contracts]
    assert [kinds.count(k) for k in ("not_null", "unique_values", "accepted_values")] == [76, 10, 4]


def test_boolean_domain(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert failed(df, q.accepted_values("f", (True, False))) == [("accepted_values:f", 3, 0)]


def test_assert_empty(df):
    from pyspark.sql import functions as F

    assert rows(q.assert_empty(df, F.col("v") < 0, "k", "v")) == [(1, -1)]
