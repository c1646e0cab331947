"""Every query with SQL gives what DuckDB gives on the same tables, with a plan that can grow."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL, plan
from tests.oracle_check import difference, duck


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, connection, name):
    df = entry.queries()[name](spark, SMALL)
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "InPandas" not in text
    assert difference(df, connection, entry.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
