"""Bucketed layer tables: no shuffle between tables of one key, frequent keys and missing ones beside."""

import pytest
from pyspark.sql import functions as F

from marlstone.sources import buckets
from marlstone.sources.scratch import scratch_path
from tests.conftest import plan, rows


def sums():
    return F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")


def stored(spark, layer, facts, people, number=8):
    root = scratch_path(spark, layer)
    fact = buckets.save_bucketed(facts, layer, "facts", root, "customer_id", number)
    return fact, buckets.save_bucketed(people, layer, "people", root, "customer_id", number, unique=True)


@pytest.fixture(scope="module")
def tables(spark):
    """A third of the facts belong to customer 7, some to nobody, some to people who are not listed."""
    number = F.col("id")
    key = F.when(number % 3 == 0, 7).when(number % 100 != 1, number % 500).cast("bigint")
    facts = spark.range(30_000).select("id", key.alias("customer_id"), (number % 11).alias("value"))
    people = spark.range(450).select(number.alias("customer_id"), F.concat(F.lit("p"), number).alias("name"))
    people = people.union(spark.createDataFrame([(None, "nobody")], "customer_id bigint, name string"))
    yield facts, people, *stored(spark, "bucket_db", facts, people)
    spark.sql("DROP DATABASE bucket_db CASCADE")


def test_settled_rows_are_joined_and_summed_without_a_shuffle(spark, tables):
    _, _, facts, people = tables
    settled, beside = buckets.left_join(spark, facts, people, ("name",))
    summed = settled.groupBy("customer_id", "name").agg(*sums())
    summed.collect()
    text = plan(summed)
    assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text
    beside.collect()
    assert "SortMergeJoin" not in plan(beside)


def test_frequent_and_missing_keys_stay_beside(spark, tables):
    facts, people, fact, person = tables
    assert {r[0] for r in spark.table(fact.beside).select("customer_id").distinct().collect()} == {7, None}
    assert rows(fact.rows(spark)) == rows(facts)
    assert rows(person.rows(spark)) == rows(people)


def test_same_rows_as_a_plain_join(spark, tables):
    facts, people, fact, person = tables
    got = buckets.per_key(spark, fact, person, ("name",), sums())
    plain = facts.join(people, "customer_id", "left").groupBy("customer_id", "name").agg(*sums())
    assert rows(got) == rows(plain)
    some = F.col("value") > 4
    got = buckets.per_key(spark, fact, person, ("name",), sums(), some)
    plain = facts.filter(some).join(people, "customer_id", "left").groupBy("customer_id", "name").agg(*sums())
    assert rows(got) == rows(plain)


def test_one_file_per_bucket_and_empty_tables(spark, tables):
    _, _, fact, _ = tables
    files = spark.table(fact.settled).select(F.input_file_name()).distinct().count()
    assert files <= fact.buckets
    none = spark.createDataFrame([], "id bigint, customer_id bigint, value bigint")
    people = spark.createDataFrame([], "customer_id bigint, name string")
    empty, nobody = stored(spark, "bucket_none", none, people)
    assert rows(buckets.per_key(spark, empty, nobody, ("name",), sums())) == []
    spark.sql("DROP DATABASE bucket_none CASCADE")


def test_number_of_buckets_grows_with_the_bytes():
    assert [buckets.buckets_for(n << 20) for n in (0, 1, 256, 257, 1 << 20)] == [1, 1, 1, 2, 4096]
