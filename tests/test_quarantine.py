"""Lines and messages that do not fit are kept, counted and told apart."""

import json

import pytest

from marlstone.operators import quality as q
from marlstone.operators import validity
from marlstone.operators.observed import watch_checks, watch_rejects
from marlstone.sources import quarantine, readers, writers
from marlstone.sources.scratch import scratch_path
from marlstone.streaming import clicks
from tests.conftest import plan, rows

LINES = ["n,t", "1,one", "2,two,more", "3", "x,four", ",five", '6,"a,b"']


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("n,t\n7,ção\n", encoding="utf-8")
    return str(tmp_path)


def ingested(spark, folder, schema=None):
    target, aside = scratch_path(spark, "good"), scratch_path(spark, "bad")
    counts = quarantine.ingest_csv(spark, folder, target, aside, schema=schema, ingested_at=None)
    good = spark.read.parquet(target).drop("ingestion_ts")
    return counts, rows(good), spark.read.parquet(aside)


def test_text_columns_set_aside_lines_of_another_width(spark, folder):
    counts, good, bad = ingested(spark, folder)
    assert good == rows(spark.createDataFrame([("1", "one"), ("x", "four"), (None, "five"), ("6", "a,b"), ("7", "ção")], "n string, t string"))
    assert {r.record for r in bad.collect()} == {"2,two,more", "3"}
    assert all(r.file.endswith("a.csv") for r in bad.collect())
    assert counts == (7, 5, 2)


def test_typed_columns_set_aside_values_of_another_type_too(spark, folder):
    counts, good, bad = ingested(spark, folder, "n int, t string")
    assert {r[0] for r in good} == {1, None, 6, 7}
    assert {r.record for r in bad.collect()} == {"2,two,more", "3", "x,four"}
    assert json.loads(bad.filter("record = '3'").first().fields) == {"n": 3}
    assert counts == (7, 4, 3)


def test_a_clean_run_replaces_what_was_set_aside(spark, folder, tmp_path):
    target, aside = scratch_path(spark, "good"), scratch_path(spark, "bad")
    assert quarantine.ingest_csv(spark, folder, target, aside).bad == 2
    (tmp_path / "a.csv").write_text("n,t\n1,one\n", encoding="utf-8")
    assert quarantine.ingest_csv(spark, folder, target, aside) == (2, 2, 0)
    assert spark.read.parquet(aside).count() == 0


def test_a_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n", encoding="utf-8")
    counts, good, bad = ingested(spark, str(tmp_path))
    assert counts == (0, 0, 0) and good == [] and bad.count() == 0
    assert readers.header_schema(spark, str(tmp_path)).names == ["n", "t"]


SALES = "sale_id bigint, customer_id bigint, quantity int, total_value decimal(18,2), status string"


def test_counts_taken_while_writing_are_those_of_a_scan(spark):
    sales = spark.createDataFrame(
        [(i or None, i % 5 or None, i % 3, None, "Concluída" if i % 2 else "?") for i in range(40)], SALES
    )
    watch = watch_rejects()
    writers.write_parquet(validity.rejected_sales(watch.on(sales)), scratch_path(spark, "rejects"))
    assert rows(watch.row(spark)) == rows(validity.reject_counts(sales))
    checks = (q.not_null("sale_id"), q.unique("sale_id"), q.positive("quantity"), q.accepted_values("status", ["?"]))
    target = scratch_path(spark, "checked")
    watch = watch_checks(sales, checks)
    writers.write_parquet(sales, target, ("quantity",), observed=(watch.seen, watch.counts))
    stored = spark.read.parquet(target)
    saved = q.run_checks(stored, checks, "l", "t", watch.row(spark))
    # Only the key is read: one scan less than without the counts.
    assert plan(saved).count("FileScan") == 1
    assert plan(q.run_checks(stored, checks, "l", "t")).count("FileScan") == 2
    assert rows(saved) == rows(q.run_checks(sales, checks, "l", "t"))


def test_text_that_is_no_number_is_left_to_staging(spark):
    df = spark.createDataFrame([("1",), ("-1",), ("n/a",), (None,)], "v string")
    found = q.run_checks(df, (q.non_negative("v"), q.positive("v")), "l", "t")
    assert [r.failed for r in found.orderBy("position").collect()] == [1, 1]


MESSAGES = [
    (b'{"user": 1, "page": "a"}', 0),
    (b'{"user": 2}', 1),
    (b'{"user": "x", "page": "a"}', 2),
    (b'{"user": 3', 3),
    (b"[1]", 4),
    (b"", 5),
    (None, 6),
    (b"\xff\xfe", 7),
    (b"  ", 8),
]


def messages(spark):
    return spark.createDataFrame([(v, "t", 0, o) for v, o in MESSAGES], "value binary, topic string, partition int, offset long")


def test_messages_that_do_not_parse_become_dead_letters(spark):
    parsed = clicks.parse_messages(messages(spark), "user int, page string")
    good, dead = clicks.parsed_clicks(parsed), clicks.dead_letters(parsed)
    assert rows(good) == [(1, "a"), (2, None)]
    assert {(r.offset, r.reason) for r in dead.collect()} == {
        (2, "unparsed"), (3, "unparsed"), (4, "unparsed"), (5, "unparsed"), (6, "empty"), (7, "unparsed"), (8, "unparsed"),
    }
    assert {r.offset: r.value and bytes(r.value) for r in dead.collect()} == {o: v for v, o in MESSAGES if o > 1}


def test_a_batch_of_messages_tried_again_is_stored_once(spark):
    target, dead = scratch_path(spark, "clicks"), scratch_path(spark, "dead")
    body = b'{"user": 1, "event_timestamp": "2024-05-01T10:00:00"}'
    rows_ = [(body, "t", 0, 0), (b"?", "t", 0, 1)]
    batch = spark.createDataFrame(rows_, "value binary, topic string, partition int, offset long")
    write = clicks.message_writer(target, dead, "user int, event_timestamp timestamp")
    for _ in range(2):
        write(batch, 3)
    assert spark.read.json(target).count() == 1
    assert [(r.offset, r.reason) for r in spark.read.parquet(dead).collect()] == [(1, "unparsed")]
