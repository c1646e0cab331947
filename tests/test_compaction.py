from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.sources.scratch import scratch_path
from marlstone.streaming import clicks, compaction
from tests.conftest import rows
from tests.test_streaming import FIRST, NOW, SCHEMA, SECOND, THIRD, arrive, run

STORED = T.StructType(
    [*SCHEMA.fields, T.StructField("processed_at", T.TimestampType()), *[T.StructField(p, T.IntegerType()) for p in clicks.PARTITIONS]]
)


def ids(spark, root):
    return sorted(r["id"] for r in compaction.read_compacted(spark, root, STORED).collect())


@pytest.fixture(params=["sink", "batches"])
def stream(request, spark):
    """(one more arrival, landing folder, checkpoint to give to compact)."""
    source, landing, progress = (scratch_path(spark, n) for n in ("in", "landing", "progress"))
    start = clicks.start_ingest if request.param == "sink" else clicks.start_batch_ingest

    def more(*events):
        arrive(spark, source, *events)
        run(spark, start, source, landing, progress)

    return more, landing, progress if request.param == "batches" else None


def test_rows_are_taken_once(spark, stream):
    more, landing, checkpoint = stream
    root = scratch_path(spark, "compacted")
    more(FIRST, SECOND)
    assert compaction.compact(spark, landing, root, STORED, checkpoint=checkpoint).hours == 2
    assert compaction.compact(spark, landing, root, STORED, checkpoint=checkpoint) == compaction.Compacted(0, 0)
    late = (4, datetime(2024, 1, 31, 23, 10))
    more(THIRD, late)
    assert compaction.compact(spark, landing, root, STORED, checkpoint=checkpoint).hours == 2
    read = compaction.read_compacted(spark, root, STORED)
    assert rows(read.select("id", "day", "hour")) == [(1, 31, 23), (2, 1, 0), (3, 1, 7), (4, 31, 23)]
    assert {r["processed_at"] for r in read.collect()} == {NOW}
    assert {r["files"] for r in compaction.files_per_hour(spark, root).collect()} == {1}


def test_a_run_that_fails_before_its_commit_is_not_seen(spark, stream, monkeypatch):
    more, landing, checkpoint = stream
    root = scratch_path(spark, "compacted")
    more(FIRST)
    compaction.compact(spark, landing, root, STORED, checkpoint=checkpoint)
    more(SECOND, (5, FIRST[1]))
    made = spark.createDataFrame

    def fails(data, schema=None):
        if schema == compaction._RUN and data:
            raise RuntimeError("lost before the commit")
        return made(data, schema)

    monkeypatch.setattr(spark, "createDataFrame", fails)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, landing, root, STORED, checkpoint=checkpoint)
    assert ids(spark, root) == [1]
    monkeypatch.undo()
    compaction.compact(spark, landing, root, STORED, checkpoint=checkpoint)
    assert ids(spark, root) == [1, 2, 5]


def test_batches_not_committed_are_left(spark):
    source, landing, progress, root = (scratch_path(spark, n) for n in ("in", "landing", "progress", "compacted"))
    arrive(spark, source, FIRST)
    run(spark, clicks.start_batch_ingest, source, landing, progress)
    query, last = compaction.last_committed_batch(spark, progress)
    batch = spark.createDataFrame([SECOND], SCHEMA)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", query)
    try:
        clicks.batch_writer(landing, processed_at=NOW)(batch, last + 1)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    compaction.compact(spark, landing, root, STORED, checkpoint=progress)
    assert ids(spark, root) == [1]


def test_a_busy_hour_is_split_by_bytes(spark):
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "compacted")
    at = F.lit("2024-01-01 05:00:00").cast("timestamp")
    busy = spark.range(4000).select("id", at.alias("event_timestamp"))
    clicks.batch_writer(landing, processed_at=NOW)(busy.repartition(16), 0)
    before = compaction.committed_files(spark, landing)
    total, target = before.agg(F.sum("bytes")).first()[0], 100_000
    compaction.compact(spark, landing, root, STORED, target_bytes=target)
    hour = compaction.files_per_hour(spark, root).first()
    assert 1 < hour["files"] <= total // target + 1
    assert ids(spark, root) == list(range(4000))


def test_events_without_a_time_stay(spark):
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "compacted")
    clicks.batch_writer(landing, processed_at=NOW)(spark.createDataFrame([FIRST, (9, None)], SCHEMA), 0)
    compaction.compact(spark, landing, root, STORED)
    assert ids(spark, root) == [1, 9]


def test_an_empty_target_has_no_rows(spark):
    assert ids(spark, scratch_path(spark, "compacted")) == []
