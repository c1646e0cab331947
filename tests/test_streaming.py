from datetime import datetime

from pyspark.sql import types as T

from marlstone.sources.scratch import scratch_path
from marlstone.streaming import clicks
from tests.conftest import rows

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("event_timestamp", T.TimestampType())]
)
NOW = datetime(2024, 5, 1)


def arrive(spark, folder, *events):
    spark.createDataFrame(list(events), SCHEMA).coalesce(1).write.mode("append").json(folder)


def places(spark, target):
    df = spark.read.json(target)
    return rows(df.select("id", "year", "month", "day", "hour"))


FIRST = (1, datetime(2024, 1, 31, 23, 59))
SECOND = (2, datetime(2024, 2, 1, 0, 0))
THIRD = (3, datetime(2024, 2, 1, 7, 30))


def run(spark, start, folder, target, progress):
    source = clicks.file_clicks(spark, folder, SCHEMA, format="json")
    start(source, target, progress, interval=None, processed_at=NOW).awaitTermination()


def test_each_event_is_stored_once_by_event_time(spark):
    folder, target, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    arrive(spark, folder, FIRST, SECOND)
    for _ in range(2):
        run(spark, clicks.start_ingest, folder, target, progress)
    assert places(spark, target) == [(1, 2024, 1, 31, 23), (2, 2024, 2, 1, 0)]
    arrive(spark, folder, THIRD)
    run(spark, clicks.start_ingest, folder, target, progress)
    assert places(spark, target)[-1] == (3, 2024, 2, 1, 7)
    assert "processed_at" in spark.read.json(target).columns


def test_batches_have_their_own_folder(spark):
    folder, target, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    arrive(spark, folder, FIRST, SECOND)
    run(spark, clicks.start_batch_ingest, folder, target, progress)
    assert places(spark, target) == [(1, 2024, 1, 31, 23), (2, 2024, 2, 1, 0)]


def test_a_new_checkpoint_keeps_what_the_old_one_stored(spark):
    folder, target, old, new = (scratch_path(spark, n) for n in ("in", "out", "old", "new"))
    arrive(spark, folder, FIRST, SECOND)
    run(spark, clicks.start_batch_ingest, folder, target, old)
    later = scratch_path(spark, "later")
    arrive(spark, later, THIRD)
    run(spark, clicks.start_batch_ingest, later, target, new)
    assert [p[0] for p in places(spark, target)] == [1, 2, 3]
    assert spark.read.json(target).select("query").distinct().count() == 2


def test_a_batch_tried_again_replaces_itself_and_an_empty_one_writes_nothing(spark):
    target = scratch_path(spark, "out")
    write = clicks.batch_writer(target, processed_at=NOW)
    batch = spark.createDataFrame([FIRST, SECOND], SCHEMA)
    write(batch, 4)
    write(batch, 4)
    write(batch.filter("id = 0"), 5)
    write(spark.createDataFrame([THIRD], SCHEMA), 6)
    found = spark.read.json(target)
    assert found.count() == 3
    assert rows(found.select("batch").distinct()) == [(4,), (6,)]


def test_kafka_options():
    assert clicks.kafka_options("broker:9092", "clicks") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "clicks",
        "startingOffsets": "latest",
    }
