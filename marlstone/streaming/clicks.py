"""Click-stream ingestion: source, event-time partitions, sinks that survive a retry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from marlstone.functions.calendar import event_parts

PARTITIONS = ("year", "month", "day", "hour")
INTERVAL = "30 seconds"


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def kafka_clicks(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType | str,
    starting: str = "latest",
) -> DataFrame:
    """Clicks from JSON messages of a topic. Needs the Spark Kafka connector on the class path.

    Messages that do not parse are left out; `start_message_ingest` keeps them as dead letters.
    """
    return parsed_clicks(parse_messages(kafka_messages(spark, servers, topic, starting), schema))


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest"
) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting)).load()


_POSITION = ("topic", "partition", "offset", "timestamp")
_UNPARSED = "_unparsed"


def parse_messages(messages: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Messages (value, and topic, partition, offset, timestamp as far as there) with `click`.

    `reason` tells why there is no click: "empty" for a message without a value, "unparsed" for one
    that is no JSON object or in which a value has another type. It is NULL for a good message.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    kept = T.StructType([*schema.fields, T.StructField(_UNPARSED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNPARSED}
    body = F.from_json(F.col("value").cast("string"), kept, options)
    position = [c for c in _POSITION if c in messages.columns]
    parsed = messages.select("value", *position, body.alias("_body"))
    unparsed = F.col("_body").isNull() | F.col(f"_body.{_UNPARSED}").isNotNull()
    # A text that is blank parses to a struct of NULLs without being called corrupt.
    blank = F.trim(F.col("value").cast("string")) == ""
    reason = F.when(F.col("value").isNull(), "empty").when(unparsed | blank, "unparsed")
    click = F.struct(*[F.col(f"_body.{f.name}").alias(f.name) for f in schema.fields])
    return parsed.select("value", *position, click.alias("click"), reason.alias("reason"))


def parsed_clicks(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).select("click.*")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The messages that are no clicks: raw value, position and reason."""
    return parsed.filter(F.col("reason").isNotNull()).drop("click")


def file_clicks(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Clicks from files that arrive in a folder."""
    reader = spark.readStream.schema(schema).format(format)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def with_event_partitions(
    clicks: DataFrame, event_time: str = "event_timestamp", processed_at=None
) -> DataFrame:
    """Add the processing time and year, month, day and hour of the event."""
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    return clicks.withColumns({"processed_at": stamp, **event_parts(F.col(event_time))})


def start_ingest(
    clicks: DataFrame,
    target: str,
    checkpoint: str,
    *,
    event_time: str = "event_timestamp",
    interval: str | None = INTERVAL,
    processed_at=None,
) -> StreamingQuery:
    """Append clicks as partitioned JSON, every `interval`, or once through what is there (None).

    Uses the file sink: it records each batch when complete, so a batch that is tried again is
    read once. Batches without rows write nothing.
    """
    writer = (
        with_event_partitions(clicks, event_time, processed_at)
        .writeStream.format("json")
        .outputMode("append")
        .partitionBy(*PARTITIONS)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def batch_writer(
    target: str, event_time: str = "event_timestamp", processed_at=None
) -> Callable[[DataFrame, int], None]:
    """Body for foreachBatch. Every batch has folders of its own below the time folders.

    They are named by the query's id, which a new checkpoint changes, and the batch's; a retry
    overwrites them. A body called outside a query takes "none" for the query's id.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        context = batch.sparkSession.sparkContext
        query = context.getLocalProperty("sql.streaming.queryId") or "none"
        (
            with_event_partitions(batch, event_time, processed_at)
            # Not every task leaves a file in every hour.
            .hint("rebalance", *PARTITIONS)
            .withColumns({"query": F.lit(query), "batch": F.lit(batch_id)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS, "query", "batch")
            .json(target)
        )

    return write


def start_batch_ingest(
    clicks: DataFrame,
    target: str,
    checkpoint: str,
    *,
    event_time: str = "event_timestamp",
    interval: str | None = INTERVAL,
    processed_at=None,
) -> StreamingQuery:
    """The same with foreachBatch, for targets the file sink cannot write to."""
    writer = clicks.writeStream.foreachBatch(
        batch_writer(target, event_time, processed_at)
    ).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def message_writer(
    target: str,
    dead_target: str,
    schema: T.StructType | str,
    event_time: str = "event_timestamp",
    processed_at=None,
) -> Callable[[DataFrame, int], None]:
    """Body for foreachBatch over messages: clicks to `target` as `batch_writer` does, and messages
    that do not parse to `dead_target`, in a folder per query and batch that a retry overwrites."""
    write_clicks = batch_writer(target, event_time, processed_at)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Kept for the two writes, so that the topic is read once.
        parsed = parse_messages(batch, schema).persist()
        try:
            context = batch.sparkSession.sparkContext
            query = context.getLocalProperty("sql.streaming.queryId") or "none"
            dead = dead_letters(parsed)
            if not dead.isEmpty():
                dead = dead.withColumns({"query": F.lit(query), "batch": F.lit(batch_id)})
                writer = dead.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy("query", "batch").parquet(dead_target)
            write_clicks(parsed_clicks(parsed), batch_id)
        finally:
            parsed.unpersist()

    return write


def start_message_ingest(
    messages: DataFrame,
    target: str,
    dead_target: str,
    checkpoint: str,
    schema: T.StructType | str,
    *,
    event_time: str = "event_timestamp",
    interval: str | None = INTERVAL,
    processed_at=None,
) -> StreamingQuery:
    """Messages to partitioned JSON, those that do not parse to a table of dead letters."""
    body = message_writer(target, dead_target, schema, event_time, processed_at)
    writer = messages.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)
