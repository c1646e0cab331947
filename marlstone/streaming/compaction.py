"""Compaction of streamed hour folders: few files of about one size, every committed row once.

A stream leaves small files per batch and hour. `compact` takes those that its batches have committed
and that no earlier run has taken, merges them with what is compacted of the same hours, and writes
each of these hours as a new version next to the old one. Hours without new rows are not touched.

A run is committed by one line, added after data and ledger are whole. Data of an hour is read from
its version of the last committed run, and files count as taken only if the run that took them is
committed, so a run that fails, or is tried again, neither loses nor doubles rows. One run works on
a target at a time; readers need no lock.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.sources.scratch import written
from marlstone.streaming.clicks import PARTITIONS

TARGET_BYTES = 128 << 20
_HOUR = ", ".join(f"{p} int" for p in PARTITIONS)
_RUN = "number bigint, run string"
# What a run has made of an hour: files of `bytes` in all.
_HOURS = f"{_HOUR}, bytes bigint, run string"
_TAKEN = "path string, run string"


@dataclass(frozen=True)
class Compacted:
    files: int
    hours: int


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _runs(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, f"{root}/commits", _RUN)


def last_committed_batch(spark: SparkSession, checkpoint: str) -> tuple[str, int]:
    """The id of the query of a checkpoint, and its last batch that is committed (-1: none)."""
    query = spark.read.json(f"{checkpoint}/metadata").first()["id"]
    try:
        done = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(f"{checkpoint}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return query, -1
    number = F.regexp_extract("path", r"/([0-9]+)$", 1).try_cast("bigint")
    return query, done.agg(F.coalesce(F.max(number), F.lit(-1)).alias("last")).first()["last"]


def committed_files(spark: SparkSession, landing: str, checkpoint: str | None = None) -> DataFrame:
    """(path, bytes, year, month, day, hour) of the files that hold rows of committed batches.

    A folder of the file sink tells them itself. For folders of `batch_writer`, `checkpoint` is that
    of the query that writes to it; of a batch that is not committed yet nothing is taken, since it
    may be tried again. Without a checkpoint all files are taken, which is right once no query runs.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(landing)
    if checkpoint is not None:
        query, last = last_committed_batch(spark, checkpoint)
        files = files.filter((F.col("query") != query) | (F.col("batch") <= last))
    hour = [F.col(p).cast("int").alias(p) for p in PARTITIONS]
    return files.filter("length > 0").select("path", F.col("length").alias("bytes"), *hour)


def _current(spark: SparkSession, root: str) -> DataFrame:
    """The last committed version of every compacted hour."""
    hours = _table(spark, f"{root}/hours", _HOURS).join(_runs(spark, root), "run")
    latest = hours.groupBy(*PARTITIONS).agg(F.max_by(F.struct("run", "bytes"), "number").alias("last"))
    return latest.select(*PARTITIONS, "last.*")


def _folder(root: str):
    # The run comes after the time, so that folders of all runs share one base.
    parts = [x for p in PARTITIONS for x in (F.lit(f"/{p}="), F.coalesce(F.col(p).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))]
    return F.concat(F.lit(f"{root}/data"), *parts, F.lit("/run="), F.col("run"))


def _read(spark: SparkSession, root: str, hours: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the versions of `hours`; one folder per hour passes through the driver."""
    folders = [row[0] for row in hours.select(_folder(root)).collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    kept = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(kept).option("basePath", f"{root}/data").json(folders).drop("run")


def read_compacted(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All compacted rows. `schema` is that of the rows with year, month, day and hour."""
    return _read(spark, root, _current(spark, root), schema)


def compact(
    spark: SparkSession,
    landing: str,
    root: str,
    schema: T.StructType,
    *,
    checkpoint: str | None = None,
    target_bytes: int = TARGET_BYTES,
) -> Compacted:
    """Take what is new in `landing` into the compacted table at `root`.

    An hour is left as at most its bytes / target_bytes + 1 files. Its rows are dealt out evenly to
    that many, so that a busy hour is no more than that many bytes to a task. Files of the landing
    folder stay; those that were taken may be removed.
    """
    runs = _runs(spark, root)
    taken = _table(spark, f"{root}/taken", _TAKEN).join(runs, "run")
    fresh = written(committed_files(spark, landing, checkpoint).join(taken, "path", "left_anti"), "fresh-files")
    paths = [row["path"] for row in fresh.select("path").collect()]
    if not paths:
        return Compacted(0, 0)
    number = runs.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    run = f"r{number:08d}-{uuid.uuid4().hex}"

    same_hour = [F.col(f"o.{p}").eqNullSafe(F.col(f"n.{p}")) for p in PARTITIONS]
    added = fresh.groupBy(*PARTITIONS).agg(F.sum("bytes").alias("bytes"))
    old = written(_current(spark, root).alias("o").join(added.alias("n"), same_hour, "left_semi"), "old-hours")
    hours = written(
        added.unionByName(old.drop("run")).groupBy(*PARTITIONS).agg(F.sum("bytes").alias("bytes")).withColumn("run", F.lit(run)),
        "hours",
    )

    streamed = spark.read.schema(schema).option("basePath", landing).json(paths)
    rows = streamed.select(*schema.names).unionByName(_read(spark, root, old, schema).select(*schema.names))
    parts = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)).cast("int")
    sized = hours.select(*[F.col(p).alias(f"_{p}") for p in PARTITIONS], parts.alias("_parts"))
    on = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in PARTITIONS]
    # Numbered while the files are read, so that a task that is run again deals its rows alike.
    dealt = rows.withColumn("_row", F.monotonically_increasing_id())
    dealt = dealt.join(F.broadcast(sized) if len(paths) <= 10_000 else sized, on)
    dealt = dealt.withColumn("_part", F.pmod("_row", "_parts"))
    tasks = max(1, hours.agg(F.sum(parts)).first()[0])
    gathered = dealt.repartition(tasks, *PARTITIONS, "_part").select(*schema.names, F.lit(run).alias("run"))
    gathered.write.mode("append").partitionBy(*PARTITIONS, "run").json(f"{root}/data")

    fresh.select("path", F.lit(run).alias("run")).write.mode("append").json(f"{root}/taken")
    hours.write.mode("append").json(f"{root}/hours")
    spark.createDataFrame([(number, run)], _RUN).coalesce(1).write.mode("append").json(f"{root}/commits")
    return Compacted(len(paths), hours.count())


def files_per_hour(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, day, hour, files, bytes) of the compacted hours as they are read."""
    folders = [row[0] for row in _current(spark, root).select(_folder(root)).collect()]
    if not folders:
        return spark.createDataFrame([], f"{_HOUR}, files bigint, bytes bigint")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("basePath", f"{root}/data").load(folders)
    hour = [F.col(p).cast("int").alias(p) for p in PARTITIONS]
    return files.groupBy(*hour).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
