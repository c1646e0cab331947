"""Tables written on the way through a job, in a folder every executor reaches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Spark's own setting, which a session may change.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session may go without the setting; it gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marlstone-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files.

    They are of no more use once the rows are stored, but otherwise stay on the disks of the executors
    until the driver happens to collect its garbage, which may be after the last step.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str, *, rounds: int = 1, dealt_by: str | None = None) -> DataFrame:
    """Write the rows as Parquet and continue from the files.

    Cuts the lineage, survives the loss of executors, and lets later steps read single columns.

    With several `rounds` every round writes the share of the rows that `dealt_by`, by its hash, puts
    there, so that only the shuffles of one share are on the disks at a time. The sources are read once
    a round.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        for number in range(rounds):
            share = df.filter(F.pmod(F.xxhash64(dealt_by), F.lit(rounds)) == number) if rounds > 1 else df
            share.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
