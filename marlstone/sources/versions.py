"""Whole tables replaced at once: readers see the old version until the new one is committed.

Every version is a folder of its own below the root, and a commit is one line in `commits`, added by
a Spark job after the version is whole. A job that fails, or whose executors are lost, leaves a
folder that no commit names. There is one writer at a time; readers need no lock, and a reader that
has begun goes on with the version it began with.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.writers import register_parquet_table, write_parquet

_COMMIT = "number bigint, version string"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """(number, version) of every commit; no rows where there is none yet."""
    try:
        return spark.read.schema(_COMMIT).json(f"{root}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)


def _last(spark: SparkSession, root: str) -> tuple[int, str | None]:
    last = commits(spark, root).agg(F.max(F.struct("number", "version")).alias("last")).first()["last"]
    return (last["number"], last["version"]) if last else (0, None)


def current_path(spark: SparkSession, root: str) -> str:
    """The folder of the version committed last."""
    _, version = _last(spark, root)
    if version is None:
        raise FileNotFoundError(f"{root} has no committed version")
    return f"{root}/{version}"


def read_current(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, root))


def replace(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write `df` as the new version and commit it. `df` may read the version before. Returns its path."""
    spark = df.sparkSession
    number, _ = _last(spark, root)
    version = f"v-{number + 1:08d}-{uuid.uuid4().hex}"
    path = f"{root}/{version}"
    write_parquet(df, path, partition_by)
    line = spark.createDataFrame([(number + 1, version)], _COMMIT)
    line.coalesce(1).write.mode("append").json(f"{root}/commits")
    return path


def replace_table(df: DataFrame, name: str, root: str, partition_by: Sequence[str] = ()) -> None:
    """The same for a registered table, whose location is moved to the new version after the commit."""
    register_parquet_table(df.sparkSession, name, replace(df, root, partition_by))
