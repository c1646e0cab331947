"""Writers: Parquet with partition-wise overwrite, JSON and text documents, table registration."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from marlstone.sources.scratch import shuffles_removed

_log = logging.getLogger(__name__)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    gather: bool = True,
    whole: bool = False,
    observed: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Overwrite `path`; with `partition_by` only the partitions present in `df` are replaced.

    `whole` replaces all of it: partitions that `df` does not have are removed. `df` must not read
    from `path` then.

    `gather` brings the rows of a partition value together first, so that not every task leaves a
    file in every folder. Adaptive execution then evens the tasks out: it splits a value with many
    rows over several and merges small ones. Turn it off for rows that are gathered already.

    `observed` takes counts of the rows in the tasks that write them.
    """
    if gather and partition_by:
        df = df.hint("rebalance", *partition_by)
    if observed:
        df = df.observe(observed[0], *observed[1])
    writer = df.write.mode("overwrite")
    if partition_by:
        mode = "static" if whole else "dynamic"
        writer = writer.option("partitionOverwriteMode", mode).partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        writer.parquet(path)


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str] = (),
    *,
    schema=None,
    ingested_at=None,
    whole: bool = False,
) -> None:
    """CSV folder to Parquet folder with the audit timestamp."""
    from marlstone.sources.readers import read_csv, with_ingestion_time

    df = with_ingestion_time(read_csv(spark, source, schema), ingested_at)
    write_parquet(df, target, partition_by, whole=whole)


def dated_path(root: str, day: datetime, name: str) -> str:
    return f"{root.rstrip('/')}/{day:%Y/%m/%d}/{name}"


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row, one-column frame as a single text file."""
    document.coalesce(1).write.mode("overwrite").text(path)


def register_parquet_table(
    spark: SparkSession, name: str, path: str, types: Mapping[str, str] | None = None
) -> None:
    """Register a Parquet folder as a table and pick up its partition folders.

    Column and partition types come from the files and folder names. Run again, it adds new
    folders; columns that have changed since are logged, and the table keeps those it has. A table
    known under another folder is moved to this one. The catalog knows the folder of every single
    partition too, so a partitioned table is moved by registering it anew; its files stay.
    """
    known = spark.catalog.tableExists(name)
    if known and _is_partitioned(spark, name) and _location(spark, name) != path.removeprefix("file:").rstrip("/"):
        spark.sql(f"DROP TABLE {name}")
        known = False
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    columns = ""
    if types and not known:
        stored = spark.read.parquet(path).dtypes
        columns = f"({', '.join(f'`{c}` {types.get(c, kind)}' for c, kind in stored)})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING parquet LOCATION '{location}'")
    if known:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        for change in schema_changes(spark.table(name), spark.read.parquet(path)):
            _log.warning("%s: %s", name, change)
    if _is_partitioned(spark, name):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def schema_changes(table: DataFrame, files: DataFrame) -> list[str]:
    """Columns added, removed or retyped in the files against the table."""
    before, now = dict(table.dtypes), dict(files.dtypes)
    added = [f"column {c} {now[c]} added" for c in now if c not in before]
    removed = [f"column {c} removed" for c in before if c not in now]
    retyped = [
        f"column {c} {before[c]} is now {now[c]}" for c in now if before.get(c, now[c]) != now[c]
    ]
    return added + removed + retyped


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return described.first()["data_type"].removeprefix("file:").rstrip("/")


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(column.isPartition for column in spark.catalog.listColumns(name))


def save_model(df: DataFrame, layer: str, model: str, root: str) -> str:
    """Materialise `df` as table `model` of database `layer`, stored under `root`."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}'")
    name = f"{layer}.{model}"
    df.write.mode("overwrite").option("path", f"{root}/{layer}/{model}").saveAsTable(name)
    return name
