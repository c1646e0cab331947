"""Tables of a database."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

_log = logging.getLogger(__name__)


def tables_of(
    spark: SparkSession, database: str, root: str | None = None, unread: list[str] | None = None
) -> dict[str, DataFrame]:
    """Name -> frame for every readable table of the database.

    A registered table that cannot be read is looked up at `<root>/<name>/`; one that is not there
    either is left out, logged, and its name added to `unread`.
    """
    found = {}
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        df = _readable(spark, f"{database}.{table.name}", root and f"{root}/{table.name}/")
        if df is not None:
            found[table.name] = df
        else:
            _log.warning("%s.%s could not be read", database, table.name)
            if unread is not None:
                unread.append(table.name)
    return found


def _readable(spark: SparkSession, name: str, fallback: str | None) -> DataFrame | None:
    from pyspark.errors import PySparkException

    attempts = [lambda: spark.table(name)]
    if fallback:
        attempts.append(lambda: spark.read.parquet(fallback))
    for attempt in attempts:
        try:
            df = attempt()
            df.schema
            return df
        except PySparkException:
            continue
    return None
