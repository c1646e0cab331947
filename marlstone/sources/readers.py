"""Readers: CSV, Parquet, one-year scans, registered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    infer: bool = False,
) -> DataFrame:
    """UTF-8 CSV file or folder with a header row.

    Without a schema all columns are text; `infer` finds their types, which reads the input one
    more time. Values that do not fit become NULL: `quarantine` keeps such lines apart.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("inferSchema", infer).csv(path)


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns that the header names, all text. Reads one line."""
    return read_csv(spark, path).schema


def with_ingestion_time(df: DataFrame, at=None, name: str = "ingestion_ts") -> DataFrame:
    """Add the audit timestamp; pass `at` to fix it."""
    return df.withColumn(name, F.current_timestamp() if at is None else F.lit(at))


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def scan_year(
    spark: SparkSession, root: str, year: int, month: int | None = None, *, year_column="year",
    month_column="month",
) -> DataFrame:
    """One year, or one month of it, of a table partitioned by year and month.

    The filter is on partition columns, so only the matching folders are listed and read.
    """
    df = spark.read.parquet(root).filter(F.col(year_column) == year)
    return df if month is None else df.filter(F.col(month_column) == month)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
