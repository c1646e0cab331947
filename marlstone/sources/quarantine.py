"""CSV input whose malformed lines are kept apart instead of becoming NULLs."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.sources.readers import header_schema, with_ingestion_time
from marlstone.sources.writers import write_parquet

RECORD, FILE = "_bad_record", "_source_file"


class Ingested(NamedTuple):
    """Lines read, stored and set aside."""

    rows: int
    good: int
    bad: int


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """The CSV rows, with the line as it is in `_bad_record` where it does not fit, and its file.

    A line does not fit if it has more or fewer fields than the schema, or a value of another type.
    Without a schema the columns are those of the header and all text, so that only the number of
    fields decides and typing is left to staging.
    """
    if schema is None:
        schema = header_schema(spark, path)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    kept = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    reader = spark.read.schema(kept).option("header", True).option("encoding", "UTF-8")
    # With pruned columns the parser would not see that a line has too many or too few fields.
    reader = reader.option("columnPruning", False).option("mode", "PERMISSIVE")
    lines = reader.option("columnNameOfCorruptRecord", RECORD).csv(path)
    return lines.withColumn(FILE, F.col("_metadata.file_path"))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(RECORD).isNull()).drop(RECORD, FILE)


def bad_rows(checked: DataFrame) -> DataFrame:
    """(record, fields, file) of the lines that do not fit; fields is JSON of what could be read."""
    bad = checked.filter(F.col(RECORD).isNotNull())
    fields = F.to_json(F.struct(*[c for c in checked.columns if c not in (RECORD, FILE)]))
    return bad.select(F.col(RECORD).alias("record"), fields.alias("fields"), F.col(FILE).alias("file"))


def ingest_csv(
    spark: SparkSession,
    source: str,
    target: str,
    quarantine: str,
    partition_by: Sequence[str] = (),
    *,
    schema: T.StructType | str | None = None,
    ingested_at=None,
    whole: bool = False,
) -> Ingested:
    """CSV folder to Parquet folder with the audit timestamp; lines that do not fit go to `quarantine`.

    Everything is counted while it is written. The input is read a second time only if it holds
    lines that do not fit. `quarantine` is replaced at every run, by no rows if there are none.
    """
    checked = read_csv_checked(spark, source, schema)
    found, stored, kept_apart = Observation(), Observation(), Observation()
    # Asked only whether there are any: a task run again may count its lines twice here, before the
    # shuffle. The counts below are taken by the tasks that write, which count once.
    seen = checked.observe(found, F.count(RECORD).alias("bad"))
    rows = with_ingestion_time(good_rows(seen), ingested_at)
    write_parquet(
        rows, target, partition_by, whole=whole, observed=(stored, [F.count(F.lit(1)).alias("rows")])
    )
    bad = bad_rows(checked)
    if not found.get.get("bad"):
        bad = spark.createDataFrame([], bad.schema)
        bad.write.mode("overwrite").parquet(quarantine)
        return Ingested(stored.get.get("rows", 0), stored.get.get("rows", 0), 0)
    bad.observe(kept_apart, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(quarantine)
    good, set_aside = stored.get.get("rows", 0), kept_apart.get.get("rows", 0)
    return Ingested(good + set_aside, good, set_aside)
