"""Discovery of personal data that reads each file once: match counts per file, kept and merged.

The ledger holds, for every file of every table, how many values its text columns have and how many
of them each pattern matches. Counts of files add up, so the findings of a table are sums over its
files, and a rescan reads only files that are new or have changed (by path, size and time). Files
that are gone leave the ledger. Counts taken under other patterns or hints are taken anew.

The ledger is replaced as a whole by a version with a commit: a scan that fails changes nothing.
Tables are counted one after the other, each in a job of its own, so that no plan grows with their
number; the findings come from one aggregate over the ledger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.operators.pii import FINDING, hint_for, occurs
from marlstone.rules import NameHint, Pattern
from marlstone.sources import versions
from marlstone.sources.readers import string_columns
from marlstone.sources.scratch import scratch_path, written

_FILE = "database string, table string, file string, size bigint, modified timestamp"
LEDGER = f"{_FILE}, rules string, column string, values bigint, matched array<bigint>"
_SAME_FILE = ("database", "table", "file", "size", "modified", "rules")


@dataclass(frozen=True)
class Rules:
    """What is looked for. `key` names it in the ledger."""

    hints: Sequence[NameHint] = rules.NAME_HINTS
    patterns: Sequence[Pattern] = rules.PATTERNS
    match: str = "substring"
    unicode: bool = True

    @property
    def key(self) -> str:
        told = repr(([tuple(h) for h in self.hints], [tuple(p) for p in self.patterns], self.match, self.unicode))
        return hashlib.sha256(told.encode()).hexdigest()

    def hinted(self, df: DataFrame) -> dict[str, NameHint]:
        return {f.name: h for f in df.schema if (h := hint_for(f.name, self.hints, self.match))}


@dataclass(frozen=True)
class Scanned:
    """What a scan read: files counted now, and files whose counts were there already."""

    read: int
    kept: int


def files_of(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """(path, file, size, modified) of the files of a folder. Their content is not read.

    `path` is what readers take, `file` what `_metadata.file_path` gives for the rows of the file.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return listed.select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def counts_per_file(df: DataFrame, columns: Sequence[str], looked_for: Rules) -> DataFrame:
    """(file, column, values, matched): per file and text column the values, and the matches of
    every pattern in order. One pass; each task sums its files before rows are moved."""
    needs = sorted({p.needs for p in looked_for.patterns if p.needs})
    texts = df.select(
        F.col("_metadata.file_path").alias("file"),
        *[F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(columns)],
    )
    # What patterns need is looked for once per text.
    marked = texts.select(
        "*",
        *[
            occurs(F.col(f"_t{i}"), need, looked_for.unicode).alias(f"_k{i}_{k}")
            for i in range(len(columns))
            for k, need in enumerate(needs)
        ],
    )

    def hit(i: int, p: Pattern):
        found = occurs(F.col(f"_t{i}"), p.regex, looked_for.unicode, p.ignore_case)
        return F.col(f"_k{i}_{needs.index(p.needs)}") & found if p.needs else found

    counted = marked.groupBy("file").agg(
        *[F.count(f"_t{i}").alias(f"_n{i}") for i in range(len(columns))],
        *[
            F.count_if(hit(i, p)).alias(f"_m{i}_{j}")
            for i in range(len(columns))
            for j, p in enumerate(looked_for.patterns)
        ],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_n{i}").alias("values"),
            F.array(*[F.col(f"_m{i}_{j}") for j in range(len(looked_for.patterns))]).cast("array<bigint>").alias("matched"),
        )
        for i, c in enumerate(columns)
    ]
    return counted.select("file", F.inline(F.array(*rows)))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The counts committed last; no rows where nothing was scanned yet."""
    try:
        return spark.read.schema(LEDGER).parquet(versions.current_path(spark, root))
    except FileNotFoundError:
        return spark.createDataFrame([], LEDGER)


def scan(
    spark: SparkSession,
    root: str,
    databases: Mapping[str, Mapping[str, str]],
    looked_for: Rules | None = None,
) -> Scanned:
    """Bring the ledger at `root` up to date with the tables: database -> table -> Parquet folder.

    Tables that are not named keep their counts. The names of a table's new files pass through the
    driver, as they do whenever Spark reads a folder. One scan runs at a time.
    """
    looked_for = looked_for or Rules()
    before = ledger(spark, root)
    staged = scratch_path(spark, "file-counts")
    named, read, kept = [], 0, 0
    for database, tables in databases.items():
        for table, path in tables.items():
            named.append((database, table))
            listed = files_of(spark, path).withColumns(
                {"database": F.lit(database), "table": F.lit(table), "rules": F.lit(looked_for.key)}
            )
            now = written(listed, "files")
            known = before.filter((F.col("database") == database) & (F.col("table") == table))
            still = known.join(now, list(_SAME_FILE), "left_semi")
            fresh = now.join(known, list(_SAME_FILE), "left_anti")
            paths = [row["path"] for row in fresh.select("path").collect()]
            read += len(paths)
            kept += still.select("file").distinct().count()
            lines = still.select(*_columns())
            if paths:
                lines = lines.unionByName(_counted(spark, path, paths, fresh, looked_for))
            lines.write.mode("append").parquet(staged)
    others = before
    if named:
        others = before.join(spark.createDataFrame(named, "database string, table string"), ["database", "table"], "left_anti")
        others = others.select(*_columns()).unionByName(spark.read.schema(LEDGER).parquet(staged))
    versions.replace(others, root)
    return Scanned(read, kept)


def _columns() -> list[str]:
    return [*_SAME_FILE, "column", "values", "matched"]


def _counted(spark: SparkSession, root: str, paths: list[str], fresh: DataFrame, looked_for: Rules) -> DataFrame:
    schema = spark.read.parquet(root).schema
    whole = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    hinted = looked_for.hinted(whole)
    columns = [c for c in string_columns(whole) if c not in hinted]
    if not columns:
        empty = "cast(null as string) as column", "cast(null as bigint) as values", "cast(null as array<bigint>) as matched"
        return fresh.selectExpr(*_SAME_FILE, *empty)
    # A file without rows is noted as read, too.
    return fresh.join(counts_per_file(whole, columns, looked_for), "file", "left").select(*_columns())


def findings(
    spark: SparkSession,
    root: str,
    databases: Mapping[str, Mapping[str, str]],
    looked_for: Rules | None = None,
    threshold: float = rules.PII_MATCH_RATE,
) -> DataFrame:
    """The findings of the scanned tables, as `scan_databases` gives them: columns by name, and the
    text columns left by the first pattern in at least `threshold` of their values."""
    looked_for = looked_for or Rules()
    by_name = [
        (database, table, column, hint.pii_type, hint.lgpd_class, "high", None)
        for database, tables in databases.items()
        for table, path in tables.items()
        for column, hint in looked_for.hinted(spark.read.parquet(path)).items()
    ]
    named = spark.createDataFrame(by_name, FINDING)
    if not looked_for.patterns or not any(databases.values()):
        return named
    tables = [(d, t) for d, of in databases.items() for t in of]
    counted = ledger(spark, root).filter((F.col("rules") == looked_for.key) & F.col("column").isNotNull())
    counted = counted.join(spark.createDataFrame(tables, "database string, table string"), ["database", "table"], "left_semi")
    matched = [F.sum(F.col("matched")[j]).alias(f"_m{j}") for j in range(len(looked_for.patterns))]
    summed = counted.groupBy("database", "table", "column").agg(F.sum("values").alias("values"), *matched)

    def as_finding(j: int, p: Pattern):
        rate = F.try_divide(F.col(f"_m{j}").cast("double"), F.col("values").cast("double"))
        told = F.struct(
            F.lit(p.pii_type).alias("pii_type"), F.lit(p.lgpd_class).alias("lgpd_class"),
            F.lit("medium").alias("confidence"), rate.alias("match_rate"),
        )
        return F.when(rate >= threshold, told)

    first = F.coalesce(*[as_finding(j, p) for j, p in enumerate(looked_for.patterns)])
    by_content = summed.select("database", "table", "column", first.alias("found")).filter("found IS NOT NULL")
    return named.unionByName(by_content.select("database", "table", "column", "found.*"))
