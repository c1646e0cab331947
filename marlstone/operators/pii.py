"""Discovery of personal data by column name and by content, and column tags for what is found."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.rules import NameHint, Pattern
from marlstone.sources.readers import string_columns

FINDING = "database string, table string, column string, pii_type string, lgpd_class string, " \
    "confidence string, match_rate double"


def hint_for(
    column: str, hints: Sequence[NameHint] = rules.NAME_HINTS, match: str = "substring"
) -> NameHint | None:
    """First hint in the column name.

    `substring` finds a hint anywhere, also "rg" in "cargo"; `token` asks for whole words between
    underscores.
    """
    name = column.lower()
    if match == "token":
        return next((h for h in hints if re.search(rf"(^|_){re.escape(h.hint)}(_|$)", name)), None)
    return next((h for h in hints if h.hint in name), None)


def occurs(value: Column, regex: str, unicode: bool = True, ignore_case: bool = False) -> Column:
    """Whether the regex occurs anywhere in the text.

    `unicode` extends digits, blanks and word boundaries beyond ASCII.
    """
    flags = ("i" if ignore_case else "") + ("U" if unicode else "")
    return value.rlike(f"(?{flags}){regex}" if flags else regex)


def name_findings(
    df: DataFrame, database: str, table: str, hints: Sequence[NameHint] = rules.NAME_HINTS,
    match: str = "substring",
) -> DataFrame:
    """Columns whose name gives them away, with the number of values each exposes.

    One pass counts the values of all such columns.
    """
    hit = [(f.name, h) for f in df.schema if (h := hint_for(f.name, hints, match))]
    if not hit:
        return df.sparkSession.createDataFrame([], f"{FINDING}, exposed bigint")
    counted = df.agg(*[F.count(F.col(f"`{name}`")).alias(f"_{i}") for i, (name, _) in enumerate(hit)])
    rows = [
        F.struct(
            *_finding(database, table, name, h.pii_type, h.lgpd_class, "high", None),
            F.col(f"_{i}").alias("exposed"),
        )
        for i, (name, h) in enumerate(hit)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _finding(database, table, column, pii_type, lgpd_class, confidence, rate) -> list[Column]:
    rate = F.lit(None).cast("double") if rate is None else rate
    return [
        F.lit(database).alias("database"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(pii_type).alias("pii_type"),
        F.lit(lgpd_class).alias("lgpd_class"),
        F.lit(confidence).alias("confidence"),
        rate.alias("match_rate"),
    ]


def _match_counts(
    df: DataFrame, columns: Sequence[str], patterns: Sequence[Pattern], unicode: bool
) -> DataFrame:
    """One row: values per column and matches per column and pattern, from a single pass.

    What patterns need is looked for once per text, and a pattern only where it was found.
    """
    needs = sorted({p.needs for p in patterns if p.needs})
    texts = df.select(*[F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(columns)])
    marked = texts.select(
        "*",
        *[
            occurs(F.col(f"_t{i}"), need, unicode).alias(f"_k{i}_{k}")
            for i in range(len(columns))
            for k, need in enumerate(needs)
        ],
    )

    def hit(i: int, p: Pattern) -> Column:
        found = occurs(F.col(f"_t{i}"), p.regex, unicode, p.ignore_case)
        return F.col(f"_k{i}_{needs.index(p.needs)}") & found if p.needs else found

    return marked.agg(
        *[F.count(f"_t{i}").alias(f"_n{i}") for i in range(len(columns))],
        *[
            F.count_if(hit(i, p)).alias(f"_m{i}_{j}")
            for i in range(len(columns))
            for j, p in enumerate(patterns)
        ],
    )


def _rate(i: int, j: int) -> Column:
    return F.try_divide(F.col(f"_m{i}_{j}").cast("double"), F.col(f"_n{i}").cast("double"))


def pattern_rates(
    df: DataFrame,
    table: str,
    columns: Sequence[str] | None = None,
    patterns: Sequence[Pattern] = rules.PATTERNS,
    unicode: bool = True,
) -> DataFrame:
    """How often each pattern occurs in each string column, over the whole table."""
    columns = string_columns(df) if columns is None else list(columns)
    rows = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(c).alias("column"),
            F.lit(p.pii_type).alias("pii_type"),
            F.col(f"_m{i}_{j}").alias("matched"),
            F.col(f"_n{i}").alias("values"),
            F.coalesce(_rate(i, j), F.lit(0.0)).alias("match_rate"),
        )
        for i, c in enumerate(columns)
        for j, p in enumerate(patterns)
    ]
    return _match_counts(df, columns, patterns, unicode).select(F.inline(F.array(*rows)))


def scan_table(
    df: DataFrame,
    database: str,
    table: str,
    *,
    hints: Sequence[NameHint] = rules.NAME_HINTS,
    patterns: Sequence[Pattern] = rules.PATTERNS,
    threshold: float = rules.PII_MATCH_RATE,
    match: str = "substring",
    unicode: bool = True,
) -> DataFrame:
    """Findings of a table: every column by name, the string columns left by content.

    A column is reported for the first pattern, in order, that occurs in at least `threshold` of
    its values. All rows are read.
    """
    hinted = {f.name: h for f in df.schema if (h := hint_for(f.name, hints, match))}
    scanned = [c for c in string_columns(df) if c not in hinted]
    rows = [
        F.struct(*_finding(database, table, c, h.pii_type, h.lgpd_class, "high", None))
        for c, h in hinted.items()
    ]
    rows += [
        _first_pattern(database, table, i, c, patterns, threshold) for i, c in enumerate(scanned)
    ]
    if not rows:
        return df.sparkSession.createDataFrame([], FINDING)
    if scanned:
        counted = _match_counts(df, scanned, patterns, unicode)
    else:
        counted = df.sparkSession.range(1)
    return counted.select(F.inline(F.array_compact(F.array(*rows))))


def _first_pattern(database, table, i, column, patterns, threshold) -> Column:
    """The finding of a column, NULL where it is clean."""
    return F.coalesce(
        *[
            F.when(
                _rate(i, j) >= threshold,
                F.struct(
                    *_finding(
                        database, table, column, p.pii_type, p.lgpd_class, "medium", _rate(i, j)
                    )
                ),
            )
            for j, p in enumerate(patterns)
        ]
    )


def scan_databases(
    databases: Mapping[str, Mapping[str, DataFrame]], **options
) -> DataFrame:
    """Findings of all tables of several databases; none where there are no tables."""
    found = [
        scan_table(df, database, table, **options)
        for database, tables in databases.items()
        for table, df in tables.items()
    ]
    if not found:
        return SparkSession.active().createDataFrame([], FINDING)
    return reduce(DataFrame.unionByName, found)


def findings_report(findings: DataFrame, executed_at, databases: Sequence[str]) -> DataFrame:
    """One row with the report as a `json` document; it lists one entry per personal column."""
    listed = F.sort_array(F.collect_list(F.struct(*findings.columns)))
    return findings.agg(listed.alias("findings")).select(
        F.to_json(
            F.struct(
                F.lit(str(executed_at)).alias("executed_at"),
                F.array(*[F.lit(d) for d in databases]).alias("databases"),
                F.size("findings").alias("total_pii_cols"),
                "findings",
            ),
            {"ignoreNullFields": "false"},
        ).alias("json")
    )


# Tags and masks need the findings of one table at hand: one row per column of it.


def findings_of(findings: DataFrame, database: str, table: str) -> list[Row]:
    return (
        findings.filter((F.col("database") == database) & (F.col("table") == table))
        .orderBy("column")
        .collect()
    )


def tag_columns(
    df: DataFrame, found: Sequence[Row], tagged_at, detected_by: str = "marlstone"
) -> DataFrame:
    """Put the findings into the column metadata, where they follow the data into Parquet."""
    for row in found:
        if row["column"] not in df.columns:
            continue
        present = dict(df.schema[row["column"]].metadata or {})
        tags = {
            "pii_type": row["pii_type"],
            "lgpd_classification": row["lgpd_class"],
            "pii_confidence": row["confidence"],
            "pii_detected_by": detected_by,
            "pii_tagged_at": str(tagged_at),
            "PII": row["pii_type"],
            "LGPD_Classification": row["lgpd_class"],
        }
        df = df.withMetadata(row["column"], {**present, **tags})
    return df


def column_tags(df: DataFrame) -> dict[str, dict]:
    """Column -> tags, for the columns that have any."""
    return {f.name: dict(f.metadata) for f in df.schema if f.metadata and "PII" in f.metadata}


def mask_found(df: DataFrame, found: Sequence[Row], drop: bool = False) -> DataFrame:
    """Remove personal columns, or keep them as typed NULLs so that the schema stays."""
    personal = [row["column"] for row in found if row["column"] in df.columns]
    return df.drop(*personal) if drop else mask_as_null(df, personal)


def mask_as_null(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """The columns as NULL, in their own type or in the type given."""
    types = columns if isinstance(columns, Mapping) else {}
    masked = {
        c: F.lit(None).cast(types.get(c) or df.schema[c].dataType) for c in columns
    }
    return df.withColumns(masked)


def column_excluded_view(
    df: DataFrame, name: str, excluded: Sequence[str], rows: Column | None = None
) -> DataFrame:
    """Temporary view without some columns; all rows, or those that meet a condition."""
    shown = df if rows is None else df.filter(rows)
    shown.drop(*excluded).createOrReplaceTempView(name)
    return df.sparkSession.table(name)
