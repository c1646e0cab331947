"""Data-quality checks: one pass over a table for all row checks, one narrow pass per unique key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.functions.numbers import failure_rate


class Check(NamedTuple):
    kind: str
    column: str
    category: str = rules.INTEGRITY
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def not_null(column: str, category: str = rules.INTEGRITY) -> Check:
    return Check("not_null", column, category)


def unique(column: str, category: str = rules.INTEGRITY) -> Check:
    """Fails for every row beyond the first of its value; NULL is one value."""
    return Check("unique", column, category)


def unique_values(column: str, category: str = rules.INTEGRITY) -> Check:
    """Fails for every value, NULL aside, that occurs more than once."""
    return Check("unique_values", column, category)


def accepted_values(column: str, values: Sequence, category: str = rules.INTEGRITY) -> Check:
    """Fails for every value outside the list; NULL passes."""
    return Check("accepted_values", column, category, tuple(values))


def non_negative(column: str, category: str = rules.BUSINESS) -> Check:
    """Fails below zero; NULL passes."""
    return Check("non_negative", column, category)


def positive(column: str, category: str = rules.BUSINESS) -> Check:
    """Fails at or below zero; NULL passes."""
    return Check("positive", column, category)


_KEY_CHECKS = ("unique", "unique_values")


def _row_fails(check: Check, is_text: bool = False) -> Column:
    value = F.col(check.column)
    if is_text and check.kind in ("non_negative", "positive"):
        # A text that is no number is not judged here; staging keeps it as a failed cast.
        value = value.try_cast("double")
    return {
        "not_null": lambda: value.isNull(),
        "accepted_values": lambda: ~value.isin(*check.values),
        "non_negative": lambda: value < 0,
        "positive": lambda: value <= 0,
    }[check.kind]()


def _result_row(position: int, check: Check, failed: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.category).alias("category"),
        F.lit(check.name).alias("check"),
        failed.cast("bigint").alias("failed"),
    )


def row_check_counts(df: DataFrame, checks: Sequence[Check]) -> list[Column]:
    """Aggregates for all row checks: the rows, and by position of the check those that fail."""
    types = dict(df.dtypes)
    return [
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(_row_fails(c, types.get(c.column) == "string")).alias(f"_{i}")
            for i, c in enumerate(checks)
            if c.kind not in _KEY_CHECKS
        ],
    ]


def run_checks(
    df: DataFrame,
    checks: Sequence[Check],
    layer: str,
    table: str,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row per check: layer, table, position, category, check, total, failed, rate.

    Nothing runs before the result is asked for. However many row checks there are, they share one
    aggregate over the table; a unique check reads its key column only. `counted`, the row of
    `row_check_counts` if it was taken already, saves that aggregate.
    """
    placed = list(enumerate(checks))
    row_checks = [(i, c) for i, c in placed if c.kind not in _KEY_CHECKS]
    key_checks = [(i, c) for i, c in placed if c.kind in _KEY_CHECKS]
    parts = [_key_result(df, i, c) for i, c in key_checks]
    if row_checks:
        counted = df.agg(*row_check_counts(df, checks)) if counted is None else counted
        parts.append(
            counted.select(
                "total",
                F.inline(F.array(*[_result_row(i, c, F.col(f"_{i}")) for i, c in row_checks])),
            )
        )
    results = reduce(DataFrame.unionByName, parts)
    return results.select(
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table"),
        "position",
        "category",
        "check",
        "total",
        "failed",
        failure_rate(F.col("failed"), F.col("total")).alias("rate"),
    )


def _key_result(df: DataFrame, position: int, check: Check) -> DataFrame:
    per_value = df.groupBy(check.column).agg(F.count(F.lit(1)).alias("_rows"))
    total = F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
    if check.kind == "unique":
        failed = total - F.count(F.lit(1))
    else:
        failed = F.count_if((F.col("_rows") > 1) & F.col(check.column).isNotNull())
    counted = per_value.agg(total.alias("total"), failed.alias("_failed"))
    return counted.select("total", F.inline(F.array(_result_row(position, check, F.col("_failed")))))


def run_suite(
    tables: Mapping[str, DataFrame],
    suite: Mapping[str, Sequence[Check]],
    layer: str,
    counted: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The checks of every table of a layer; `counted` as for `run_checks`, by table."""
    known = counted or {}
    return reduce(
        DataFrame.unionByName,
        [
            run_checks(tables[table], checks, layer, table, known.get(table))
            for table, checks in suite.items()
        ],
    )


def evaluate(
    results: DataFrame, thresholds: Mapping[str, float] | None = None
) -> DataFrame:
    """Add `threshold`, `passed` and, for a failed check, `message`. A rate at the limit passes.

    A check of a category without a threshold has not passed.
    """
    thresholds = thresholds or rules.THRESHOLDS
    limit = _by_category({c: F.lit(float(t)) for c, t in thresholds.items()})
    limit_text = _by_category({c: F.lit(f"{t:.0%}") for c, t in thresholds.items()})
    label = _by_category({c: F.lit(rules.CATEGORY_LABELS.get(c, c)) for c in thresholds})
    percent = F.round((F.col("rate") * 100).cast("decimal(20,8)"), 2).cast("decimal(20,2)")
    message = F.format_string(
        "[%s] %s: taxa=%s%% (limiar=%s, falhas=%s/%s)",
        label,
        F.col("check"),
        percent.cast("string"),
        limit_text,
        F.col("failed").cast("string"),
        F.col("total").cast("string"),
    )
    passed = F.coalesce(F.col("rate") <= limit, F.lit(False))
    return (
        results.withColumn("threshold", limit)
        .withColumn("passed", passed)
        .withColumn("message", F.when(~F.col("passed"), message))
    )


def _by_category(choices: Mapping[str, Column]) -> Column:
    chosen = F.lit(None)
    for category, value in choices.items():
        chosen = F.when(F.col("category") == category, value).otherwise(chosen)
    return chosen


def assert_empty(df: DataFrame, condition: Column, *columns: str) -> DataFrame:
    """Rows that break an assertion: no row means it holds."""
    return df.filter(condition).select(*columns)


def gate_report(
    evaluated: DataFrame,
    executed_at,
    layers: Sequence[str],
    thresholds: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row with the report as a `json` document.

    The lists inside hold one entry per check, so their size is that of the suites.
    """
    thresholds = thresholds or rules.THRESHOLDS
    categories = list(thresholds)

    def order(column: str, names: Sequence[str]) -> Column:
        return F.array_position(F.array(*[F.lit(n) for n in names]), F.col(column))

    place = F.struct(order("category", categories), order("layer", layers), "table", "position")
    failures = F.collect_list(
        F.when(~F.col("passed"), F.struct(place.alias("place"), F.col("message")))
    )
    entry = F.struct("check", "total", "failed", "rate")

    def details(layer: str, category: str) -> Column:
        mine = (F.col("layer") == layer) & (F.col("category") == category)
        listed = F.collect_list(F.when(mine, F.struct(place.alias("place"), entry.alias("entry"))))
        return F.sort_array(listed)["entry"]

    return evaluated.agg(
        failures.alias("_failures"),
        *[details(la, c).alias(f"_{la}_{c}") for la in layers for c in categories],
    ).select(
        F.to_json(
            F.struct(
                F.lit(str(executed_at)).alias("executed_at"),
                F.struct(*[F.lit(float(t)).alias(c) for c, t in thresholds.items()]).alias(
                    "thresholds"
                ),
                (F.size("_failures") == 0).alias("passed"),
                F.sort_array("_failures")["message"].alias("failures"),
                F.struct(
                    *[
                        F.struct(*[F.col(f"_{la}_{c}").alias(c) for c in categories]).alias(la)
                        for la in layers
                    ]
                ).alias("details"),
            )
        ).alias("json")
    )


class QualityGateError(RuntimeError):
    """The gate found a check above its threshold."""


def enforce(evaluated: DataFrame) -> None:
    """Raise with one line per failed check. Reads at most one row per check to the driver."""
    rows = evaluated.filter(~F.col("passed")).orderBy("layer", "table", "position").collect()
    if rows:
        lines = "\n".join(f"  - {row['message']}" for row in rows)
        raise QualityGateError(f"quality gate failed\n{lines}")
