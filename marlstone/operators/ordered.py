"""Exact global order statistics without sorting all rows in one task.

Ranks, quantiles and ROC areas all come from one step: equal values are counted first, then the
distinct values are cut into ranges of similar size, and the counts are summed up in value order,
first over the ranges, then inside each range. A value that a third of all rows share is a single
counted value here.

There are as many ranges as the session has shuffle partitions, so tasks stay of one size however
large the cluster. Their limits come from a mergeable rank summary (`percentile_approx`): every task
sums up its values, and the summaries, of bounded size, are merged. They are computed once in a query
and found by binary search, so a task that is run again puts every value into the same range.
Results do not depend on where the limits lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Summary entries kept per range.
_ACCURACY = 32


def value_counts(
    df: DataFrame, value: str, by: str | None = None, **measures: Column
) -> DataFrame:
    """One row per distinct value (NULL is one): `n` rows, plus sums of any extra measures."""
    keys = [value] if by is None else [by, value]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(measure).alias(name) for name, measure in measures.items()],
    )


def running_totals(
    counted: DataFrame,
    value: str,
    measures: Sequence[str] = ("n",),
    by: str | None = None,
    ranges: int | None = None,
    range_of: Column | None = None,
) -> DataFrame:
    """Add `<measure>_before`, the sum over all smaller values, and `<measure>_total`.

    `counted` holds one row per value (per value and `by`). NULL counts as smaller than any value.
    `by`, if given, is a column with few values such as a label: the range limits of every group
    are held in one map. `ranges` defaults to the shuffle partitions of the session. `range_of` replaces the computed ranges by an expression that grows with
    the value.
    """
    if range_of is None:
        ranges = ranges or int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = _with_range(counted, value, measures, by, ranges)
    else:
        ranged = counted.withColumn("_range", range_of)
    group = [by] if by else []
    range_keys = [*group, "_range"]

    # At most ranges + 1 rows per group. The join below needs no broadcast: it shuffles by the keys
    # of the window after it.
    in_order = Window.partitionBy(*group).orderBy("_range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(*group)
    sums = ranged.groupBy(*range_keys).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    offsets = sums.select(
        *range_keys,
        *[F.coalesce(F.sum(f"_{m}").over(earlier), F.lit(0)).alias(f"_{m}_offset") for m in measures],
        *[F.sum(f"_{m}").over(everywhere).alias(f"{m}_total") for m in measures],
    )

    smaller = (
        Window.partitionBy(*range_keys)
        .orderBy(F.asc_nulls_first(value))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return ranged.join(offsets, range_keys).select(
        *counted.columns,
        *[
            (F.col(f"_{m}_offset") + F.coalesce(F.sum(m).over(smaller), F.lit(0))).alias(
                f"{m}_before"
            )
            for m in measures
        ],
        *[f"{m}_total" for m in measures],
    )


def _with_range(
    counted: DataFrame, value: str, measures: Sequence[str], by: str | None, ranges: int
) -> DataFrame:
    """Add `_range`, the number of quantile limits below the value; -1 for NULL."""
    steps = [i / ranges for i in range(1, ranges)]
    if not steps:
        return counted.withColumn("_range", F.when(F.col(value).isNull(), -1).otherwise(0))
    # Keeping a measure in the plan makes this the same shuffle as that of the totals: it is
    # computed once and reused.
    known = counted.filter(F.col(measures[0]) >= 0)
    limits = F.percentile_approx(value, steps, max(4096, _ACCURACY * ranges))
    if by is None:
        found = known.agg(limits).scalar()
    else:
        per_group = known.groupBy(by).agg(limits.alias("_limits"))
        found = F.try_element_at(
            per_group.agg(F.map_from_entries(F.collect_list(F.struct(by, "_limits")))).scalar(),
            F.col(by),
        )
    placed = _with_numbers_below(counted.withColumn("_limits", found), "_limits", value, len(steps))
    # The range is never NULL, with or without limits. Otherwise the join on it would put a null
    # test of this expression below the counting, on every row.
    placed = placed.withColumn("_range", F.when(F.col(value).isNull(), -1).otherwise(F.col("_below")))
    return placed.drop("_limits", "_below")


def _with_numbers_below(df: DataFrame, limits: str, value: str, most: int) -> DataFrame:
    """Add `_below`: how many of the ascending limits, `most` at the utmost, lie below the value.

    Binary search: each step tries to go ahead by half as much as the one before. Each is a
    projection of its own, so that the place is computed once and not once per use.
    """
    df = df.withColumn("_below", F.lit(0))
    for step in [2**i for i in reversed(range(most.bit_length()))]:
        place = F.col("_below") + step
        lower = F.coalesce(F.try_element_at(F.col(limits), place) < F.col(value), F.lit(False))
        df = df.withColumn("_below", F.when(lower, place).otherwise(F.col("_below")))
    return df


def percent_rank_of(
    before: Column, same: Column, total: Column, ascending: bool = True
) -> Column:
    """Percent rank from counts: rows ahead / (rows - 1), 0.0 for a single row.

    Descending order puts NULL last, ascending order puts it first.
    """
    ahead = before if ascending else total - before - same
    return F.when(total > 1, ahead / (total - 1)).otherwise(F.lit(0.0))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], type: str = "double"
) -> DataFrame:
    """Linear-interpolation quantiles per column: rows (column, probability, quantile).

    All columns share one pass; NULL values are left out.
    """
    long = df.unpivot([], [F.col(c).cast(type).alias(c) for c in columns], "column", "value")
    counted = value_counts(long.filter(F.col("value").isNotNull()), "value", by="column")
    placed = running_totals(counted, "value", by="column")

    def covers(place: Column) -> Column:
        return (F.col("n_before") <= place) & (place < F.col("n_before") + F.col("n"))

    def around(probability: Column) -> tuple[Column, Column, Column]:
        position = probability * (F.col("n_total") - 1)
        return position, covers(F.floor(position)), covers(F.ceil(position))

    def is_near(probability: Column) -> Column:
        _, at_or_below, at_or_above = around(probability)
        return at_or_below | at_or_above

    # Hardly any value lies at a quantile; those that do not are not repeated per probability.
    near = F.filter(F.array(*[F.lit(float(p)) for p in probabilities]), is_near)
    position, at_or_below, at_or_above = around(F.col("probability"))
    lower = F.max(F.when(at_or_below, F.col("value")))
    upper = F.max(F.when(at_or_above, F.col("value")))
    share = F.max(position - F.floor(position))
    return (
        placed.select("*", F.explode(near).alias("probability"))
        .groupBy("column", "probability")
        .agg((lower + (upper - lower) * share).alias("quantile"))
    )
