"""Percent ranks over a whole table and the RFM score made of them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.operators.joins import hot_of_counts, salted_left_join
from marlstone.operators.ordered import percent_rank_of, running_totals, value_counts


class RankSpec(NamedTuple):
    name: str
    column: str
    ascending: bool = True


# Few days since the last purchase, many orders and much revenue rank high.
RFM = (
    RankSpec("recency", "days_since_purchase", ascending=False),
    RankSpec("frequency", "orders"),
    RankSpec("monetary", "total_revenue"),
)


def percent_ranks(
    df: DataFrame, key: str, specs: tuple[RankSpec, ...], value_type: str = "decimal(38,6)"
) -> DataFrame:
    """One row per `key` with `<name>_rank`, equal to PERCENT_RANK() OVER (ORDER BY column).

    All ranks share one count of values. `value_type` must hold every ranked value exactly. Keys
    that appear in several rows of `df` count as often as they appear.
    """
    thin = df.unpivot(
        [key], [F.col(s.column).cast(value_type).alias(s.name) for s in specs], "_of", "_value"
    )
    # A struct is never NULL itself and equals another with the same NULL inside, so rows without
    # a value find their rank too.
    pair = F.struct("_of", "_value")
    counted = value_counts(thin, "_value", by="_of")
    ranked = running_totals(counted, "_value", by="_of").select(
        pair.alias("_pair"), "n", "n_before", "n_total"
    )
    found = salted_left_join(
        thin.select(key, "_of", pair.alias("_pair")),
        ranked,
        "_pair",
        hot_of_counts(counted.select(pair.alias("_pair"), "n"), "_pair", "n"),
        spread_by=F.col(key),
    )
    ascending = {s.name: s.ascending for s in specs}
    counts = (F.col("n_before"), F.col("n"), F.col("n_total"))
    return found.groupBy(key).agg(
        *[
            F.max(
                F.when(F.col("_of") == s.name, percent_rank_of(*counts, ascending[s.name]))
            ).alias(f"{s.name}_rank")
            for s in specs
        ]
    )


def rfm_score(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Add `rfm_score`, 0 to 100, from the three percent ranks."""
    weights = weights or rules.RFM_WEIGHTS
    score = sum(
        (F.col(f"{s.name}_rank") * 100 * weights[s.name] for s in RFM[1:]),
        F.col(f"{RFM[0].name}_rank") * 100 * weights[RFM[0].name],
    )
    return df.withColumn("rfm_score", F.round(score.cast("decimal(18,6)"), 2).cast("double"))
