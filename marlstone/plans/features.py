"""The per-customer feature table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.operators.customers import preferred_channel_ties, with_churn_label
from marlstone.operators.ranking import RFM, percent_ranks, rfm_score
from marlstone.plans.history import customer_base
from marlstone.sources.scratch import written

FEATURES = (
    "customer_id",
    "customer_segment",
    "customer_state",
    "orders",
    "orders_per_month",
    "orders_per_month_6m",
    "total_revenue",
    "ticket_mean",
    "ticket_max",
    "ticket_min",
    "category_count",
    "preferred_channel",
    "cancel_rate",
    "high_value_orders",
    "days_since_purchase",
    "rfm_score",
    "churn_label",
    "feature_extraction_ts",
)

def customer_features(
    enriched: DataFrame,
    as_of: date,
    *,
    extracted_at=None,
    months: int = rules.TRAILING_MONTHS,
    churn_after_days: int = rules.CHURN_AFTER_DAYS,
    all_tied_channels: bool = False,
    base: DataFrame | None = None,
) -> DataFrame:
    """The feature table with RFM score and churn label.

    `base` is the per-customer history if it was folded already, from stored cells say.

    The per-customer base is written to the shared folder first, because the ranks compare every
    customer with all others and would otherwise compute the sales history several times over.
    `all_tied_channels` keeps one row per preferred channel where several tie; ranks then count
    such customers as often as they appear.
    """
    base = customer_base(enriched, as_of, months) if base is None else base
    if all_tied_channels:
        base = base.drop("preferred_channel").join(
            preferred_channel_ties(enriched), "customer_id", "left"
        )
    base = written(base, "customer-base")
    ranked = base.join(percent_ranks(base, "customer_id", RFM), "customer_id", "left")
    labelled = with_churn_label(rfm_score(ranked), churn_after_days)
    stamp = F.current_timestamp() if extracted_at is None else F.lit(extracted_at)
    return labelled.withColumn("feature_extraction_ts", stamp).select(*FEATURES)


def latest_snapshot(features: DataFrame, column: str = "feature_extraction_ts") -> DataFrame:
    """Rows of the most recent extraction."""
    return features.filter(F.col(column) == features.agg(F.max(column)).scalar())
