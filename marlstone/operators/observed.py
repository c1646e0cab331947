"""Counts taken by the job that writes a table, so that they cost no scan of their own.

The counts are Spark's observed metrics. They are exact where the observed frame is written without
a shuffle in between: a task of the writing stage counts once, however often it is tried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from marlstone.operators.quality import Check, row_check_counts
from marlstone.operators.validity import reject_count_columns


class Watch:
    """Counts to take while a frame is written: `frame = watch.on(frame)`, write, `watch.row(spark)`."""

    def __init__(self, counts: Sequence[Column]):
        self.counts = list(counts)
        self.seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *self.counts)

    def row(self, spark: SparkSession) -> DataFrame:
        """The counts as a frame of one row; waits for the writing job."""
        found = self.seen.get
        schema = ", ".join(f"`{name}` bigint" for name in found)
        return spark.createDataFrame([tuple(found.values())], schema)


def watch_rejects(named: dict[str, Column] | None = None) -> Watch:
    """The counts of `validity.reject_counts`."""
    return Watch(reject_count_columns(named))


def watch_checks(df: DataFrame, checks: Sequence[Check]) -> Watch:
    """What `quality.run_checks` takes as `counted`: the row checks of `df`."""
    return Watch(row_check_counts(df, checks))
