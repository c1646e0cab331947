"""Summary statistics, splits and classifier metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators.ordered import exact_quantiles, running_totals, value_counts


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, mean, std, min, quartiles (interpolated) and max of the values present.

    The moments take one pass. The quartiles are exact and found by counting, not by collecting
    the values.
    """
    moments = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    ).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), f"{c}.*") for c in columns])))
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))

    def at(probability: float) -> Column:
        return F.max(F.when(F.col("probability") == probability, F.col("quantile")))

    wide = quartiles.groupBy("column").agg(
        at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75")
    )
    return moments.join(wide, "column", "left")


def label_rate(df: DataFrame, label: str) -> DataFrame:
    """Rows, and the mean of a 0/1 label."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("label_rate"))


def stratified_split(
    df: DataFrame, key: str, label: str, train_share: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add `is_train`: exactly round(train_share * rows) rows of every label value, for unique keys.

    Which rows is decided by a hash of seed and key, so a rerun splits alike; rows of equal keys go
    together. The hash cuts the rows of a label into as many even ranges as there are partitions.
    A row's place is the number of rows in the ranges before its own and before it in its own; only
    the counts of the ranges are joined to the rows.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(seed), F.col(key))))
    # A missing label is a label of its own.
    hashed = hashed.withColumn("_label", F.coalesce(F.col(label).cast("string"), F.lit("\0")))
    # The first 32 bits of the hash, spread evenly over the ranges.
    leading = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint")
    ranged = hashed.withColumn("_range", F.floor(leading * ranges / 2**32))
    in_order = Window.partitionBy("_label").orderBy("_range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_label", "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_label",
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy("_label")).alias("_total"),
    )
    within = F.rank().over(Window.partitionBy("_label", "_range").orderBy("_hash")) - 1
    placed = ranged.join(offsets, ["_label", "_range"])
    is_train = F.col("_offset") + within < F.round(F.col("_total") * train_share)
    return placed.withColumn("is_train", is_train).drop("_hash", "_label", "_range", "_offset", "_total")


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_report(
    df: DataFrame, label: str, prediction: str, names: Mapping[int, str]
) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted mean.

    A measure without a denominator is 0. Classes without a name go by their number. Beyond the confusion counts, everything works on one row
    per class.
    """
    named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    values = F.concat(F.array(*[F.lit(c) for c in names]), F.array("label", "prediction"))
    values = F.array_distinct(F.array_compact(values))
    classes = F.transform(
        values,
        lambda v: F.struct(
            v.alias("value"), F.coalesce(F.try_element_at(named, v), v.cast("string")).alias("name")
        ),
    )
    cells = confusion(df, label, prediction).select("*", F.explode(classes).alias("class"))
    actual, predicted = F.col("label") == F.col("class.value"), F.col("prediction") == F.col("class.value")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    counts = cells.groupBy(F.col("class.name").alias("class")).agg(
        total(actual & predicted).alias("hit"),
        total(predicted).alias("predicted"),
        total(actual).alias("support"),
    )

    def share(part: str | Column, whole: str | Column) -> Column:
        return F.coalesce(F.try_divide(_double(part), _double(whole)), F.lit(0.0))

    per_class = counts.select(
        "class",
        share("hit", "predicted").alias("precision"),
        share("hit", "support").alias("recall"),
        # 2 hits over predicted + support is the harmonic mean of precision and recall.
        share(F.col("hit") * 2, F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "hit",
    )
    measures = ("precision", "recall", "f1")
    rows = F.sum("support")
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], rows.alias("support"))
    weighted = per_class.agg(
        *[share(F.sum(F.col(m) * F.col("support")), rows).alias(m) for m in measures],
        rows.alias("support"),
    )
    accuracy = per_class.agg(
        *[share(F.sum("hit"), rows).alias(m) for m in measures], rows.alias("support")
    )
    report = per_class.drop("hit")
    for name, part in (("accuracy", accuracy), ("macro avg", macro), ("weighted avg", weighted)):
        report = report.unionByName(part.withColumn("class", F.lit(name)))
    return report


def _double(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by ranks, equal scores counting half.

    NULL where one of the classes is missing.
    """
    wide = "decimal(38,0)"
    is_positive = (F.col(label) == 1).cast("bigint")
    counted = value_counts(
        df, score, positives=is_positive, negatives=1 - is_positive
    ).select(score, "positives", "negatives")
    placed = running_totals(counted, score, measures=("negatives",))
    # Twice the number of (positive, negative) pairs in the right order, ties counting once.
    pairs = F.sum(
        F.col("positives").cast("decimal(18,0)")
        * (F.col("negatives_before") * 2 + F.col("negatives")).cast("decimal(19,0)")
    )
    possible = F.sum("positives").cast("decimal(19,0)") * F.sum("negatives").cast("decimal(18,0)") * 2
    return placed.agg(
        F.sum("positives").alias("positives"),
        F.sum("negatives").alias("negatives"),
        F.try_divide(pairs.cast(wide).cast("double"), possible.cast(wide).cast("double")).alias(
            "roc_auc"
        ),
    )
