"""Training and scoring of the churn model on the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.operators.evaluation import stratified_split
from marlstone.plans.features import latest_snapshot

# Settings of the model.
TREES, LEARNING_RATE, DEPTH, SEED, TRAIN_SHARE = 200, 0.05, 4, 42, 0.8
CLASS_NAMES = {0: "Ativo", 1: "Churn"}


def training_columns(leak_free: bool = True) -> tuple[str, ...]:
    """The model inputs. Two of the full set give the label away; `leak_free` leaves them out."""
    dropped = rules.LEAKING_FEATURES if leak_free else ()
    return tuple(c for c in rules.CHURN_FEATURES if c not in dropped)


def training_set(
    features: DataFrame, inputs: Sequence[str], seed: int = SEED, train_share: float = TRAIN_SHARE
) -> DataFrame:
    """Latest snapshot with key, inputs, label and the `is_train` mark."""
    chosen = latest_snapshot(features).select(
        "customer_id", *[F.col(c).cast("double").alias(c) for c in inputs], rules.CHURN_LABEL
    )
    return stratified_split(chosen, "customer_id", rules.CHURN_LABEL, train_share, seed)


def train(
    marked: DataFrame,
    inputs: Sequence[str],
    *,
    trees: int = TREES,
    learning_rate: float = LEARNING_RATE,
    depth: int = DEPTH,
    seed: int = SEED,
) -> PipelineModel:
    """Gradient-boosted trees on the rows marked `is_train`."""
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="inputs")
    booster = GBTClassifier(
        featuresCol="inputs",
        labelCol=rules.CHURN_LABEL,
        maxIter=trees,
        stepSize=learning_rate,
        maxDepth=depth,
        seed=seed,
    )
    return Pipeline(stages=[assembler, booster]).fit(marked.filter("is_train"))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predicted class and churn probability per customer."""
    return model.transform(rows).select(
        "customer_id",
        rules.CHURN_LABEL,
        F.col("prediction").cast("int").alias("predicted"),
        vector_to_array("probability")[1].alias("churn_probability"),
    )


def feature_importances(model: PipelineModel, df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Inputs by importance, the most important first. One row per input."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(
        list(zip(inputs, weights, strict=True)), "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")
