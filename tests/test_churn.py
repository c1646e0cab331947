import pytest
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.plans import churn


@pytest.fixture(scope="module")
def marked(spark):
    hashed = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    label = ((F.col("id") % 5 == 0) | (hashed > 0.9)).cast("int")
    df = spark.range(400).select(
        F.col("id").alias("customer_id"),
        *[
            (F.when(label == 1, 50).otherwise(5) + hashed if c == "orders" else hashed).alias(c)
            for c in rules.CHURN_FEATURES
        ],
        label.alias(rules.CHURN_LABEL),
        F.lit(1).alias("feature_extraction_ts"),
    )
    inputs = churn.training_columns()
    return churn.training_set(df, inputs).cache()


def test_columns():
    assert len(churn.training_columns(leak_free=False)) == 11
    assert not set(churn.training_columns()) & set(rules.LEAKING_FEATURES)


def test_train_score_and_importances(marked):
    inputs = churn.training_columns()
    model = churn.train(marked, inputs, trees=3)
    scored = churn.score(model, marked.filter(~F.col("is_train")))
    assert scored.columns == ["customer_id", "churn_label", "predicted", "churn_probability"]
    assert scored.count() == marked.filter("not is_train").count()
    wrong = scored.filter(F.col("predicted") != F.col("churn_label")).count()
    assert wrong == 0
    top = churn.feature_importances(model, marked, inputs).collect()
    assert top[0].feature == "orders" and sum(r.importance for r in top) == pytest.approx(1.0)
    assert len(top) == len(inputs)
