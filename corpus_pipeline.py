"""The corpus pipeline: documents to packed training windows, in five stages.

Each stage takes (spark, docs, sf_dir), docs being what the stage before returned, written as
Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.llm import decontaminate, language, near_dedup, packing, private_data
from marlstone.llm.ship import ship
from marlstone.sources.scratch import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(docs: DataFrame) -> str:
    """A column name that docs does not have."""
    names = {c.lower() for c in docs.columns}
    return next(name for name in (f"_stage_{i}" for i in range(len(names) + 1)) if name not in names)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without letters and ambiguous ones go."""
    ship(spark)
    held_out = F.coalesce(language.remainder("doc_id", 3) == 1, F.lit(False))
    model = language.fit(docs.filter(~held_out), "text", "lang", F.col("doc_id"))
    told = _free(docs)
    decided = docs.withColumn(told, language.decided(docs, model))
    known = ~F.col(f"{told}.ambiguous") & (F.col(f"{told}.lang_pred") != language.UNDETERMINED)
    return decided.filter(known).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies: five-word shingles, similarity 0.8 or more.

    One row of that id stays, if it has several. Documents without an id, which have no copies, all
    stay.
    """
    ship(spark)
    kept = near_dedup.near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    place = _free(docs)
    # Which of them does not depend on the order of rows.
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.xxhash64(*docs.columns))
    numbered = docs.join(kept, "doc_id", "left_semi").withColumn(place, F.row_number().over(one))
    return numbered.filter(F.col(place) == 1).select(*docs.columns).union(docs.filter("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = _free(docs)
    return decontaminate.leaks(docs, items, into=found).filter(F.size(found) == 0).select(*docs.columns)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return private_data.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in windows."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_dedup", one_of_each),
    ("decontaminate", without_benchmark),
    ("private_data", without_private_data),
    ("packing", packed),
]

# Language models, near copies and tokens cannot be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
