"""Text quality by a factorisation machine.

Features are hashed words, structure statistics of the text (each cut into steps, one feature a
step) and its stated length. Every feature has a weight and a short vector; the score adds the
weights and all pairwise products of the vectors, which takes linear time as half the difference
between the square of the sum and the sum of the squares.

The machine is fitted on a bounded sample of labelled rows; all rows are scored. Defined results:
null and empty texts are scored from their statistics; without labelled rows every score is 0.5;
with one label only, it is the smoothed share of that label. Repeated rows get equal scores,
columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlstone.llm.arrays import Texts, Words, chunks, shingles
from marlstone.llm.language import remainder

# Labelled rows (expected number) that the machine is fitted on; all, if there are fewer.
ROWS = 12_000
WORD_BUCKETS = 1 << 15
STEPS = 64
FACTORS = 8
PREDICTED_FROM = 0.7
_CLASSES = np.zeros((7, 256), bool)
_CLASSES[0, 65:91] = True  # capitals
_CLASSES[1, 48:58] = True  # digits
_CLASSES[2, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True  # marks
_CLASSES[2, [44, 46]] = False
_CLASSES[3, [44, 46]] = True  # stops
_CLASSES[4, 10] = True  # line ends
_CLASSES[5, 128:] = True  # beyond ASCII
_CLASSES[6, 124] = True  # column bars
_STATISTICS = len(_CLASSES) + 7
FEATURES = WORD_BUCKETS + _STATISTICS * STEPS


def features(texts: Texts, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, value, first of each row and the end)."""
    rows = len(texts)
    size = np.diff(texts.starts)
    lower = texts.lower()
    words = Words(lower)
    count = np.diff(words.first)
    distinct, first = shingles(words, rows, 1)
    _, first_pair = shingles(words, rows, 2)

    def per_row(mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[starts[1:]] - total[starts[:-1]]

    share = [per_row(c[texts.data], texts.starts) / np.maximum(size, 1) for c in _CLASSES]
    again = np.zeros(len(lower.data), bool)
    again[1:] = lower.data[1:] == lower.data[:-1]
    share.append(per_row(again, texts.starts) / np.maximum(size, 1))
    follows = np.zeros(len(words.hash), bool)
    follows[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    share.append(per_row(follows, words.first) / np.maximum(count, 1))
    share.append(np.diff(first) / np.maximum(count, 1))
    share.append(np.diff(first_pair) / np.maximum(count - 1, 1))
    steps = [np.minimum(40 * np.sqrt(s), STEPS - 1) for s in share]
    letters = per_row(np.ones(len(words.hash), bool) * (words.end - words.start), words.first)
    steps.append(np.minimum(4 * letters / np.maximum(count, 1), STEPS - 1))
    steps += [np.minimum(3 * np.log2(1 + np.maximum(n, 0)), STEPS - 1) for n in (size, lengths)]
    fixed = np.stack([WORD_BUCKETS + i * STEPS + s.astype(np.int64) for i, s in enumerate(steps)], 1)

    n = np.diff(first)
    out_first = np.concatenate([[0], np.cumsum(n + _STATISTICS)])
    feature, value = np.empty(out_first[-1], np.int64), np.ones(out_first[-1], np.float32)
    at = (out_first[:-1, None] + np.arange(_STATISTICS)).ravel()
    feature[at] = fixed.ravel()
    is_word = np.ones(len(feature), bool)
    is_word[at] = False
    feature[is_word] = (distinct % np.uint64(WORD_BUCKETS)).astype(np.int64)
    value[is_word] = np.repeat(1 / np.sqrt(np.maximum(n, 1)), n)
    return feature, value, out_first


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, feature: np.ndarray, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score before the logistic, the vectors times their values, and their sums per row."""
        vector = self.factor[feature] * value[:, None]
        total = np.add.reduceat(vector, first[:-1], axis=0)
        square = np.add.reduceat((vector * vector).sum(1), first[:-1])
        linear = np.add.reduceat(self.weight[feature] * value, first[:-1])
        return self.bias + linear + ((total * total).sum(1) - square) / 2, vector, total

    def score(self, feature: np.ndarray, value: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(feature, value, first)[0], -30, 30)))


def train(feature: np.ndarray, value: np.ndarray, first: np.ndarray, label: np.ndarray, epochs: int = 8, batch: int = 128) -> Machine:
    """Adaptive gradient descent on the logistic loss, in the order given."""
    share = (label.sum() + 1) / (len(label) + 2)
    rng = np.random.default_rng(0)
    machine = Machine(
        float(np.log(share / (1 - share))), np.zeros(FEATURES, np.float32), rng.normal(0, 0.05, (FEATURES, FACTORS)).astype(np.float32)
    )
    if label.min() == label.max():
        machine.factor[:] = 0
        return machine
    seen_w, seen_v = np.full(FEATURES, 1e-2, np.float32), np.full((FEATURES, FACTORS), 1e-2, np.float32)
    rate, decay = 0.1, 1e-5
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for rows in np.split(order, range(batch, len(order), batch)):
            n = first[rows + 1] - first[rows]
            at = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            f, x, begin = feature[at], value[at], np.concatenate([[0], np.cumsum(n)])
            raw, vector, total = machine.raw(f, x, begin)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[rows]) / len(rows) * 8
            slope = np.repeat(error, n) * x
            by = np.argsort(f, kind="stable")
            used, start = np.unique(f[by], return_index=True)
            g_w = np.add.reduceat(slope[by], start) + decay * machine.weight[used]
            g_v = np.add.reduceat((slope[:, None] * (np.repeat(total, n, axis=0) - vector))[by], start, axis=0)
            g_v += decay * machine.factor[used]
            seen_w[used] += g_w**2
            seen_v[used] += g_v**2
            machine.weight[used] -= rate * g_w / np.sqrt(seen_w[used])
            machine.factor[used] -= rate / 2 * g_v / np.sqrt(seen_v[used])
    return machine


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, length: str, label: Column, rows: int = ROWS) -> Machine | None:
    """Fit on about `rows` labelled rows, those with the smallest hash of the key; None without any."""
    labelled = labels.select(F.col(key), label.cast("int").alias("label")).dropna().groupBy(key).agg(F.max("label").alias("label"))
    known = labelled.count()
    if not known:
        return None
    place = F.pmod(F.xxhash64(key, F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    # About `rows` keys and labels: small by that bound.
    chosen = F.broadcast(labelled.filter(place < rows / known))
    given = docs.select(key, F.col(text).alias("text"), F.col(length).cast("double").alias("length")).join(chosen, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks(whole, "text")):
            feature, value, first = features(Texts.of(batch.column("text")), _lengths(batch.column("length")))
            offsets = pa.array(first.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(a)) for a in (feature.astype(np.int32), value)]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("label"), *lists], [key, "label", "feature", "value"])

    kind = docs.schema[key].dataType.simpleString()
    sample = given.select(key, "text", "length", "label").mapInArrow(run, f"{key} {kind}, label int, feature array<int>, value array<float>")
    table = sample.toArrow().combine_chunks()
    if not table.num_rows:
        return None
    table = table.take(pa.compute.sort_indices(table, [(key, "ascending")]))
    lists = table.column("feature").combine_chunks()
    first = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))])
    feature = lists.flatten().to_numpy().astype(np.int64)
    value = table.column("value").combine_chunks().flatten().to_numpy()
    return train(feature, value, first, table.column("label").to_numpy().astype(float))


def _lengths(column: pa.Array) -> np.ndarray:
    return np.nan_to_num(pa.compute.fill_null(column, 0.0).to_numpy(zero_copy_only=False), nan=0.0, posinf=0.0, neginf=0.0)


def rate(docs: DataFrame, machine: Machine | None, text: str = "text", length: str = "n_chars") -> DataFrame:
    """Add score and predicted to every row."""
    docs = docs.drop("score", "predicted")
    if machine is None:
        return docs.withColumns({"score": F.lit(0.5), "predicted": F.lit(0)})
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks(whole, text)):
            lengths = _lengths(batch.column(length).cast(pa.float64()))
            score = shared.value.score(*features(Texts.of(batch.column(text)), lengths)).astype(float)
            columns = [*batch.columns, pa.array(score), pa.array((score >= PREDICTED_FROM).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *StructType.fromDDL("score double, predicted int").fields]))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out)
    machine = fit(docs, labels, "doc_id", "text", "n_chars", F.col("quality"))
    return rate(docs.withColumn("held_out", held_out), machine).select("doc_id", "held_out", "score", "predicted")
