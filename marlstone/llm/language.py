"""Language identification with error-correcting output codes.

Every language gets a codeword. One binary n-gram classifier per code bit tells the languages whose
bit is set from the others; a document's language is the codeword with the smallest weighted
logistic loss against the classifiers' outputs. Distances between codewords let some classifiers be
wrong without harm, and a close second codeword flags an ambiguous document.

Texts pass through a task in pieces of bounded size, and their n-grams order by order, so that a
piece takes some tens of megabytes at most. Only text goes to the Python workers, and only the
decision comes back; the other columns stay where they are.

Defined results: null text and text without a letter is `und` with score 0; without any labelled
row everything is `und`. Rows are never dropped, repeated rows get equal results. `identify` replaces
columns that are named like its results, `decided` leaves all columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import chunks

BUCKETS_LOG2 = 15
ORDERS = 3
# Labelled rows per language that the classifiers are fitted on (expected; all, if there are fewer).
ROWS_PER_LANGUAGE = 8_000
UNDETERMINED = "und"
# A document whose best codeword has less than this share of the soft decision is ambiguous.
AMBIGUOUS_BELOW = 0.5
_SHARPNESS = 4.0
# Bytes of text that are looked at together.
_PIECE = 1 << 16
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_letters: list[np.ndarray] = []
_DECISION = "lang_pred string, score double, ambiguous boolean"


def codewords(languages: int) -> np.ndarray:
    """Rows of +1 and -1: all splits of the languages up to 7 of them, spread-out ones beyond."""
    if languages <= 7:
        bits = max(1, 2 ** (languages - 1) - 1)
        split = np.arange(1, bits + 1)[None, :] >> np.arange(languages)[:, None] & 1
        return np.where(split == 1, 1, -1)
    bits = int(np.ceil(10 * np.log2(languages)))
    best = max(
        (np.random.default_rng(seed).choice([-1, 1], (languages, bits)) for seed in range(50)),
        key=lambda code: min((a != b).sum() for i, a in enumerate(code) for b in code[:i]),
    )
    return best[:, np.abs(best.sum(0)) < languages]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # bits x buckets, log-odds of an n-gram
    trust: np.ndarray  # per bit, from its accuracy on the fitted rows

    def outputs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-odds per bit, and the number of letters."""
        orders, letters = ngrams(texts)
        sums = np.zeros((len(texts), self.code.shape[1]))
        grams = np.zeros(len(texts), np.int64)
        for bucket, row in orders:
            grams += np.bincount(row, minlength=len(texts))
            for bit in range(self.code.shape[1]):
                sums[:, bit] += np.bincount(row, self.weights[bit, bucket], len(texts))
        return sums / np.maximum(grams, 1)[:, None], letters

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score per text."""
        outputs, letters = self.outputs(texts)
        margins = outputs[:, None, :] * self.code[None] * _SHARPNESS
        loss = (np.logaddexp(0, -margins) * self.trust).sum(2)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = loss.argmin(1)
        known = letters > 0
        names = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        return names, np.where(known, share.max(1), 0.0)


def ngrams(texts: list[str | None]) -> tuple[Iterator[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order (bucket, row) of all 1-, 2- and 3-grams of lower-cased letters; letters per row.

    A run of other characters counts as one gap between words, and so does the start of a text.
    """
    if not _letters:
        _letters.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000))
    lowered = [" " + (t or "").lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    is_letter = _letters[0][points]
    letters = np.bincount(doc[is_letter], minlength=len(texts))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[1:] |= doc[1:] != doc[:-1]
    keep[:1] = True
    doc = doc[keep]
    letter = np.where(is_letter, points, np.uint32(0))[keep]
    return _orders(letter, doc), letters


def _orders(letter: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    value = np.zeros(len(letter), np.uint32)
    shift = np.uint32(32 - BUCKETS_LOG2)
    for n in range(min(ORDERS, len(letter))):
        value = value[: len(letter) - n] * _MULTIPLIERS[1] + (letter[n:] + np.uint32(n + 1)) * _MULTIPLIERS[0]
        mixed = value ^ value >> np.uint32(15)
        inside = doc[: len(letter) - n] == doc[n:] if n else letter > 0
        yield (mixed * _MULTIPLIERS[2] >> shift)[inside], doc[: len(letter) - n][inside]


def fit(labelled: DataFrame, text: str, lang: str, key: Column, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """Fit the classifiers on rows with a language; None if there is none.

    Of each language about `rows_per_language` rows are used, those with the smallest hash of `key`
    of all its rows; what reaches the driver is one count per language and n-gram bucket.
    """
    labelled = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, rows_per_language / counts[k]))])
    place = F.pmod(F.xxhash64(key, F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(place < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in (piece for whole in batches for piece in chunks(whole, "text", _PIECE)):
            names = np.array(batch.column("lang").to_pylist(), object)
            for bucket, row in ngrams(batch.column("text").to_pylist())[0]:
                for name in set(names):
                    own = bucket[(names == name)[row]]
                    found[name] = found.get(name, 0) + np.bincount(own, minlength=1 << BUCKETS_LOG2)
        for name, total in found.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(at), "bucket": at, "n": total[at]})

    counted = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n"))
    table = np.zeros((len(languages), 1 << BUCKETS_LOG2))
    for name, bucket, n in counted.toLocalIterator():
        table[languages.index(name), bucket] = n
    code = codewords(len(languages))
    model = Model(languages, code, _log_odds(table, code), np.ones(code.shape[1]))

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks(whole, "text", _PIECE)):
            outputs, letters = model.outputs(batch.column("text").to_pylist())
            truth = code[[languages.index(x) for x in batch.column("lang").to_pylist()]]
            hits = ((outputs * truth > 0) & (letters > 0)[:, None]).sum(0)
            yield pa.RecordBatch.from_pydict({"bit": np.arange(code.shape[1]), "hits": hits, "n": np.full(code.shape[1], (letters > 0).sum())})

    accuracy = sample.mapInArrow(right, "bit long, hits long, n long").groupBy("bit").agg(F.sum("hits"), F.sum("n"))
    for bit, hits, n in accuracy.collect():
        # Log-odds of the bit being right, at most about 5; never negative.
        model.trust[bit] = max(0.05, np.log((hits + 1) / (n - hits + 1 + 0.005 * n)))
    model.trust /= model.trust.mean()
    return model


def _log_odds(table: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Every language weighs the same, whatever its number of rows."""
    table = (table + 0.01) / (table + 0.01).sum(1, keepdims=True)
    weights = []
    for bit in code.T:
        if (bit == bit[0]).all():
            weights.append(np.full(table.shape[1], float(bit[0])))
        else:
            floor = 1e-7
            weights.append(np.log(table[bit > 0].mean(0) + floor) - np.log(table[bit < 0].mean(0) + floor))
    return np.stack(weights).astype(np.float32)


def decided(docs: DataFrame, model: Model | None, text: str = "text") -> Column:
    """A struct (lang_pred, score, ambiguous) for every row."""
    if model is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_DECISION)
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = [], []
            for piece in chunks(pa.record_batch([texts], ["text"]), "text", _PIECE):
                name, score = shared.value.decide(piece.column("text").to_pylist())
                names += name
                scores.append(score)
            score = np.concatenate(scores or [np.zeros(0)])
            columns = [pa.array(names, pa.string()), pa.array(score), pa.array(score < AMBIGUOUS_BELOW)]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score", "ambiguous"])

    return decide(F.col(text))


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add lang_pred, score and ambiguous to every row."""
    docs = docs.drop("lang_pred", "score", "ambiguous")
    return docs.select("*", decided(docs, model, text).alias("_decision")).select(*docs.columns, "_decision.*")


def remainder(key: str, by: int) -> Column:
    """crc32 of the key as text, modulo `by`."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % by


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = fit(docs.filter(~held_out), "text", "lang", F.col("doc_id"))
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")
