"""Benchmark passages in documents, found by SimHash windows.

A document is cut into windows of as many words as an item has. Windows and items get 64-bit
SimHash fingerprints of their words; the fingerprint is split into one block more than the radius,
so that fingerprints within the radius agree in at least one block and are found by looking blocks
up. Candidates are then compared exactly: the weighted Jaccard similarity of their five-word
shingles, each counted as often as it occurs, must reach the threshold.

Only windows that hold a shingle of some item of their size are fingerprinted: any other window
has similarity 0. Items are handled in blocks of bounded size, each of which is sent to all tasks.

Defined results: null and empty texts have no leaks, and null or empty items leak nowhere. An item
of fewer than five words is one shingle, so it is found where exactly its words occur. A document
shorter than an item is compared as a whole. Repeated rows and items are each reported, the best window
(the first, in a tie) for each document and item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marlstone.llm.arrays import Texts, Words, chunks, mix, run_index

SHINGLE = 5
RADIUS = 16
PERCENT = 80
# Items sent to the tasks at once.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 32 << 20
_FILTER_BITS = 22
LEAKS = "array<struct<item_id:long,start_word:long,end_word:long,similarity:double>>"


def fingerprints(word_hash: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit SimHash of the words start .. end - 1 of each window; every occurrence counts."""
    bits = np.unpackbits(mix(word_hash).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(word_hash) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    ones = total[end] - total[start]
    return np.packbits(2 * ones > (end - start)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def block_masks(radius: int) -> list[tuple[np.uint64, np.uint64]]:
    """(shift, mask) of radius + 1 blocks of 64 bits, as even as can be."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(np.uint64(a), np.uint64((1 << b - a) - 1)) for a, b in zip(edges, edges[1:], strict=False)]


class Items:
    """A block of benchmark items with what is looked up in them."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        words = Words(Texts.of(pa.array(texts, pa.string())).lower())
        count = np.diff(words.first)
        used = np.flatnonzero(count)
        self.ids, self.size = np.array(ids, np.int64)[used], count[used]
        self.weights = []
        for row in used:
            own = words.hash[words.first[row] : words.first[row + 1]]
            self.weights.append(np.unique(_grams(own, min(SHINGLE, len(own))), return_counts=True))
        self.mark = fingerprints(words.hash, words.first[used], words.first[used + 1])
        # Distinct (gram length, gram, item size), by gram; and a bit table in front of them.
        gram = np.concatenate([w[0] for w in self.weights] or [np.zeros(0, np.uint64)])
        size = np.repeat(self.size, [len(w[0]) for w in self.weights])
        order = np.lexsort((size, gram))
        gram, size = gram[order], size[order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (size[1:] != size[:-1])
        self.gram, self.gram_size = gram[fresh], size[fresh]
        self.table = np.zeros(1 << _FILTER_BITS, bool)
        self.table[self.gram & np.uint64(len(self.table) - 1)] = True
        self.lengths = sorted({min(SHINGLE, int(n)) for n in self.size})
        self.blocks = []
        for shift, mask in block_masks(RADIUS):
            value = self.size.astype(np.uint64) << np.uint64(32) | self.mark >> shift & mask
            order = np.argsort(value, kind="stable")
            self.blocks.append((shift, mask, value[order], order))

    def find(self, texts: Texts) -> list[list[dict]]:
        """Leaks of every row."""
        words = Words(texts.lower())
        windows = self._windows(words)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        if not len(windows[0]):
            return out
        start, end, size = windows
        # Fingerprints of the rows that have windows, and of no others.
        rows = np.unique(words.doc[start])
        length = words.first[rows + 1] - words.first[rows]
        near = np.repeat(words.first[rows] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        shift = np.searchsorted(near, start) - start
        mark = fingerprints(words.hash[near], start + shift, end + shift)
        window, item = self._within(mark, size)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for w, i in zip(window.tolist(), item.tolist(), strict=True):
            if w not in grams:
                own = words.hash[start[w] : end[w]]
                grams[w] = np.unique(_grams(own, min(SHINGLE, len(own))), return_counts=True)
            similarity = _weighted_jaccard(grams[w], self.weights[i])
            if 100 * similarity >= PERCENT:
                key = (int(words.doc[start[w]]), i)
                best[key] = max(best.get(key, (0.0, 0, 0)), (similarity, -int(start[w]), int(end[w])))
        for (row, i), (similarity, begin, stop) in sorted(best.items()):
            first = int(words.first[row])
            out[row].append(
                {"item_id": int(self.ids[i]), "start_word": -begin - first, "end_word": stop - first, "similarity": similarity}
            )
        return out

    def _windows(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, item size) of the windows that hold a shingle of an item of that size."""
        starts, sizes = [], []
        for k in self.lengths:
            gram, at = words.grams(k)
            hit = self.table[gram & np.uint64(len(self.table) - 1)]
            gram, at = gram[hit], at[hit]
            low, high = (np.searchsorted(self.gram, gram, side) for side in ("left", "right"))
            n = high - low
            size = self.gram_size[np.repeat(low, n) + run_index(n)]
            at = np.repeat(at, n)
            fits = np.minimum(size, SHINGLE) == k
            size, at = size[fits], at[fits]
            span = size - k + 1
            starts.append(np.repeat(at - size + k, span) + run_index(span))
            sizes.append(np.repeat(size, span))
            # The row of a window is that of the shingle it holds.
            owner = np.repeat(words.doc[at], span)
            first, last = words.first[owner], words.first[owner + 1]
            starts[-1] = np.maximum(first, np.minimum(starts[-1], last - sizes[-1]))
        if not starts:
            return (np.zeros(0, np.int64),) * 3
        both = np.unique(np.concatenate(starts) << 24 | np.minimum(np.concatenate(sizes), (1 << 24) - 1))
        start, size = both >> 24, both & (1 << 24) - 1
        return start, np.minimum(start + size, words.first[words.doc[start] + 1]) if len(start) else start, size

    def _within(self, mark: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of one size whose fingerprints differ in at most RADIUS bits."""
        pairs = []
        for shift, mask, value, order in self.blocks:
            own = size.astype(np.uint64) << np.uint64(32) | mark >> shift & mask
            low, high = (np.searchsorted(value, own, side) for side in ("left", "right"))
            n = high - low
            item = order[np.repeat(low, n) + run_index(n)]
            window = np.repeat(np.arange(len(mark)), n)
            close = np.bitwise_count(mark[window] ^ self.mark[item]) <= RADIUS
            pairs.append(np.unique(window[close] << 32 | item[close]))
        both = np.unique(np.concatenate(pairs))
        return both >> 32, both & 0xFFFFFFFF


def _grams(own: np.ndarray, k: int) -> np.ndarray:
    """The same hashes as `Words.grams`, of one run of words."""
    words = Words.__new__(Words)
    words.hash, words.doc = own, np.zeros(len(own), np.int64)
    return words.grams(k)[0]


def _weighted_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    at = np.minimum(np.searchsorted(x[0], y[0]), len(x[0]) - 1)
    both = np.minimum(x[1][at], y[1])[x[0][at] == y[0]].sum()
    return float(both / (x[1].sum() + y[1].sum() - both))


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[Items]:
    """Blocks of bounded size of all items, whatever their number."""
    ids: list[int] = []
    texts: list[str | None] = []
    size = 0
    for row in items.select(F.col(key).cast("long"), F.col(text)).toLocalIterator():
        ids.append(-1 if row[0] is None else row[0])
        texts.append(row[1])
        size += len(row[1] or "")
        if len(ids) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)


def leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", into: str = "leaks"
) -> DataFrame:
    """Add the column `into` to every row of docs."""
    out = docs.drop(into).withColumn(into, F.array().cast(LEAKS))
    schema = StructType([*docs.drop(into).schema.fields, *StructType.fromDDL(f"`{into}` {LEAKS}").fields])
    for block in item_blocks(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in (piece for whole in batches for piece in chunks(whole, text)):
                found = shared.value.find(Texts.of(batch.column(text)))
                place = batch.schema.get_field_index(into)
                if any(found):
                    found = [a + b for a, b in zip(batch.column(place).to_pylist(), found, strict=True)]
                    # The field as it came: all batches of a task must have one schema.
                    field = batch.schema.field(place)
                    batch = batch.set_column(place, field, pa.array(found, field.type))
                yield batch

        out = out.mapInArrow(run, schema)
    return out


def op8(spark, sf_dir: str) -> DataFrame:
    """One row per leaked item of a document; documents without leaks have none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
