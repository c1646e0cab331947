"""Texts of an Arrow batch as flat numpy arrays: bytes, words and hashes.

Helpers for the inside of tasks. Every array spans many documents; `doc` arrays say which row an
entry belongs to, so that work is vectorised over documents and never per word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_P = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64 bits in which every input bit counts."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next batch."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base][:n]


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes start .. end - 1 of each run."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_P, len(data)), out=total[1:])
    inverse = _power(pow(_P, -1, 1 << 64), len(data) + 1)
    return mix((total[end] - total[start]) * inverse[start])


class Texts:
    """UTF-8 bytes of consecutive documents: `data`, and `starts` with one entry more than rows."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.data, self.starts = data, starts

    def __len__(self) -> int:
        return len(self.starts) - 1

    @staticmethod
    def of(column: pa.Array) -> Texts:
        """Null counts as empty."""
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        _, offsets, data = column.buffers()
        starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        return Texts(raw[starts[0] : starts[-1]], starts - starts[0])

    def lower(self) -> Texts:
        """A-Z to a-z, everything else as it is."""
        return Texts(_LOWER[self.data], self.starts)


class Words:
    """Maximal runs of other bytes than space and 0x09-0x0D.

    `start` and `end` are byte places, `doc` the row, `first` the number of the first word of each
    row (one entry more than rows), `hash` a 64-bit hash of the word's bytes.
    """

    def __init__(self, texts: Texts):
        n = len(texts.data)
        word = np.zeros(n + 2, bool)
        word[1:-1] = ~_SPACE[texts.data]
        begins = word[1:] & ~word[:-1]
        ends = word[:-1] & ~word[1:]
        # A new row begins a new word even where no space parts it from the row before.
        cuts = texts.starts[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        cuts = np.unique(cuts[word[cuts] & word[cuts + 1]])
        begins[cuts] = True
        ends[cuts] = True
        self.start, self.end = np.flatnonzero(begins[: n + 1]), np.flatnonzero(ends[: n + 1])
        self.first = np.searchsorted(self.start, texts.starts)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hash = run_hashes(texts.data, self.start, self.end)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, place) of the runs of k words inside one row, by their first word."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = self.hash[:n].copy()
        for i in range(1, k):
            value = mix(value + GOLDEN) ^ self.hash[i : i + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return mix(value[at]), at


def shingles(words: Words, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles per row, sorted: (hashes, first place of each row and the end).

    A row with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    value, at = words.grams(k)
    doc = words.doc[at]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = count[short] > i
            whole[has] = mix(whole[has] + GOLDEN) ^ words.hash[words.first[short[has]] + i]
        value = np.concatenate([value, mix(whole)])
        doc = np.concatenate([doc, short])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[fresh], doc[fresh]
    return value, np.searchsorted(doc, np.arange(rows + 1))


def chunks(batch: pa.RecordBatch, text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows into pieces of about `most` bytes of text, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def pack(texts: pa.Array) -> pa.Array:
    """Every text compressed for itself, for texts that are shuffled or stored. Null counts as empty."""
    press = zstandard.ZstdCompressor()
    return pa.array([press.compress(text.as_buffer() or b"") for text in texts.cast(pa.binary())], pa.binary())


def unpack(packed: pa.Array) -> pa.Array:
    press = zstandard.ZstdDecompressor()
    return pa.array([press.decompress(text.as_buffer()) for text in packed], pa.large_binary())


def packed_chunks(batch: pa.RecordBatch, *packed: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Like `chunks`, by the unpacked bytes of the packed columns together."""
    size = np.zeros(batch.num_rows, np.int64)
    for column in packed:
        size += np.array([zstandard.frame_content_size(text.as_buffer()) for text in batch.column(column)], np.int64)
    total, at = np.cumsum(size), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def long_list(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """One list of longs per row from the flat array cut at `first`."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(first).astype(np.int32)), pa.array(values.view(np.int64)))


def run_index(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n of counts, one after the other."""
    total = int(counts.sum())
    begin = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(begin, counts)
