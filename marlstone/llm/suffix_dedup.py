"""Removal of long byte strings that occur more than once, by blockwise suffix sorting.

Suffixes are sorted bucket by bucket: a bucket is what `repeats` groups under some anchors, so
that equal 400-byte strings always meet in one. Inside a bucket the runs of bytes are laid out with
their anchors at multiples of the difference cover's period; suffixes that can be equal then have
equal residues and reach the cover after equally few bytes. Cover positions are ranked first, by
doubling from 31 to 372 bytes; every other suffix is sorted by its residue and the ranks at its cover
positions, and where these are equal by the bytes before and behind them. Suffixes that fall together are
the repeated strings, and memory is bounded by the bucket.

Defined results: null text is empty. Matches never cross documents, overlapping ones count. Equal
rows repeat each other. Rows without an id take part like others and come back without one. Rows of
one id are rows of their own: each is held against its own text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import run_index
from marlstone.llm.repeats import Units, byte_units, covered, repeated_windows

SIZE = 400
_GRAM = 32
# A perfect difference set modulo 31.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
_BUCKET_BYTES = 512 << 10


def _ids(*keys: np.ndarray) -> np.ndarray:
    """Ranks of the tuples of keys: equal numbers for equal tuples, in their order.

    Tuples are sorted by the first key; each further one moves only those that it tells apart.
    """
    order = np.argsort(keys[0])
    own = keys[0][order]
    new = np.ones(len(order), bool)
    new[1:] = own[1:] != own[:-1]
    for key in keys[1:]:
        own = key[order]
        differs = np.flatnonzero(~new[1:] & (own[1:] != own[:-1])) + 1
        if not len(differs):
            continue
        tie = np.cumsum(new)
        mixed = np.zeros(tie[-1] + 1, bool)
        mixed[tie[differs]] = True
        rows = np.flatnonzero(mixed[tie])
        own, tie = own[rows], tie[rows]
        within = np.lexsort((own, tie))
        order[rows] = order[rows[within]]
        own = own[within]
        new[rows[1:]] |= own[1:] != own[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _word(data: np.ndarray, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """`length` (0 to 8) bytes from each place as one big-endian number."""
    views = np.lib.stride_tricks.sliding_window_view(data, 8)[at]
    value = np.ascontiguousarray(views).view(">u8").ravel().astype(np.uint64)
    drop = np.asarray(64 - 8 * np.asarray(length), np.uint64)
    return np.where(drop >= 64, np.uint64(0), value >> np.minimum(drop, np.uint64(63)) << np.minimum(drop, np.uint64(63)))


def _block(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """Up to 32 bytes from each place as four numbers."""
    return [_word(data, at + 8 * i, np.clip(length - 8 * i, 0, 8)) for i in range(4)]


def equal_windows(data: np.ndarray, window: np.ndarray) -> np.ndarray:
    """A number for the SIZE bytes from each of the places `window`; equal numbers for equal bytes.

    Places that may be equal are congruent modulo PERIOD. They are sorted by residue and rank at their cover
    positions; the bytes before and behind these are compared where that leaves ties.
    """
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    ahead = np.array([next(d for d in range(PERIOD) if cover[(r + d) % PERIOD]) for r in range(PERIOD)])
    head = ahead[window % PERIOD]
    blocks = (SIZE - PERIOD + 1 - PERIOD // 2) // PERIOD + 1  # whole periods behind any cover position
    while ahead.max() + blocks * PERIOD > SIZE:
        blocks -= 1
    # Ranks of cover positions: of one period first, then of twice as many again and again.
    entry = window + head
    needed = np.zeros(len(data) + 1, bool)
    for i in range(blocks):
        needed[entry + i * PERIOD] = True
    sample = np.flatnonzero(needed)
    place = np.zeros(len(data) + 1, np.int64)
    place[sample] = np.arange(len(sample))
    rank = _ids(*_block(data, sample, np.full(len(sample), PERIOD)))
    at, done, span, keys = entry.copy(), 0, 1, []
    while True:
        if blocks >> span.bit_length() - 1 & 1:
            keys.append(rank[place[at]])
            at = at + span * PERIOD
            done += span
        if done == blocks:
            break
        # A sample whose second half is not needed by any window gets a rank of its own length.
        second = np.minimum(sample + span * PERIOD, len(data))
        known = needed[second]
        rank = _ids(rank << 32 | np.where(known, rank[place[second]] + 1, 0))
        span *= 2
    first, *more = keys
    rank = _ids(window % PERIOD << 32 | first, *more)
    ties = np.bincount(rank)[rank] > 1
    at, head = window[ties], head[ties]
    tail = at + head + blocks * PERIOD
    out = np.empty(len(window), np.int64)
    out[ties] = _ids(rank[ties], *_block(data, at, head), *_block(data, tail, at + SIZE - tail))
    out[~ties] = np.arange(np.count_nonzero(ties), len(window))
    return out


def solve(table: pa.Table) -> pa.Table:
    """Windows of the runs that occur more than once, as (id, first, count)."""
    anchor = table.column("anchor").to_numpy()
    order = np.argsort(anchor, kind="stable")
    data_column = table.column("data").combine_chunks()
    size = pa.compute.binary_length(data_column).to_numpy(zero_copy_only=False).astype(np.int64)
    count, ahead, first = (table.column(c).to_numpy() for c in ("count", "ahead", "first"))
    # One bucket of suffixes at a time; an anchor is never cut.
    bucket = np.cumsum(size[order]) // _BUCKET_BYTES
    same = np.zeros(len(order), bool)
    same[1:] = anchor[order][1:] == anchor[order][:-1]
    begin = np.flatnonzero(~same)
    bucket = bucket[begin[np.cumsum(~same) - 1]] if len(order) else bucket
    ids, starts, counts = [], [], []
    for rows in np.split(order, np.flatnonzero(np.diff(bucket)) + 1):
        if not len(rows):
            continue
        own = [np.frombuffer(data_column[r].as_buffer(), np.uint8) for r in rows.tolist()]
        # Anchors at multiples of the period.
        offset, at = [], 0
        for r, piece in zip(rows.tolist(), own, strict=True):
            at += -(at + int(ahead[r])) % PERIOD
            offset.append(at)
            at += len(piece)
        data = np.zeros(at + 64, np.uint8)
        for o, piece in zip(offset, own, strict=True):
            data[o : o + len(piece)] = piece
        n = count[rows]
        run = np.repeat(np.arange(len(rows)), n)
        window = np.array(offset)[run] + run_index(n)
        rank = equal_windows(data, window)
        again = np.bincount(rank)[rank] > 1
        new = again.copy()
        new[1:] &= ~again[:-1] | (run[1:] != run[:-1])
        head = np.flatnonzero(new)
        span = np.cumsum(new)[again] - 1
        length = np.bincount(span, minlength=len(head))
        ids.append(rows[run[head]])
        starts.append(first[rows[run[head]]] + (window - np.array(offset)[run])[head])
        counts.append(length)
    pick = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
    return pa.table(
        {
            "id": table.column("id").take(pa.array(pick)),
            "first": np.concatenate([*starts, np.zeros(0, np.int64)]).astype(np.int64),
            "count": np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64),
            "twin": table.column("twin").take(pa.array(pick)),
        }
    )


def _digest(ids: list, units: Units, starts: list[np.ndarray]) -> pa.RecordBatch:
    out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
    data = np.frombuffer(units.data, np.uint8)
    for row, own in enumerate(starts):
        text = data[units.first[row] : units.first[row + 1]]
        gone = covered(own, SIZE, len(text))
        out["n_bytes"].append(len(text))
        out["n_removed"].append(int(gone.sum()))
        out["n_spans"].append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0)
        out["kept_sha256"].append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *arrays], ["id", *out])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    own = F.col(key).cast("long")
    # Rows without an id take part under a hash, which stays inside.
    inside = F.coalesce(own, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    given = docs.select(inside.alias("id"), F.col(text).alias("text"), own.alias("key"))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeated_windows(given, byte_units, SIZE, _GRAM, solve, False, _digest, schema).withColumnRenamed("key", key)


def op10(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
