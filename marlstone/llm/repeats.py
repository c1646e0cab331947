"""Where a window of fixed size may occur a second time: what both substring operators share.

Units are bytes or words. Every window of `size` units has an anchor: of the k-grams in it, the
one with the smallest hash, the first of equals. Equal windows have equal anchors at equal places,
so a window can occur twice only if its anchor does, and neighbouring windows mostly share their
anchor. One row per anchor is therefore enough to find all candidates: only runs of windows whose
anchor occurs again are looked at, grouped by anchor.

Anchors that more than HOT runs share would make an unbounded group. Their windows are counted by
128-bit hash instead, which Spark combines before rows are moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import _BYTE, _P, GOLDEN, Texts, Words, _power, chunks, mix, pack, packed_chunks, run_index, unpack
from marlstone.sources.scratch import written

HOT = 50_000
# Runs in one group of the exact step, on average.
_GROUP_RUNS = 10_000
# Bytes of text looked at together: hashes and places take about a hundred times as much of a worker's memory.
_PIECE = 1 << 18
_INDEX = np.uint64(28)


@dataclass
class Units:
    """Units of consecutive documents: `first` is the number of each row's first unit, and the end."""

    first: np.ndarray
    doc: np.ndarray
    data: bytes
    start: np.ndarray  # byte place of each unit and of the end
    end: np.ndarray
    hash: np.ndarray  # per unit

    def piece(self, a: int, b: int) -> bytes:
        return self.data[self.start[a] : self.end[b - 1]]


def byte_units(texts: Texts) -> Units:
    n = len(texts.data)
    at = np.arange(n + 1)
    doc = np.repeat(np.arange(len(texts)), np.diff(texts.starts))
    return Units(np.asarray(texts.starts), doc, texts.data.tobytes(), at, at[1:], _BYTE[texts.data])


def word_units(texts: Texts) -> Units:
    words = Words(texts)
    return Units(words.first, words.doc, texts.data.tobytes(), words.start, words.end, words.hash)


def gram_hashes(units: Units, k: int) -> np.ndarray:
    """Hash of the k units from each place on, whether or not they lie in one document."""
    n = len(units.hash)
    if n < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(units.hash * _power(_P, n), out=total[1:])
    return mix((total[k:] - total[:-k]) * _power(pow(_P, -1, 1 << 64), n - k + 1))


@dataclass
class Runs:
    """Neighbouring windows with one anchor: hash, row, first window, number, place of the anchor."""

    anchor: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    count: np.ndarray
    at: np.ndarray


def runs(units: Units, size: int, k: int) -> Runs:
    gram = gram_hashes(units, k)
    span = size - k + 1
    if len(gram) < span:
        return Runs(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4)
    place = np.arange(len(gram)) - units.first[units.doc[: len(gram)]]
    least = gram >> _INDEX << _INDEX | place.astype(np.uint64)
    # Minimum over spans of doubling width, then over the two that make up the whole span.
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    windows = np.flatnonzero(units.doc[: len(least)] == units.doc[size - 1 : size - 1 + len(least)])
    at = (least[windows] & np.uint64((1 << int(_INDEX)) - 1)).astype(np.int64) + units.first[units.doc[windows]]
    new = np.ones(len(windows), bool)
    new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
    begin = np.flatnonzero(new)
    at = at[begin]
    return Runs(gram[at], units.doc[at], windows[begin], np.diff(np.append(begin, len(windows))), at)


def anchor_rows(
    batches: Iterator[pa.RecordBatch], units_of: Callable[[Texts], Units], size: int, k: int
) -> Iterator[pa.RecordBatch]:
    """(anchor, id, at) of every run, with its place in the row, for batches of (id, text)."""
    for batch in (piece for whole in batches for piece in chunks(whole, "text", _PIECE)):
        units = units_of(Texts.of(batch.column("text")))
        found = runs(units, size, k)
        ids = batch.column("id").take(pa.array(found.doc))
        at = (found.at - units.first[found.doc]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(found.anchor.view(np.int64)), ids, pa.array(at)], ["anchor", "id", "at"])


def repeated_windows(
    docs: DataFrame,
    units_of: Callable[[Texts], Units],
    size: int,
    k: int,
    solve: Callable[[pa.Table], pa.Table],
    earlier: bool,
    digest: Callable[[list, Units, list[np.ndarray]], pa.RecordBatch],
    digest_schema: str,
    packed: bool = False,
) -> DataFrame:
    """The digest of every row of docs (id, text, key), given the windows that occur elsewhere.

    A row without id takes no part but for its digest. Rows may share an id, and then each is held
    against its own text. `key` is handed through to the result in place of the id.

    `solve` gets runs (anchor, id, first, count, ahead, data, twin), all those of an anchor together,
    and returns (id, first, count, twin) of the windows that repeat. With `earlier`, a window repeats if it
    also starts in a document with a smaller id, else if it starts anywhere else.
    `digest` gets the ids, the units, and for every row the starts of its repeated windows.
    With `packed`, texts are compressed on their way between steps, which trades CPU time for disk.
    """
    text_type = "binary" if packed else "string"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from packed_chunks(batch, "text", most=_PIECE) if packed else chunks(batch, "text", _PIECE)

    def units_in(text: pa.Array) -> Units:
        return units_of(Texts.of(unpack(text) if packed else text))

    def packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks(whole, "text")):
            columns = [batch.column("id"), pack(batch.column("text")), batch.column("key")]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text", "key"])

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return anchor_rows(batches, units_of, size, k)

    rows = docs.filter("id IS NOT NULL").select("id", "text").mapInArrow(anchors, "anchor long, id long, at int")
    several = "low < high" if earlier else "n > 1"
    counted = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), *([F.min("id").alias("low"), F.max("id").alias("high")] if earlier else []))
    # Written, so that the next join is of two plain shuffles, whose hot anchors adaptive execution splits.
    again = written(counted.filter(several).select("anchor", (F.col("n") > HOT).alias("hot")), "again")
    places = rows.join(again, "anchor").groupBy("id").agg(F.collect_list(F.struct("at", "hot")).alias("places"))
    stored = docs.select("id", "text", "key").mapInArrow(packing, "id long, text binary, key long") if packed else docs
    joined = stored.join(places, "id", "left").select("id", "text", "key", F.col("places.at").alias("at"), F.col("places.hot").alias("hot"))

    # Rows without a repeated anchor are done; the text of the others is kept for the next steps.
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            open_ = batch.column("at").is_valid()
            done = batch.filter(pa.compute.invert(open_))
            if done.num_rows:
                units = units_in(done.column("text"))
                out = digest(done.column("id").to_pylist(), units, [np.zeros(0, np.int64)] * done.num_rows)
                yield _with(out, done.column("key"), None, packed)
            left = batch.filter(open_)
            if left.num_rows:
                empty = digest([], units_of(Texts.of(pa.array([], pa.string()))), [])
                blank = [pa.nulls(left.num_rows, f.type) if f.name != "id" else left.column("id") for f in empty.schema]
                yield _with(pa.RecordBatch.from_arrays(blank, empty.schema.names), left.column("key"), left, packed)

    kept = written(joined.mapInArrow(settle, f"{digest_schema}, key long, text {text_type}, at array<int>, hot array<boolean>"), "settled")
    # Rows of one id are told apart by their texts.
    waiting = kept.filter("at IS NOT NULL").select("id", "text", "key", "at", "hot", F.xxhash64("text").alias("twin"))
    total = waiting.agg(F.coalesce(F.sum(F.size("at")), F.lit(0))).first()[0]
    groups = max(1, -(-total // _GROUP_RUNS))

    def emit(hot: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                units = units_in(batch.column("text"))
                found = runs(units, size, k)
                n = pa.compute.list_value_length(batch.column("at")).to_numpy(zero_copy_only=False)
                at = batch.column("at").flatten().to_numpy() + np.repeat(units.first[:-1], n)
                is_hot = batch.column("hot").flatten().to_numpy(zero_copy_only=False).astype(bool)
                pick = np.flatnonzero(np.isin(found.at, at[is_hot == hot]))
                ids, twin = (batch.column(c).take(pa.array(found.doc[pick])) for c in ("id", "twin"))
                first, count = found.first[pick], found.count[pick]
                start = first - units.first[found.doc[pick]]
                if not hot:
                    data = [units.piece(a, a + c + size - 1) for a, c in zip(first.tolist(), count.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found.anchor[pick].view(np.int64)), ids, pa.array(start), pa.array(count),
                            pa.array(found.at[pick] - first), pa.array(data, pa.binary()), twin,
                        ],
                        ["anchor", "id", "first", "count", "ahead", "data", "twin"],
                    )
                else:
                    windows = np.repeat(first, count) + run_index(count)
                    whole = gram_hashes(units, size)[windows]
                    other = Units(units.first, units.doc, b"", units.start, units.end, mix(units.hash + GOLDEN))
                    check = gram_hashes(other, size)[windows]
                    run_of = pa.array(np.repeat(np.arange(len(pick)), count))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(whole.view(np.int64)), pa.array(check.view(np.int64)), ids.take(run_of),
                            pa.array(np.repeat(start, count) + run_index(count)), twin.take(run_of),
                        ],
                        ["a", "b", "id", "first", "twin"],
                    )

        return run

    contexts = waiting.mapInArrow(emit(False), "anchor long, id long, first long, count long, ahead long, data binary, twin long")
    grouped = contexts.groupBy(F.pmod("anchor", F.lit(groups)).alias("group"))
    spans = grouped.applyInArrow(solve, "id long, first long, count long, twin long")
    hot = waiting.filter(F.exists("hot", lambda h: h)).mapInArrow(emit(True), "a long, b long, id long, first long, twin long")
    windows = hot.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    frequent = hot.join(windows.filter("n > 1"), ["a", "b"]).filter("low < id" if earlier else "n > 1")
    spans = spans.union(frequent.select("id", "first", F.lit(1).cast("long").alias("count"), "twin"))
    spans = spans.groupBy("id", "twin").agg(F.collect_list(F.struct("first", "count")).alias("spans"))
    ready = waiting.select("id", "twin", "text", "key").join(spans, ["id", "twin"], "left")
    ready = ready.select("id", "text", "key", F.col("spans.first").alias("first"), F.col("spans.count").alias("count"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            units = units_in(batch.column("text"))
            starts = []
            for first, count in zip(batch.column("first"), batch.column("count"), strict=True):
                if first.is_valid:
                    n = count.values.to_numpy()
                    starts.append(np.repeat(first.values.to_numpy(), n) + run_index(n))
                else:
                    starts.append(np.zeros(0, np.int64))
            out = digest(batch.column("id").to_pylist(), units, starts)
            yield pa.RecordBatch.from_arrays([*out.columns, batch.column("key")], [*out.schema.names, "key"])

    columns = ["key", *(c for c in kept.columns if c not in ("id", "key", "text", "at", "hot"))]
    finished = ready.mapInArrow(finish, f"{digest_schema}, key long").select(*columns)
    return kept.filter("at IS NULL").select(*columns).union(finished)


def _with(out: pa.RecordBatch, key: pa.Array, left: pa.RecordBatch | None, packed: bool) -> pa.RecordBatch:
    types = {"text": pa.binary() if packed else pa.string(), "at": pa.list_(pa.int32()), "hot": pa.list_(pa.bool_())}
    more = [pa.nulls(len(key), t) if left is None else left.column(c).cast(t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays([*out.columns, key, *more], [*out.schema.names, "key", *types])


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the n units that lie in one of the windows."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, n), -1)
    return np.cumsum(change[:-1]) > 0
