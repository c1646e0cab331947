"""Exact k-means over blocks of vectors along a space-filling curve.

Vectors are ordered by a Hilbert curve over all their components, coarsely cut, and then laid into
blocks with the least and greatest value of each component: a zone map. No vector of a block is nearer
to a centroid than the block's box is, nor farther than the box's farthest corner. A centroid whose
box distance exceeds the least such far distance can't be nearest to any vector of the block, so a
round compares the block only with the others. Components are whole numbers, and distances and means
are exact.

A round is one pass over the blocks; it returns one row of sums per task and cluster, which Spark
adds up, and only the new centroids, as many numbers as k x components, reach the driver and the
tasks. Equal vectors, however many, are spread over blocks.

Defined results: vectors that are null, have another number of components than `width`, or hold null
or non-finite ones take no part. Starting centroids are the vectors of smallest hash of their id;
equal ids are ordered by their components, vectors without id come last. With fewer vectors than
centroids there are fewer centroids; equal centroids stay, and the first gets all their vectors. A
component beyond 2**27 in size after scaling is refused, since distances would not fit into 64 bits.
Columns other than the id and the vector are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.scratch import written

BLOCK = 256
# Bits of a component that the curve looks at.
CURVE_BITS = 3
LARGEST = 2**27
_ASSIGNED = "vec_id long, cluster int, distance long"


def hilbert_keys(points: np.ndarray, bits: int) -> list[bytes]:
    """Place of every row on the Hilbert curve through all cells of `bits` bits a component."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    # From coordinates to the transposed index: undo the rotations of every level, then Gray-encode.
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[n - 1] & level, level - 1, 0)
        level >>= 1
    x ^= flip
    # One bit of every component by turns, the highest first.
    planes = np.concatenate([(x >> bit & 1).T for bit in range(bits - 1, -1, -1)], axis=1).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(planes, axis=1)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.cast(pa.large_list(pa.int64())) if not pa.types.is_large_list(column.type) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances; through floats where those are exact."""
    most = float(max(np.abs(x).max(initial=0), np.abs(centres).max(initial=0)))
    if 4 * most * most * x.shape[1] < 2**52:
        a, b = x.astype(float), centres.astype(float)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - centre) ** 2).sum(1) for centre in centres], axis=1)


def candidates(low: np.ndarray, high: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centroids (columns) may be nearest to some vector of each box (rows)."""
    near, far = (np.zeros((len(low), len(centres)), np.int64) for _ in range(2))
    for i, centre in enumerate(centres):
        below, above = low - centre, centre - high
        gap = np.maximum(np.maximum(below, above), 0)
        near[:, i] = (gap * gap).sum(1)
        reach = np.maximum(np.abs(below), np.abs(above))
        far[:, i] = (reach * reach).sum(1)
    return near <= far.min(1)[:, None]


def whole_vectors(vectors: DataFrame, width: int, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): the usable vectors, a component x as floor(scale * x)."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = (F.size(vector) == width) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(vector).isNotNull() & usable).select(F.col(key).cast("long").alias("vec_id"), values.alias("v"))
    scaled = F.transform("v", lambda x: F.floor(x * scale))
    fits = F.forall("v", lambda x: F.abs(x * scale) <= LARGEST)
    refused = F.raise_error(F.lit(f"a component is larger than {LARGEST} after scaling"))
    return rows.select("vec_id", F.when(fits, scaled).otherwise(refused).alias("v"))


def blocks_along_curve(vectors: DataFrame, width: int, size: int = BLOCK) -> DataFrame:
    """Blocks (ids, v, low, high) of at most `size` vectors that are near each other, as a written table."""
    given = written(vectors, "vectors")
    bounds = given.select(F.explode("v").alias("x")).agg(F.min("x"), F.max("x")).first()
    least, span = bounds[0] or 0, max((bounds[1] or 0) - (bounds[0] or 0), 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            cells = np.minimum((x - least) * (1 << CURVE_BITS) // (span + 1), (1 << CURVE_BITS) - 1)
            keys = pa.array(hilbert_keys(cells, CURVE_BITS), pa.binary())
            yield pa.RecordBatch.from_arrays([keys, batch.column("vec_id"), batch.column("v")], ["key", "vec_id", "v"])

    # Written, since the bounds of the ranges are found by a pass of their own. The hash parts equal vectors.
    placed = written(given.mapInArrow(place, "key binary, vec_id long, v array<long>"), "curve")
    placed = placed.withColumn("mixed", F.xxhash64("vec_id"))
    ordered = placed.repartitionByRange("key", "mixed").sortWithinPartitions("key", "mixed").drop("mixed", "key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                x = _matrix(part.column("v"), width)
                columns = {"ids": [part.column("vec_id")], "v": [x.astype("<i4").tobytes()]}
                columns |= {name: [edge.tolist()] for name, edge in (("low", x.min(0)), ("high", x.max(0)))}
                types = (pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)], list(columns))

    return written(ordered.mapInArrow(cut, "ids array<long>, v binary, low array<long>, high array<long>"), "zones")


def _assign(batch: pa.RecordBatch, centres: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, cluster, squared distance) of each block."""
    width = centres.shape[1]
    may = candidates(_matrix(batch.column("low"), width), _matrix(batch.column("high"), width), centres)
    for at, (ids, raw) in enumerate(zip(batch.column("ids"), batch.column("v"), strict=True)):
        x = np.frombuffer(raw.as_buffer(), "<i4").astype(np.int64).reshape(-1, width)
        some = np.flatnonzero(may[at])
        square = _squares(x, centres[some])
        # The first of equal distances, so the smaller number.
        best = square.argmin(1)
        yield ids.values, x, some[best], square[np.arange(len(x)), best]


def sums(blocks: DataFrame, centres: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """By cluster: number of vectors, sum of squared distances, sum of each component."""
    width = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, inertia = (np.zeros(len(centres), object) for _ in range(2))
        total = np.zeros((len(centres), width), object)
        for batch in batches:
            for _, x, cluster, square in _assign(batch, centres):
                for c in np.unique(cluster):
                    mine = cluster == c
                    count[c] += int(mine.sum())
                    # In two halves, which can't overflow within a block.
                    inertia[c] += (int((square[mine] >> 32).sum()) << 32) + int((square[mine] & 0xFFFFFFFF).sum())
                    total[c] += x[mine].sum(0).astype(object)
        rows = [(c, i, v) for c in range(len(centres)) if count[c] for i, v in enumerate([count[c], inertia[c], *total[c]])]
        names, types = ("cluster", "place", "value"), (pa.int32(), pa.int32(), pa.string())
        columns = [[row[0] for row in rows], [row[1] for row in rows], [str(row[2]) for row in rows]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], list(names))

    parts = blocks.mapInArrow(run, "cluster int, place int, value string")
    added = parts.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out: dict[int, dict[int, int]] = {}
    # k x (components + 2) numbers.
    for row in added.collect():
        out.setdefault(row["cluster"], {})[row["place"]] = int(row["value"])
    return {c: (v[0], v[1], [v[i + 2] for i in range(width)]) for c, v in out.items()}


def start(vectors: DataFrame, k: int, hashed: Callable[[Column], Column]) -> np.ndarray:
    """The k vectors of smallest hash of their id, in this order."""
    order = (F.asc_nulls_last(hashed(F.col("vec_id"))), "v")
    return np.array([row["v"] for row in vectors.orderBy(*order).limit(k).collect()], np.int64)


def k_means(vectors: DataFrame, k: int, rounds: int, width: int, hashed: Callable[[Column], Column]) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of
    `whole_vectors` after `rounds` rounds and a last assignment."""
    blocks = blocks_along_curve(vectors, width)
    centres = start(blocks_rows(blocks, width), k, hashed)
    schema = f"{_ASSIGNED}, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centres):
        return vectors.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        for cluster, (count, _, total) in sums(blocks, centres).items():
            centres[cluster] = [value // count for value in total]
    inertia = {cluster: found[1] for cluster, found in sums(blocks, centres).items()}
    of_cluster = np.array([inertia.get(c, 0) for c in range(len(centres))], object)
    of_all = sum(inertia.values())
    if of_all >= 2**63:
        raise OverflowError("the sum of squared distances does not fit into 64 bits")
    digests = [hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest() for centre in centres.tolist()]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, cluster, square in _assign(batch, centres):
                columns = [
                    ids,
                    pa.array(cluster.astype(np.int32)),
                    pa.array(square),
                    pa.array(of_cluster[cluster].astype(np.int64)),
                    pa.array(np.full(len(cluster), of_all, np.int64)),
                    pa.array(digests).take(pa.array(cluster)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in schema.split(", ")])

    return blocks.mapInArrow(assign, schema)


def blocks_rows(blocks: DataFrame, width: int) -> DataFrame:
    """(vec_id, v) of every vector of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw in zip(batch.column("ids"), batch.column("v"), strict=True):
                x = np.frombuffer(raw.as_buffer(), "<i4").astype(np.int64)
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) + 1, width, dtype=np.int32)), pa.array(x))
                yield pa.RecordBatch.from_arrays([ids.values, rows], ["vec_id", "v"])

    return blocks.mapInArrow(run, "vec_id long, v array<long>")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 64, 1024)
    return k_means(vectors, 8, 10, 64, lambda i: F.sha2(F.concat(F.lit("3:"), i.cast("string")), 256))
