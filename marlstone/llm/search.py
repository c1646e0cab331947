"""Exact top-k by inner product with a pivot-distance index.

Vectors get one more coordinate that gives all of them the same length; the largest inner product
is then the smallest distance to the query. Every vector belongs to its nearest pivot and, by its
distance to it, to one of that pivot's annuli. A query first searches the annuli nearest to it,
and the k-th best score so far bounds the radius in which better ones may lie. By the triangle
inequality an annulus whose distances to the pivot all differ from the query's by more than the
radius holds none of them, so only the others are searched.

Pivots and annuli are of fixed number, so their bounds are sent to every task. Neighbouring annuli
share a shelf of bounded size, and a crowded annulus is cut into several. A task holds one shelf and
lets the queries that may find something there stream past it; within the shelf, rows are compared
piece by piece, and only with queries whose radius, which shrinks on the way, reaches an annulus of the
piece. So a query travels once per shelf, and what a task holds depends on no number of rows. The
comparisons themselves, queries times vectors, grow with the square of the input where bounds rule
little out.

Defined results: vectors that are null, hold null or non-finite components, or differ in length
from the most frequent length take no part, nor do rows without an id. A query's own id is never
among its results, not even from another row. Queries of one id are one query if their vectors are
equal. Fewer candidates than k give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.arrays import GOLDEN, Texts, mix, run_index
from marlstone.sources.scratch import written

PIVOTS, ANNULI = 48, 32
RINGS = PIVOTS * ANNULI * 4
SAMPLE = 4096
# The most vectors and bytes that a task holds, and as many queries as meet them in one task.
SHELF, SHELF_BYTES, QUERY_GROUP = 1 << 15, 1 << 24, 1 << 16
LEAST_SHELF = 1 << 11
# Vectors and queries that are multiplied at once; bounds of queries that are worked out at once.
PIECE, ASKED, BOUNDS = 1 << 10, 256, 1 << 18
# The most tasks of a search.
TASKS = 1 << 12

_FOUND = "query_id long, id long, score long"


def _matrix(column: pa.Array, width: int, kind: type = np.int64) -> np.ndarray:
    return Texts.of(column).data.view(kind).reshape(-1, width)


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of a few rounds of k-means over the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(int)]
    for _ in range(5):
        near = _distances(sample, centres).argmin(1)
        centres = np.array([sample[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
    return centres


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T
    return np.sqrt(np.maximum(square, 0))


class _Index(NamedTuple):
    """What every task knows: the sizes of the vectors, the pivots, and the bounds of the annuli."""

    width: int
    longest: float  # largest squared length
    pivots: np.ndarray
    # Per annulus that holds vectors: its number, least and greatest distance to its pivot, rows.
    ring: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray
    # Per annulus, held or not: its first shelf and its number of shelves.
    first: np.ndarray
    parts: np.ndarray

    @property
    def stored(self) -> type:
        """Components, none of which is longer than the whole, in as few bytes as they need."""
        return np.int16 if self.longest < 2**30 else np.int32 if self.longest < 2**62 else np.int64

    @property
    def exact(self) -> type:
        """Products and their partial sums are at most the squared length: floats where those are exact."""
        return np.float32 if self.longest < 2**24 else np.float64 if self.longest < 2**52 else np.int64

    @property
    def shelves(self) -> int:
        return int((self.first + self.parts).max())

    def lifted(self, values: np.ndarray, square: np.ndarray) -> np.ndarray:
        return np.column_stack([values, np.sqrt(np.maximum(self.longest - square, 0))])

    def bounds(self, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For queries by annulus: the least distance to what the annulus holds, and that to its pivot."""
        q = np.column_stack([values, np.zeros(len(values))])
        far = _distances(q, self.pivots)[:, self.ring[at] // (ANNULI * 4)]
        return np.maximum(np.maximum(self.low[at] - far, far - self.high[at]), 0), far

    def radius(self, square: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Distance within which vectors of at least this product lie, and what rounding may add."""
        away = np.sqrt(np.maximum(square + self.longest - 2 * least, 0))
        return np.where(np.isnan(least), np.inf, away * (1 + 1e-9) + 1e-3 + 1e-6 * np.sqrt(self.longest))


def _shelved(ring: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First shelf and number of shelves of each annulus: neighbours share one up to `most` rows, larger ones are cut."""
    first, parts = np.zeros(RINGS, np.int64), np.ones(RINGS, np.int64)
    shelf, filled = 0, 0
    for number, rows in zip(ring.tolist(), count.tolist(), strict=True):
        if filled and filled + rows > most:
            shelf, filled = shelf + 1, 0
        first[number], parts[number] = shelf, -(-rows // most)
        if rows > most:
            shelf += int(parts[number])
        else:
            filled += rows
    return first, parts


def _visits(index: _Index, k: int, bounded: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per query and shelf it goes to: the nearest until they hold enough vectors, or all within its radius."""
    parts = index.parts[index.ring]
    at = np.repeat(np.arange(len(parts)), parts)
    shelf = index.first[index.ring][at] + run_index(parts)
    begin = np.flatnonzero(np.r_[True, shelf[1:] != shelf[:-1]])
    shelf, rows = shelf[begin], np.add.reduceat(index.count[at] / parts[at], begin)
    step = max(1, BOUNDS // len(at))
    for whole in batches:
        for i in range(0, whole.num_rows, step):
            batch = whole.slice(i, step)
            bound, far = index.bounds(_matrix(batch.column("v"), index.width, index.stored), np.arange(len(index.ring)))
            if bounded:
                best = batch.column("best").to_numpy(zero_copy_only=False).astype(float)
                wanted = np.minimum.reduceat(bound[:, at], begin, axis=1) <= index.radius(batch.column("square").to_numpy(), best)[:, None]
            else:
                # Of annuli that may hold the query itself, that of the nearest pivot.
                order = np.minimum.reduceat((bound + 1e-6 * far)[:, at], begin, axis=1).argsort(1, kind="stable")
                held = np.cumsum(rows[order], 1) - rows[order]
                wanted = np.zeros(order.shape, bool)
                np.put_along_axis(wanted, order, held < 4 * k + 4, 1)
            row, to = np.nonzero(wanted)
            given = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(shelf[to]), *given.columns], ["shelf", *given.schema.names])


def _best_of_shelf(
    index: _Index, k: int, ids: np.ndarray, x: np.ndarray, ring: np.ndarray, batch: pa.RecordBatch
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score): the k best rows of the shelf for each of a few queries, `ring` being sorted."""
    own = batch.column("id").to_numpy()
    values = _matrix(batch.column("v"), index.width, index.stored)
    q, square = values.astype(index.exact), batch.column("square").to_numpy()
    best = batch.column("best").to_numpy(zero_copy_only=False).astype(float)
    known = ~np.isnan(best)
    least = np.full(len(q), np.iinfo(np.int64).min if index.exact is np.int64 else -np.inf, index.exact)
    if index.exact is np.int64:
        least[known] = batch.column("best").filter(pa.array(known)).to_numpy()
    else:
        least[known] = best[known]
    radius = index.radius(square, best)
    there = np.searchsorted(index.ring, ring)
    apart = there[np.r_[True, ring[1:] != ring[:-1]]]
    bound, _ = index.bounds(values, apart)
    row, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, index.exact)
    for start in range(0, len(x), PIECE):
        end = min(start + PIECE, len(x))
        span = slice(np.searchsorted(apart, there[start]), np.searchsorted(apart, there[end - 1]) + 1)
        ask = np.flatnonzero(bound[:, span].min(1) <= radius)
        if not len(ask):
            continue
        product = q[ask] @ x[start:end].T
        r, c = np.nonzero(product >= least[ask][:, None])
        other = own[ask[r]] != ids[start + c]
        r, c = r[other], c[other]
        if not len(r):
            continue
        row, found, score = np.r_[row, ask[r]], np.r_[found, ids[start + c]], np.r_[score, product[r, c]]
        # The k best so far, of equals the smaller ids, and what that leaves to look for.
        order = np.lexsort((found, -score, row))
        row, found, score = row[order], found[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        kept = rank < k
        row, found, score, rank = row[kept], found[kept], score[kept], rank[kept]
        last = rank == k - 1
        least[row[last]] = np.maximum(least[row[last]], score[last])
        full = row[last]
        radius[full] = np.minimum(radius[full], index.radius(square[full], least[full].astype(float)))
    return own[row], found, score.astype(np.int64)


def _search(index: _Index, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shelf, those of the shelf before queries and by annulus: the best of the shelf for each query."""
    key, held, shelf = None, [], None
    for whole in batches:
        keys, asks = whole.column("shelf").to_numpy(), whole.column("asks").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (asks[1:] != asks[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if start == end:
                continue
            batch = whole.slice(start, end - start)
            if keys[start] != key:
                key, held, shelf = keys[start], [], None
            if not asks[start]:
                values = _matrix(batch.column("v"), index.width, index.stored).astype(index.exact)
                held.append((batch.column("id").to_numpy(), values, batch.column("ring").to_numpy()))
                continue
            if held:
                shelf, held = [np.concatenate(column) for column in zip(*held, strict=True)], []
            if shelf is None:
                continue
            for i in range(0, batch.num_rows, ASKED):
                found = _best_of_shelf(index, k, *shelf, batch.slice(i, ASKED))
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in found], ["query_id", "id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, key, score): the k best other rows of every query row.

    A component x counts as floor(scale * x).
    """
    whole = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable)
    good = good.select(F.col(key).cast("long").alias("id"), whole.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    width = good.agg(F.mode(F.size("v"))).first()[0] or 0

    def whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.floor(scale * batch.column("v").flatten().to_numpy(zero_copy_only=False)).astype(np.int64).reshape(-1, width)
            square = (values.astype(float) ** 2).sum(1)
            raw = pa.array([row.tobytes() for row in values], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("q"), raw, pa.array(square)], ["id", "q", "v", "square"])

    given = written(good.filter(F.size("v") == width).mapInArrow(whole_numbers, "id long, q boolean, v binary, square double"), "vectors")
    longest = given.agg(F.max("square")).first()[0]
    if longest is None or not width:
        return vectors.sparkSession.createDataFrame([], f"query_id long, rank int, {key} long, score long")
    sample = given.orderBy(F.xxhash64("id", "v")).limit(SAMPLE).select("v", "square").toArrow().to_batches()

    nothing = np.zeros(0)
    index = _Index(width, longest, nothing, nothing, nothing, nothing, nothing, nothing, nothing)
    lifted = [index.lifted(_matrix(b.column("v"), width), b.column("square").to_numpy()) for b in sample]
    index = index._replace(pivots=_pivots(np.concatenate(lifted), PIVOTS))
    span = 2 * np.sqrt(longest) + 1

    def place(batches: Iterator[pa.RecordBatch], index: _Index = index) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("v"), width)
            far = _distances(index.lifted(values, batch.column("square").to_numpy()), index.pivots)
            cell = far.argmin(1)
            distance = far[np.arange(len(far)), cell]
            ring = cell * (ANNULI * 4) + np.minimum(distance / span * (ANNULI * 4), ANNULI * 4 - 1).astype(np.int64)
            # Rows that repeat differ by their place, so that any crowd can be cut.
            ids = batch.column("id").to_numpy().view(np.uint64)
            spread = mix(ids ^ (np.arange(1, len(ids) + 1, dtype=np.uint64) * GOLDEN)) >> np.uint64(1)
            raw = pa.array([row.tobytes() for row in values.astype(index.stored)], pa.binary())
            columns = [batch.column("id"), batch.column("q"), raw, batch.column("square")]
            columns += [pa.array(ring), pa.array(distance), pa.array(spread.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "q", "v", "square", "ring", "distance", "spread"])

    schema = "id long, q boolean, v binary, square double, ring long, distance double, spread long"
    stored = written(given.mapInArrow(place, schema), "index")
    # At most pivots x annuli rows.
    rings = stored.groupBy("ring").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count(F.lit(1)).alias("n"))
    rings = rings.orderBy("ring").toPandas()
    ring, count = rings["ring"].to_numpy(), rings["n"].to_numpy()
    tasks = 4 * vectors.sparkSession.sparkContext.defaultParallelism
    most = min(SHELF, max(LEAST_SHELF, int(count.sum()) // tasks), max(PIECE, SHELF_BYTES // (8 * width)))
    first, parts = _shelved(ring, count, most)
    index = index._replace(ring=ring, low=rings["low"].to_numpy(), high=rings["high"].to_numpy(), count=count, first=first, parts=parts)
    queries = stored.filter("q").select("id", "v", "square").distinct()
    groups = max(1, -(-queries.count() // QUERY_GROUP))

    def shelve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ring = batch.column("ring").to_numpy()
            shelf = index.first[ring] + batch.column("spread").to_numpy() % index.parts[ring]
            yield pa.RecordBatch.from_arrays([pa.array(shelf), batch.column("ring"), batch.column("id"), batch.column("v")], ["shelf", "ring", "id", "v"])

    def search(asked: DataFrame, bounded: bool) -> DataFrame:
        """Every shelf meets each group of queries in one task."""
        held = stored.select("ring", "spread", "id", "v").mapInArrow(shelve, "shelf long, ring long, id long, v binary")
        if groups > 1:
            held = held.withColumn("shelf", F.explode(F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.col("shelf") * groups + g)))
        held = held.select("shelf", F.lit(False).alias("asks"), "ring", "id", "v", F.lit(None).cast("double").alias("square"), F.lit(None).cast("long").alias("best"))
        asked = asked.mapInArrow(lambda batches: _visits(index, k, bounded, batches), "shelf long, id long, v binary, square double, best long")
        group = F.pmod(F.xxhash64("id", F.lit("group")), F.lit(groups))
        asked = asked.select((F.col("shelf") * groups + group).alias("shelf"), F.lit(True).alias("asks"), F.lit(0).cast("long").alias("ring"), "id", "v", "square", "best")
        tasks = min(index.shelves * groups, TASKS)
        both = held.union(asked).repartitionById(tasks, (F.col("shelf") % tasks).cast("int")).sortWithinPartitions("shelf", "asks", "ring")
        return both.mapInArrow(lambda batches: _search(index, k, batches), _FOUND)

    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    rank = F.row_number().over(ranked)
    # What the nearest shelf holds bounds the radius, and no more than that.
    near = written(search(queries.withColumn("best", F.lit(None).cast("long")), False), "near")
    near = near.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")
    kth = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("best"))
    again = queries.join(kth.withColumnRenamed("query_id", "id"), "id", "left").select("id", "v", "square", "best")
    best = search(again, True).withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias(key), "score")


def op5(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5)
