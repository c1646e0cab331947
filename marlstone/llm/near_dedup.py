"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find.

Every shingle walks through one random permutation of the signature's places: at step j it offers
j plus a random fraction to its j-th place. A place is won by the smallest offer, and since an
offer of step j is at least j, a document stops as soon as all its places hold less than the next
step. Documents that agree in all places of a band are candidates; candidates are linked if the
Jaccard similarity of their full shingle sets reaches the threshold.

Copies count once: documents of equal sets are one node. In a bucket, all members are first
compared with its smallest. Whatever is then in one component needs no further pair; members of
different components are compared where their differences from their group's common text allow a
link, so no candidate pair is left open, and thousands of copies do not meet in all pairs.

Defined results: null and empty texts, and texts without words, have an empty set and are linked
with nothing. Rows of one id are one document: their sets are linked with each other, so that they
share a component. A row without an id is kept and has no component. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.arrays import GOLDEN, Texts, Words, chunks, long_list, mix, pack, packed_chunks, shingles, unpack
from marlstone.llm.components import components
from marlstone.sources.scratch import written

# A pair of similarity 0.8 misses all bands with probability (1 - 0.8 ** 6) ** 42 = 3e-6.
BANDS, BAND_ROWS = 42, 6
_SHINGLES_AT_ONCE = 4096
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def signatures(value: np.ndarray, first: np.ndarray, places: int) -> np.ndarray:
    """SuperMinHash signature of each non-empty set: step in the upper, fraction in the lower half."""
    count = np.diff(first)
    out = np.full((len(count), places), np.iinfo(np.uint64).max, np.uint64)
    by_size = np.argsort(count, kind="stable")
    by_size = by_size[count[by_size] > 0]
    # Sets of one size take about as many steps, so they are worked on together.
    group = np.cumsum(count[by_size]) // _SHINGLES_AT_ONCE
    for rows in np.split(by_size, np.flatnonzero(np.diff(group)) + 1):
        if len(rows):
            own = np.concatenate([value[first[r] : first[r + 1]] for r in rows])
            out[rows] = _signatures(own, np.repeat(np.arange(len(rows)), count[rows]), len(rows), places)
    return out


def _signatures(value: np.ndarray, doc: np.ndarray, rows: int, places: int) -> np.ndarray:
    best = np.full(rows * places, np.iinfo(np.uint64).max, np.uint64)
    order = np.empty((len(value), places), np.uint16)
    order[:] = np.arange(places, dtype=np.uint16)
    order = order.ravel()
    row = np.arange(len(value)) * places
    target = doc * places
    for step in range(places):
        random = mix(value + np.uint64((step + 1) * int(GOLDEN) % (1 << 64)))
        swap = row + step + ((random & _LOW) * np.uint64(places - step) >> _HALF).astype(np.int64)
        place = order[swap]
        order[swap] = order[row + step]
        np.minimum.at(best, target + place, np.uint64(step << 32) | random >> _HALF)
        full = best.reshape(rows, places).max(1) < np.uint64(step + 1 << 32)
        if full.any():
            on = ~full[target // places]
            if not on.any():
                break
            value, row, target = value[on], row[on], target[on]
    return best.reshape(rows, places)


def band_keys(signature: np.ndarray, bands: int, band_rows: int) -> np.ndarray:
    """One 64-bit key per row and band."""
    parts = signature.reshape(len(signature), bands, band_rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, parts.shape[:2]).copy()
    for i in range(band_rows):
        key = mix(key ^ parts[:, :, i])
    return key


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of docs.

    Linked: 100 * size of intersection >= percent * size of union. `kept` marks the smallest id of
    each component.
    """
    given = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in chunks(whole, "text")):
            texts = Texts.of(batch.column("text")).lower()
            value, first = shingles(Words(texts), len(texts), shingle)
            count = np.diff(first)
            keys = band_keys(signatures(value, first, bands * band_rows), bands, band_rows)
            sums = [np.zeros(len(texts), np.uint64) for _ in range(2)]
            for seed, into in enumerate(sums):
                total = np.zeros(len(value) + 1, np.uint64)
                np.cumsum(mix(value ^ mix(np.array([seed + 7], np.uint64))), out=total[1:])
                into[:] = total[first[1:]] - total[first[:-1]]
            used = np.where(count > 0, bands, 0)
            lists = long_list(keys[count > 0].ravel(), np.concatenate([[0], np.cumsum(used)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(count, pa.int64()), *[pa.array(s.view(np.int64)) for s in sums], lists],
                ["id", "n", "set_a", "set_b", "bands"],
            )

    signed = written(given.mapInArrow(sign, "id long, n long, set_a long, set_b long, bands array<long>"), "signed")
    nodes = signed.filter("n > 0 AND id IS NOT NULL")
    same = nodes.groupBy("set_a", "set_b").agg(F.min("id").alias("node"), F.min_by("bands", "id").alias("bands"))
    same = written(same, "nodes")
    members = same.select("node", F.explode("bands").alias("bucket"))
    centres = members.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    bucketed = written(members.join(centres, "bucket").select("bucket", "centre", "node"), "buckets")
    pairs = bucketed.filter("centre <> node").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    pairs = written(pairs, "pairs")

    involved = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    # Texts travel packed: a set of 64-bit hashes is several times as long and does not compress.
    # Merged at every size, since these ids grow with the corpus.
    packed = given.filter("id IS NOT NULL").mapInArrow(_pack, "id long, packed binary")
    packed = packed.join(involved.hint("merge"), "id", "left_semi")
    texts = written(packed.mapInArrow(_sized(shingle), "id long, packed binary, n long"), "texts")
    linked = written(_verified(pairs, texts, shingle, percent), "verified")
    first = written(components(linked), "components")

    # Second step: candidates that the first one left in different components.
    across = written(_across(bucketed, pairs, first, texts, shingle, percent), "across")
    more = written(_verified(across, texts, shingle, percent), "verified")
    classes = components(linked.union(more).union(_of_one_id(nodes, same)))

    known = same.drop("bands").join(classes.withColumnRenamed("id", "node"), "node", "left")
    known = known.select("set_a", "set_b", F.coalesce("component", "node").alias("component_id"))
    out = signed.drop("bands").join(known, ["set_a", "set_b"], "left")
    out = out.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))
    out = out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
    return out.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _of_one_id(nodes: DataFrame, same: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of every id that has more than one."""
    sets = nodes.select("id", F.struct("set_a", "set_b").alias("set"))
    several = sets.groupBy("id").agg(F.min("set").alias("low"), F.max("set").alias("high")).filter("low <> high").select("id")
    of_id = nodes.join(several, "id", "left_semi").join(same, ["set_a", "set_b"]).select("id", "node").distinct()
    least = of_id.groupBy("id").agg(F.min("node").alias("a"))
    return of_id.join(least, "id").filter("a <> node").select("a", F.col("node").alias("b")).distinct()


def _across(
    bucketed: DataFrame, compared: DataFrame, placed: DataFrame, texts: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """Pairs (a, b) of one centre, of different components and not compared yet, that may be linked.

    Among near copies of one text whose similarity lies around the threshold, hardly any pair of
    thousands is linked, and comparing all of them is what this avoids. Each centre's group gets a
    reference set: the shingles that most of its members hold. With D(x) the difference of x to it,
    the difference of x and y has |D(x)| + |D(y)| - 2 |D(x) n D(y)| shingles, and the pair is linked
    if that is at most (|x| + |y|) * (100 - percent) / (100 + percent). Call |x| times that factor
    less than |D(x)| the excess of x: the pair is linked if D(x) and D(y) share at least half the
    sum of both excesses. Where that sum is not positive, the pair is linked whatever they share; then
    x is linked with the member of least excess too, which is the only one it is paired with.
    All other pairs share at least one rare shingle: of D, ordered from rare to frequent, it lies
    among the first |D| - (least number to share) + 1, and only pairs meeting there are returned.
    """
    group = bucketed.select("centre", "node").union(bucketed.select("centre", F.col("centre"))).distinct()
    group = group.join(placed.select(F.col("id").alias("node"), "component"), "node", "left")
    group = group.withColumn("component", F.coalesce("component", "node"))
    # A group of two has one pair, which has been compared.
    parts = group.groupBy("centre").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
    group = group.join(parts.filter("size > 2 AND low < high").select("centre", "size"), "centre")
    own_text = texts.select(F.col("id").alias("node"), "packed").dropDuplicates(["node"])
    group = written(group.join(own_text, "node"), "groups")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (piece for batch in batches for piece in packed_chunks(batch, "packed")):
            value, first = _shingles(piece.column("packed"), shingle)
            repeat = pa.array(np.repeat(np.arange(piece.num_rows), np.diff(first)))
            columns = [piece.column(c).take(repeat) for c in ("centre", "size")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value.view(np.int64))], ["centre", "size", "item"])

    held = group.select("centre", "size", "packed").mapInArrow(spread, "centre long, size long, item long")
    most = held.groupBy("centre", "size", "item").count().filter("2 * count > size")
    reference = most.groupBy("centre").agg(F.sort_array(F.collect_list("item")).alias("reference"))

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (piece for batch in batches for piece in packed_chunks(batch, "packed")):
            value, first = _shingles(piece.column("packed"), shingle)
            own, excess = [np.zeros(0, np.int64)], []
            for row, reference in enumerate(piece.column("reference")):
                x = value[first[row] : first[row + 1]].view(np.int64)
                own.append(np.setxor1d(x, reference.values.to_numpy() if reference.is_valid else x[:0], assume_unique=True))
                excess.append((100 + percent) * len(own[-1]) - (100 - percent) * len(x))
            lists = long_list(np.concatenate(own), np.cumsum([len(d) for d in own]))
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in ("centre", "node", "component")], pa.array(excess, pa.int64()), lists],
                ["centre", "node", "component", "excess", "own"],
            )

    out = "centre long, node long, component long, excess long, own array<long>"
    own = written(group.join(reference, "centre", "left").mapInArrow(differ, out), "differences")
    least = own.groupBy("centre").agg(F.min(F.struct("excess", "node", "component")).alias("least"))
    own = own.join(least, "centre").withColumn("both", F.col("excess") + F.col("least.excess"))
    sure = own.filter("both <= 0 AND component <> least.component").select(F.col("least.node").alias("x"), F.col("node").alias("y"))

    share = F.greatest(F.lit(1), F.ceil(F.col("both") / (2 * (100 + percent))))
    own = own.withColumn("prefix", F.size("own") - share + 1).filter("prefix > 0")
    own = own.select("centre", "node", "component", "excess", "prefix", F.size("own").alias("size"), F.explode("own").alias("item"))
    counted = own.groupBy("centre", "item").count()
    in_order = Window.partitionBy("centre", "node").orderBy("count", "item")
    rare = own.join(counted, ["centre", "item"]).withColumn("place", F.row_number().over(in_order))
    rare = rare.filter("place <= prefix AND count > 1").withColumn("behind", F.col("size") - F.col("place"))
    rare = written(rare.select("centre", "item", "node", "component", "excess", "behind"), "rare")
    # From their first common item on, a pair shares at most what either still has.
    enough = F.least("p.behind", "q.behind") + 1 >= (F.col("p.excess") + F.col("q.excess")) / (2 * (100 + percent))
    met = rare.alias("p").join(
        rare.alias("q"),
        (F.col("p.centre") == F.col("q.centre"))
        & (F.col("p.item") == F.col("q.item"))
        & (F.col("p.node") < F.col("q.node"))
        & (F.col("p.component") != F.col("q.component"))
        & enough,
    )
    found = met.select(F.col("p.node").alias("x"), F.col("q.node").alias("y")).union(sure)
    found = found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return found.join(compared, ["a", "b"], "left_anti")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in chunks(whole, "text")):
        yield pa.RecordBatch.from_arrays([batch.column("id"), pack(batch.column("text"))], ["id", "packed"])


def _shingles(packed: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle sets of packed texts."""
    return shingles(Words(Texts.of(unpack(packed)).lower()), len(packed), shingle)


def _sized(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (piece for batch in batches for piece in packed_chunks(batch, "packed")):
            n = np.diff(_shingles(piece.column("packed"), shingle)[1])
            yield pa.RecordBatch.from_arrays([*piece.select(["id", "packed"]).columns, pa.array(n, pa.int64())], ["id", "packed", "n"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    # Sizes alone bound the similarity from above.
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    sizes = texts.select("id", "n").distinct()
    likely = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
    likely = likely.filter(100 * small >= percent * large).select("a", "b").distinct()
    own = texts.select("id", "packed")
    both = likely.join(own.toDF("a", "left"), "a").join(own.toDF("b", "right"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (piece for batch in batches for piece in packed_chunks(batch, "left", "right")):
            left, at = _shingles(piece.column("left"), shingle)
            right, to = _shingles(piece.column("right"), shingle)
            keep = []
            for row in range(piece.num_rows):
                x, y = left[at[row] : at[row + 1]], right[to[row] : to[row + 1]]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared) > 0)
            yield piece.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, shingle=2)
