"""Connected components of a graph given as pairs of ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.sources.scratch import written


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b), component being the smallest id it reaches.

    Every partition first reduces its own links to a forest by union-find. Large and small stars
    then pull all ids of a component to its smallest one; their rounds grow with the logarithm of
    the diameter. Minima are taken before rows are moved, so a hub costs no more than other ids.
    """
    forest = links.select("a", "b").filter("a <> b").mapInArrow(_forests, "a long, b long")
    edges, before = written(forest.distinct(), "links"), None
    while True:
        edges = written(_small_star(_large_star(edges)).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            break
        before = now
    # What is left are stars around the smallest id.
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    below = [x for x in parent if parent[x] != x]
    a, b = np.array(below, np.int64), np.array([root(x) for x in below], np.int64)
    yield pa.RecordBatch.from_pydict({"a": a, "b": b})


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of u with the smallest of u and its neighbours."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours with the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).filter("a <> b")
