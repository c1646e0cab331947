"""Exact k-means against a plain version, and the zone maps against all distances."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, v int, low double"
WIDTH = 5


def hashed(column):
    return F.sha2(F.concat(F.lit("3:"), column.cast("string")), 256)


def plain(rows, k, rounds, scale=1024):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == WIDTH and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(scale * x) for x in vector]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, members in groups.items():
            centres[i] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(vec_id, *nearest(v)[::-1]) for vec_id, v in kept]
    inertia = Counter()
    for _, cluster, distance in found:
        inertia[cluster] += distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found)


def rows(count, seed=13):
    rng = random.Random(seed)
    heads = [[rng.gauss(0, 1) for _ in range(WIDTH)] for _ in range(4)]
    out = [(i, [x + rng.gauss(0, 0.2) for x in heads[i % 4]]) for i in range(count)]
    out += [(1000 + i, [0.25] * WIDTH) for i in range(count)]
    out += [(7, [0.5, 0.0, -0.5, 0.001, -0.001]), (7, [3.0] * WIDTH), (None, [1.0] * WIDTH), (None, None), (8, [])]
    return out + [(9, [1.0] * 4), (10, [1.0] * 6), (11, [1.0, None, 1.0, 1.0, 1.0]), (12, [math.nan] * 5), (13, [math.inf] * 5)]


def frame(spark, given):
    return spark.createDataFrame([(*row, 1, "c", 2, 0.5) for row in given], SCHEMA).repartition(4)


def clustered(df, k=3, rounds=4, scale=1024):
    vectors = centroids.whole_vectors(df, WIDTH, scale)
    return Counter(map(tuple, centroids.k_means(vectors, k, rounds, WIDTH, hashed).collect()))


@pytest.mark.parametrize(("count", "k"), [(400, 3), (600, 8), (0, 3)])
def test_clusters_equal_plain_k_means(spark, count, k):
    given = rows(count)
    assert clustered(frame(spark, given), k) == plain(given, k, 4)


def test_fewer_vectors_than_centroids_equal_vectors_and_none(spark):
    few = [(1, [1.0] * 5), (2, [1.0] * 5), (3, [2.0] * 5)]
    assert clustered(frame(spark, few), 8) == plain(few, 8, 4)
    assert clustered(frame(spark, [(1, None), (2, [1.0])])) == Counter()
    assert clustered(frame(spark, few).filter(F.lit(False))) == Counter()


def test_large_components_are_exact_or_refused(spark):
    big = [(i, [(-1) ** i * 2.0**26, 2.0**26 - i, 0.0, 1.0, float(i)]) for i in range(40)]
    assert clustered(frame(spark, big), 3, 4, 1) == plain(big, 3, 4, 1)
    with pytest.raises(Exception, match="larger than"):
        clustered(frame(spark, [(1, [1e30] * 5)]))


def test_boxes_never_lose_the_nearest_centroid():
    rng = np.random.default_rng(3)
    for spread in (3, 30, 300):
        x = rng.integers(-spread, spread, (200, 6))
        centres = rng.integers(-100, 100, (9, 6))
        square = ((x[:, None] - centres[None]) ** 2).sum(2)
        may = centroids.candidates(x.min(0)[None], x.max(0)[None], centres)[0]
        assert may[np.flatnonzero((square == square.min(1)[:, None]).any(0))].all()
        assert spread > 3 or not may.all()


def test_the_curve_visits_every_cell_and_moves_by_one():
    for width, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * width), axis=-1).reshape(-1, width)
        keys = centroids.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
