"""Memory of the steps that look for repeated windows, counted in numpy's allocations."""

import tracemalloc

import numpy as np
import pyarrow as pa

from marlstone.llm import repeats, suffix_dedup


def peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def texts(rows: int, size: int) -> list[str]:
    rng = np.random.default_rng(7)
    return [rng.integers(97, 123, size).astype(np.uint8).tobytes().decode() for _ in range(rows)]


def test_anchors_of_a_large_batch_take_bounded_memory():
    batch = pa.RecordBatch.from_pydict({"id": list(range(1500)), "text": texts(1500, 2000)})
    units = []
    repeats._power(repeats._P, 1 << 20)
    repeats._power(pow(repeats._P, -1, 1 << 64), 1 << 20)

    def work():
        for part in repeats.anchor_rows(iter([batch]), repeats.byte_units, 400, 32):
            units.append(part.num_rows)

    assert peak(work) < 40 << 20
    assert sum(units) >= 1500


def test_buckets_of_suffixes_take_bounded_memory():
    one = texts(3000, 600)
    n = len(one)
    table = pa.table(
        {
            "anchor": np.arange(n) // 2, "id": np.arange(n), "first": np.zeros(n, np.int64),
            "count": np.full(n, 201), "ahead": np.zeros(n, np.int64),
            "data": pa.array([one[i // 2 * 2].encode() for i in range(n)], pa.binary()), "twin": np.zeros(n, np.int64),
        }
    )
    found = []
    assert peak(lambda: found.append(suffix_dedup.solve(table))) < 100 << 20
    assert sorted(found[0].column("id").to_pylist()) == list(range(n))
    assert set(found[0].column("count").to_pylist()) == {201}
