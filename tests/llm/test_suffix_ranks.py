"""Equal numbers for equal strings only, in the exact step of `suffix_dedup`."""

import numpy as np

from marlstone.llm import suffix_dedup


def test_strings_of_other_residues_are_told_apart_where_zero_bytes_pad_them():
    # Both have the same bytes at their cover positions; what is before and behind differs by zeros only.
    random = np.random.default_rng(3)
    middle = random.integers(1, 255, 12 * suffix_dedup.PERIOD).astype(np.uint8)
    behind = random.integers(1, 255, 26).astype(np.uint8)
    x, zero = np.array([120], np.uint8), np.zeros(1, np.uint8)
    one, two = np.concatenate([x, middle, behind, zero]), np.concatenate([x, zero, middle, behind])
    assert len(one) == len(two) == suffix_dedup.SIZE and not np.array_equal(one, two)
    data = np.zeros(40 * suffix_dedup.PERIOD, np.uint8)
    places = np.array([4, 20 * suffix_dedup.PERIOD + 3])  # one and two bytes before a cover position
    for place, text in zip(places.tolist(), (one, two), strict=True):
        data[place : place + len(text)] = text
    assert len(set(suffix_dedup.equal_windows(data, places).tolist())) == 2


def test_equal_windows_are_those_of_equal_bytes():
    random = np.random.default_rng(5)
    period = suffix_dedup.PERIOD
    text = random.integers(0, 3, 20 * period).astype(np.uint8)
    other = text.copy()
    other[11 * period] += 1
    data = np.concatenate([text, other, text, np.zeros(64, np.uint8)])
    places = np.concatenate([k * 20 * period + np.arange(200) for k in range(3)])
    got = suffix_dedup.equal_windows(data, places)
    strings = [data[p : p + suffix_dedup.SIZE].tobytes() for p in places.tolist()]
    assert len(set(got.tolist())) == len(set(strings)) == len(set(zip(got.tolist(), strings, strict=True)))


def test_ranks_follow_the_order_of_tuples():
    random = np.random.default_rng(7)
    for n in (0, 1, 2, 500):
        keys = [random.integers(0, 4, n) for _ in range(5)]
        tuples = list(zip(*[k.tolist() for k in keys], strict=True))
        order = sorted(set(tuples))
        assert suffix_dedup._ids(*keys).tolist() == [order.index(t) for t in tuples]
