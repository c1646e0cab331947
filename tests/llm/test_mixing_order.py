"""The second layer of `mixing`: texts read in order, weights that move along each of them."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from marlstone.llm import mixing


def _block(texts: list[list[bytes]]) -> dict:
    names = [*sorted({w for t in texts for w in t}), mixing.END]
    at = {w: i for i, w in enumerate(names)}
    press = zstandard.ZstdCompressor().compress
    seq = np.array([at[w] for t in texts for w in [*t, mixing.END]], np.uint32)
    return {"words": press(b" ".join(names)), "seq": press(seq.tobytes()), "held": [i % 2 == 1 for i in range(len(texts))]}


def _texts(seed: int) -> list[list[bytes]]:
    rng = random.Random(seed)
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 6))) for _ in range(30)]
    return [[rng.choice(words) for _ in range(n)] for n in (40, 0, 1, 200, 7, 40)]


def test_weights_move_along_each_text():
    texts = _texts(1)
    stream = mixing.Stream(_block(texts))
    rng = np.random.default_rng(2)
    words = rng.integers(-12, 13, (len(stream.data), 8)).astype(np.int8)
    across = rng.integers(-12, 13, 1 << mixing.ACROSS_LOG2 + 8).astype(np.int8)
    got = mixing.along(stream, words.view(np.uint64).ravel(), across)
    expected = np.zeros(len(texts))
    squash = lambda x: 1 / (1 + np.exp(-x))
    row, place, at, slot = (np.concatenate(x) for x in zip(*stream.pieces(), strict=True))
    inside = mixing.run_index(stream.size)
    for text in range(len(texts)):
        mine = np.flatnonzero(row == text)
        assert place[mine].tolist() == list(range(len(mine)))
        weight, right, seen = np.tile(mixing.START, (mixing.PLACES, 1)), Counter(), Counter()
        for begin in range(0, len(mine), mixing.STRIDE):
            slope, sides = np.zeros_like(weight), []
            for i in mine[begin : begin + mixing.STRIDE].tolist():
                byte, gate = int(stream.data[at[i]]), min(inside[at[i]], mixing.PLACES - 1)
                for bit in range(8):
                    node, sign = 1 << bit | byte >> 8 - bit, 1 if byte >> 7 - bit & 1 else -1
                    x = np.array([mixing._LOGIT[words[at[i], bit]], sign * mixing._LOGIT[across[(int(slot[i]) << 8) + node]]], float)
                    logit = float(np.clip((weight[gate] * x).sum(), -12, 12))
                    side = round(logit)
                    p = squash(logit)
                    if side:
                        middle = squash(abs(side))
                        shift = ((right[abs(side)] + mixing._INERTIA * middle) / (seen[abs(side)] + mixing._INERTIA) - middle) / 2
                        p += shift if side > 0 else -shift
                    expected[text] += np.log(p)
                    slope[gate] += (1 - squash(logit)) * x
                    sides.append(side)
            weight += mixing._RATE * slope
            right.update(s for s in sides if s > 0)
            seen.update(abs(s) for s in sides if s)
    assert got == pytest.approx(expected, rel=1e-3)


def test_contexts_across_words_are_counted_on_training_texts_only():
    texts = _texts(3)
    row = _block(texts)
    parts = pa.Table.from_batches(mixing._count_across([pa.RecordBatch.from_pylist([row])]))
    total = np.zeros((mixing.ACROSS_PARTS, (1 << mixing.ACROSS_LOG2 + 8) // mixing.ACROSS_PARTS), np.uint32)
    for part, counts in zip(parts["part"].to_pylist(), parts["counts"].to_pylist(), strict=True):
        total[part] += mixing._unpack(counts, np.uint32)
    pairs = Counter()
    for text in texts[::2]:
        for before, word in zip([b"", *text], [*text, mixing.END], strict=True):
            whole = word if word == mixing.END else word + b" "
            pairs.update((before, whole[:i], whole[i]) for i in range(len(whole)))
    assert total.sum() == sum(pairs.values())
    assert sorted(total[total > 0].tolist()) == sorted(pairs.values())


def test_probability_of_either_bit_sums_to_one():
    stream = mixing.Stream(_block([[b"ab", b"b"]]))
    rng = np.random.default_rng(5)
    words = rng.integers(-12, 13, (len(stream.data), 8)).astype(np.int8)
    across = np.zeros(1 << mixing.ACROSS_LOG2 + 8, np.int8)
    last = words.copy()
    last[-1, -1] *= -1
    one, other = (mixing.along(stream, w.view(np.uint64).ravel(), across)[0] for w in (words, last))
    words[-1, -1] = 0
    without = mixing.along(stream, words.view(np.uint64).ravel(), across)[0] - np.log(0.5)
    assert np.exp(one - without) + np.exp(other - without) == pytest.approx(1, abs=1e-3)


def test_order_and_repetition_count(spark):
    rng = random.Random(6)
    pairs = [("alpha", "beta"), ("gamma", "delta"), ("epsilon", "zeta")]
    train = [" ".join(w for _ in range(60) for w in rng.choice(pairs)) for _ in range(40)]
    text = " ".join(w for _ in range(10) for w in rng.choice(pairs))
    turned = " ".join(reversed(text.split()))
    rows = [(0, text), (1, turned), (2, None), (None, text), (0, text), *((i + 10, t) for i, t in enumerate(train))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in mixing.score_in_order(frame, "doc_id", "text", F.col("doc_id") < 10).collect()]
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].word_score == pytest.approx(by_id[1].word_score)
    assert by_id[0].score > by_id[1].score + 1
    assert by_id[0].score > by_id[0].word_score
    assert by_id[None].score == by_id[0].score and sum(r.doc_id == 0 for r in got) == 2
    assert by_id[2].n_tokens == 1
