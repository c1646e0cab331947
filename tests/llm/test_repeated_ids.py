"""Substring operators on rows that share an id, or have none, against brute force."""

import hashlib
import random
import re

import pytest

from marlstone.llm import automaton_dedup, repeats, suffix_dedup


@pytest.fixture(scope="module")
def lines():
    """(id, text): ids are shared by different and by equal texts, or missing."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 9))) for _ in range(400)]

    def passage(n):
        return " ".join(rng.choices(words, k=n))

    shared = [passage(90) for _ in range(3)]
    out = [(i % 4, f"{passage(30 + 7 * i)} {shared[i % 3]} {passage(20)}") for i in range(12)]
    out += [out[5], out[5], (None, out[2][1]), (None, f"{shared[1]} {passage(15)}"), (None, None), (3, None), (3, "")]
    out += [(9, shared[0]), (9, f"{shared[0]} {shared[0]}"), (10, passage(60)), (10, f"{passage(500)} {shared[2]}")]
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


def byte_result(lines, size=400):
    datas = [(t or "").encode() for _, t in lines]
    seen = {}
    for data in datas:
        for a in range(len(data) - size + 1):
            seen[data[a : a + size]] = seen.get(data[a : a + size], 0) + 1
    out = []
    for (id_, _), data in zip(lines, datas, strict=True):
        gone = bytearray(len(data))
        for a in range(len(data) - size + 1):
            if seen[data[a : a + size]] > 1:
                gone[a : a + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((id_, len(data), sum(gone), spans, sha(kept)))
    return sorted(out, key=repr)


def word_result(lines, size=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in lines]
    least = {}
    for (id_, _), own in zip(lines, words, strict=True):
        for a in range(len(own) - size + 1 if id_ is not None else 0):
            key = tuple(own[a : a + size])
            least[key] = min(least.get(key, id_), id_)
    out = []
    for (id_, _), own in zip(lines, words, strict=True):
        gone = [False] * len(own)
        for a in range(len(own) - size + 1 if id_ is not None else 0):
            if least[tuple(own[a : a + size])] < id_:
                gone[a : a + size] = [True] * size
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((id_, len(own), sum(gone), sha(kept.encode())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [50_000, 2])
@pytest.mark.parametrize("operator, expected", [(suffix_dedup, byte_result), (automaton_dedup, word_result)])
def test_rows_that_share_an_id(spark, lines, monkeypatch, operator, expected, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = spark.createDataFrame(lines, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in operator.remove_repeats(docs).collect()), key=repr)
    assert got == expected(lines)
    assert sum(row[2] for row in got) > 0
