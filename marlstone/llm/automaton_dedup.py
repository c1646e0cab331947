"""Removal of word sequences that an earlier document holds, by suffix automata.

The reference, which is the corpus itself, is cut into shards by the anchors of `repeats`: a shard
holds every run of words that may share a window with another run of it, and nothing that occurs
once only. For each anchor the runs form a suffix automaton, in which each state knows the
smallest document its words come from; all runs are then streamed through it for matching
statistics, and where the longest match covers a whole window of a smaller document, the window is
removed. Equal runs are built and streamed once.

Automata are not broadcast whole: together they are as large as all that repeats in the corpus,
which has no bound. Runs come to the shard that can match them instead, and every shard is
bounded.

Defined results: null text has no words. A row without an id neither loses words nor counts as an
earlier document. Rows of one id, equal or not, do not remove each other's words; each is held against
its own text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.repeats import Units, covered, repeated_windows, word_units

SIZE = 13
_GRAM = 4


class Automaton:
    """Suffix automaton of several word sequences, with the smallest document per state."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [1 << 62]

    def _state(self, length: int, edges: dict[bytes, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.least.append(1 << 62)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes) -> int:
        """The state of length[p] + 1 that p reaches by the word, made where it is missing."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.least[copy] = self.least[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[bytes], document: int) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word)
            else:
                state, p = self._state(self.length[last] + 1, {}, 0), last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = state
                    p = self.link[p]
                if p >= 0:
                    self.link[state] = self._split(p, word)
                last = state
            self.least[last] = min(self.least[last], document)

    def settle(self) -> None:
        """Hand the smallest document of every state on to its suffixes."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.least[state] < self.least[up]:
                self.least[up] = self.least[state]

    def windows(self, words: list[bytes], size: int) -> list[tuple[int, int]]:
        """(start, smallest document) of the windows of the words that the automaton holds."""
        state = length = 0
        out = []
        for end, word in enumerate(words, 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            while length >= size and self.length[self.link[state]] >= size:
                state = self.link[state]
                length = self.length[state]
            if length >= size:
                out.append((end - size, self.least[state]))
        return out


def solve(table: pa.Table) -> pa.Table:
    """Windows of the runs that start in a smaller document, as (id, first, count)."""
    anchors, data = table.column("anchor").to_numpy(), table.column("data").to_pylist()
    ids, first = table.column("id").to_numpy(), table.column("first").to_numpy()
    by_anchor: dict[int, dict[bytes, list[int]]] = {}
    for row, (anchor, piece) in enumerate(zip(anchors.tolist(), data, strict=True)):
        by_anchor.setdefault(anchor, {}).setdefault(b" ".join(piece.split()), []).append(row)
    out: list[tuple[int, int]] = []
    for pieces in by_anchor.values():
        if sum(len(rows) for rows in pieces.values()) < 2:
            continue
        automaton = Automaton()
        for piece, rows in pieces.items():
            automaton.add(piece.split(b" "), int(ids[rows].min()))
        automaton.settle()
        for piece, rows in pieces.items():
            for start, least in automaton.windows(piece.split(b" "), SIZE):
                out.extend((row, start) for row in rows if least < ids[row])
    row, start = (np.array(x, np.int64) for x in (zip(*out, strict=True) if out else ([], [])))
    return pa.table({"id": ids[row], "first": first[row] + start, "count": np.ones(len(row), np.int64), "twin": table.column("twin").take(pa.array(row))})


def _digest(ids: list, units: Units, starts: list[np.ndarray]) -> pa.RecordBatch:
    n_words, removed, kept = [], [], []
    for row, own in enumerate(starts):
        a, b = int(units.first[row]), int(units.first[row + 1])
        gone = covered(own, SIZE, b - a)
        left = np.flatnonzero(~gone) + a
        n_words.append(b - a)
        removed.append(int(gone.sum()))
        words = [units.data[s:e] for s, e in zip(units.start[left].tolist(), units.end[left].tolist(), strict=True)]
        kept.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
        ["id", "n_words", "n_removed", "kept_sha256"],
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row."""
    own = F.col(key).cast("long")
    given = docs.select(own.alias("id"), F.col(text).alias("text"), own.alias("key"))
    schema = "id long, n_words long, n_removed long, kept_sha256 string"
    found = repeated_windows(given, word_units, SIZE, _GRAM, solve, True, _digest, schema, packed=True)
    return found.withColumnRenamed("key", key)


def op6(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
