"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is its words in lower case, each followed by a space, and an end mark. Every bit of every
byte is predicted by several tables, each counting ones and zeros after a context: the last
byte, the last two, the last three, or all of the word so far, always with the bits of the byte
that are known. The logits of the predictions are added with weights chosen by a gate (how often the
word so far was seen, the place in the word and the bit), and a last table refines the mixed
probability by what followed it before. The product over all bits is the probability of the text,
its logarithm over bytes the bits per byte.

That is the first layer. Its contexts end at the start of a word, so each distinct word is worked on
once, counted as often as it occurs: the corpus is reduced to its vocabulary, whose size grows with it.
The vocabulary is sorted and cut into shelves. Counts of the word so far are exact and as many as the
vocabulary has beginnings: a shelf holds all words that begin alike, but for the beginnings of its first
and last word, whose counts are summed over all shelves. Only the low contexts, which bytes bound, are
hashed into fixed tables.

The second layer reads every document in order. It mixes the first layer's logit of each bit with that
of a context across words, the word before and the word so far, hashed and counted over the training
documents. Both weights, by place in the word, move down the gradient along the document, and so does a
table that refines the mixed probability by how often its side was right in this document. They move
every STRIDE bytes, so that the documents of a block are worked on side by side; each begins anew.

Weights and refinement of the first layer are learned from every training word, weighted by its count and predicted from
all other words: a fixed number of turns of Newton's method and one pass for the refinement, each a
sum over all shelves. Documents fetch counts and logits of their words in blocks: a block asks for each
of its words once, and a shelf answers a block in one row.

Defined results: null text is empty and has the end only. Repeated rows and rows without an id are
scored each for itself; a row without an id is learned from. An empty training set gives every bit
probability 1/2 before refinement. Logits go from layer to layer in one byte each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import GOLDEN, Texts, Words, chunks, mix, run_hashes, run_index
from marlstone.llm.language import remainder
from marlstone.sources.scratch import written

BLOCK_BYTES = 4 << 20
# Sorted words worked on together.
SHELF_WORDS, SHELF_BYTES = 8192, 1 << 17
# Rows of a word and a block that are cut into shelves together.
_SHELF_ROWS = 1 << 17
CONTEXTS = 4
SLOTS_LOG2 = 20
# Slots of the contexts of one, two and three bytes; behind them are those of the word so far.
LOW = CONTEXTS - 1 << SLOTS_LOG2
PLACES, LEVELS = 4, 10
GATES = LEVELS * PLACES * 8
# Turns of Newton's method over all training words.
TURNS = 2
_STEPS = 24
_LIMIT = 12.0
_BYTES_AT_ONCE = 1 << 12
END = b"\n"
# The second layer: contexts across words, and bytes of a document between two moves of its weights.
ACROSS_LOG2, ACROSS_PARTS = 15, 64
STRIDE = 16
# Weights of both inputs at the start, how fast they move, and steps and inertia of the refinement.
START = (0.8, 0.4)
_RATE = 0.01
_SIDES, _INERTIA = 12, 30.0
_STREAM_BYTES = 1 << 18
# Logits on their way are coded by a byte each, in steps of a quarter about 0 and wider ones further off.
_CODE_STEP = 0.25
_LOGIT = np.sinh(np.arange(256, dtype=np.uint8).view(np.int8) * _CODE_STEP).clip(-_LIMIT, _LIMIT).astype(np.float32)
# Node of the tree over bytes that each bit of a byte leaves from, and the bit as a sign.
_NODE = (1 << np.arange(8)) | (np.arange(256)[:, None] >> (8 - np.arange(8)))
_NODE = _NODE.astype(np.int32)
_SIGN = (np.unpackbits(np.arange(256, dtype=np.uint8)).reshape(-1, 8) * 2.0 - 1).astype(np.float32)
# What stands behind the end of a text has no sign, so that it moves nothing.
_NODE, _SIGN = np.vstack([_NODE, np.ones((1, 8), np.int32)]), np.vstack([_SIGN, np.zeros((1, 8), np.float32)])


class Places:
    """The bytes of words and their spaces, and what stands before each."""

    def __init__(self, words: list[bytes]):
        whole = [w if w == END else w + b" " for w in words]
        size = np.array([len(w) for w in whole], np.int64)
        self.data = np.frombuffer(b"".join(whole), np.uint8)
        self.word = np.repeat(np.arange(len(whole)), size)
        start = np.repeat(np.cumsum(size) - size, size)
        here = np.arange(len(self.data))
        self.place = here - start
        before = [np.zeros(len(self.data), np.uint64) for _ in range(3)]
        for back, value in enumerate(before, 1):
            inside = self.place >= back
            value[inside] = self.data[np.flatnonzero(inside) - back] + np.uint64(1)
        two = before[0] << np.uint64(9) | before[1]
        self.low = [before[0], mix(two + GOLDEN), mix(two << np.uint64(9) | before[2] | np.uint64(1 << 40))]
        # A context by its 64 bits; it shares its counts with no other.
        self.prefix = run_hashes(self.data, start, here)
        # Words that begin alike share these bytes: `edge` numbers them, `edges` has the first of each.
        # Sorted words have them in neighbours; others are only worked on more often.
        behind = run_hashes(self.data, start, here + 1)
        above = here - np.repeat(np.concatenate([[0], size[:-1]]), size)
        inside = (self.word > 0) & (self.place < np.repeat(np.concatenate([[0], size[:-1]]), size))
        fresh = np.ones(len(here), bool)
        fresh[inside] = behind[inside] != behind[above[inside]]
        order = np.argsort(self.place.astype(np.uint16) if size.max(initial=0) < 1 << 16 else self.place, kind="stable")
        self.edge = np.empty(len(here), np.int64)
        self.edge[order] = np.cumsum(fresh[order]) - 1
        self.edges = order[fresh[order]]

    def times(self, times: np.ndarray) -> np.ndarray:
        """How often each edge occurs."""
        return np.bincount(self.edge, times[self.word], len(self.edges)).astype(np.int64)

    def bits(self, at: slice | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(slot of each low context, bit, gate, known bits, word) of every bit of some of the bytes."""
        bit = np.unpackbits(self.data[at]).reshape(-1, 8)
        known = np.ones((len(bit), 8), np.int64)
        for i in range(1, 8):
            known[:, i] = known[:, i - 1] * 2 + bit[:, i - 1]
        one, *more = (context[at] for context in self.low)
        slots = [(one.astype(np.int64)[:, None] * 256 + known).ravel()]
        step = known.astype(np.uint64) * GOLDEN
        for number, context in enumerate(more, 1):
            slots.append((context[:, None] + step >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64).ravel() + (number << SLOTS_LOG2))
        gate = (np.minimum(self.place[at], PLACES - 1)[:, None] * 8 + np.arange(8)).ravel()
        return np.stack(slots), bit.ravel(), gate, known.ravel(), np.repeat(self.word[at], 8)

    def ends(self) -> np.ndarray:
        """Which bytes stand behind the beginning of the first or the last word, which other shelves may share."""
        last = self.word[-1:]
        return np.isin(self.prefix, self.prefix[(self.word == 0) | (self.word == last)])

    def so_far(self, times: np.ndarray, prefix: np.ndarray, byte: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(zeros, ones) x byte x bit: what followed the word so far and the known bits."""
        return self.so_far_of_edges(times, prefix, byte, n)[:, self.edge]

    def so_far_of_edges(self, times: np.ndarray, prefix: np.ndarray, byte: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(zeros, ones) x edge x bit.

        times is how often each word occurs. Behind the beginnings at the ends of the shelf, n times byte
        after prefix counts instead: that is the sum over all shelves.
        """
        first = self.edges
        own = np.where(self.ends()[first], 0, self.times(times))
        count = np.concatenate([own, n])
        node = np.unique(np.concatenate([self.prefix[first], prefix]), return_inverse=True)[1]
        edge = node << 8 | np.concatenate([self.data[first], byte]).astype(np.int64)
        order = np.argsort(edge, kind="stable")
        edge = edge[order]
        total = np.concatenate([[0], np.cumsum(count[order])])
        seen = np.empty((9, len(edge)), np.int64)
        for bits in range(9):
            part = edge >> 8 - bits
            begin = np.flatnonzero(np.diff(part, prepend=-1))
            stop = np.append(begin[1:], len(part))
            seen[bits, order] = np.repeat(total[stop] - total[begin], stop - begin)
        seen = seen[:, : len(first)]
        ones = np.unpackbits(self.data[first]).reshape(-1, 8).T == 1
        same, other = seen[1:], seen[:-1] - seen[1:]
        return np.stack([np.where(ones, other, same).T, np.where(ones, same, other).T]).astype(np.float32)


def _bits(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like `Places.bits`, of all bytes, with a hashed slot of the word so far."""
    places = Places(words)
    slots, bit, gate, known, word = places.bits(slice(None))
    own = mix(places.prefix[:, None] + known.reshape(-1, 8).astype(np.uint64) * GOLDEN) >> np.uint64(64 - SLOTS_LOG2)
    return np.vstack([slots, own.astype(np.int64).ravel() + LOW]), bit, gate, known, word


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -_LIMIT, _LIMIT)))


@dataclass
class Mixer:
    low: np.ndarray  # zeros and ones x slot of the low contexts
    own: np.ndarray  # zeros and ones x slot of the word so far
    weight: np.ndarray  # gate x context
    refined: np.ndarray  # known bits x step of the logit

    @staticmethod
    def new(counts: np.ndarray) -> Mixer:
        weight = np.full((GATES, CONTEXTS), 1.0 / CONTEXTS)
        # Until something else is learned, a word begun often is trusted most.
        weight[:, -1] += 0.6 * np.repeat(np.arange(LEVELS) / LEVELS, PLACES * 8)
        weight[:, :-1] -= 0.2 * np.repeat(np.arange(LEVELS) / LEVELS, PLACES * 8)[:, None]
        refined = np.tile(_squash(np.linspace(-_LIMIT, _LIMIT, _STEPS + 1)), (256, 1))
        return Mixer(counts[:, :LOW].astype(np.float32), counts[:, LOW:].astype(np.float32), weight, refined)

    def mixed(self, slots: np.ndarray, gate: np.ndarray, left_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit, what went into it, and the full gate; left_out are bits that each count once less."""
        counts = np.empty((2, *slots.shape), np.float32)
        for value in (0, 1):
            np.take(self.low[value], slots[:-1], out=counts[value, :-1], mode="clip")
            np.take(self.own[value], slots[-1] - LOW, out=counts[value, -1], mode="clip")
        if left_out is not None:
            counts[0] -= left_out == 0
            counts[1] -= left_out == 1
            np.maximum(counts, 0, out=counts)
        zeros, ones = counts
        level = np.minimum(np.frexp(1 + zeros[-1] + ones[-1])[1] - 1, LEVELS - 1).astype(np.int64)
        inputs = np.clip(np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4))), np.float32(-_LIMIT), np.float32(_LIMIT))
        gate = level * (PLACES * 8) + gate
        return sum(x * weight[gate] for x, weight in zip(inputs, self.weight.astype(np.float32).T.copy(), strict=True)), inputs, gate

    def probability(self, slots: np.ndarray, gate: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Of a one, for every bit."""
        logit, _, _ = self.mixed(slots, gate)
        low, part = _steps(logit)
        refined = self.refined[known, low] * (1 - part) + self.refined[known, low + 1] * part
        return np.clip((_squash(logit) + refined) / 2, 1e-6, 1 - 1e-6)

    def slopes(self, slots: np.ndarray, bit: np.ndarray, gate: np.ndarray, times: np.ndarray) -> np.ndarray:
        """First and second derivatives of the log likelihood by the weights, gate by gate.

        A word is predicted from all others: else a beginning seen once would foretell itself.
        """
        total, inputs, gate = self.mixed(slots, gate, bit)
        one = _squash(total)
        error, bend = (bit - one) * times, one * (1 - one) * times
        out = [np.bincount(gate, error * x, GATES) for x in inputs]
        for a in range(CONTEXTS):
            more = bend * inputs[a]
            out += [np.bincount(gate, more * inputs[b], GATES) for b in range(a, CONTEXTS)]
        return np.stack(out)

    def moved(self, slopes: np.ndarray, start: np.ndarray) -> Mixer:
        """One turn of Newton's method; the weights are drawn to the start like by one more word."""
        bend = np.zeros((GATES, CONTEXTS, CONTEXTS))
        a, b = np.triu_indices(CONTEXTS)
        bend[:, a, b] = bend[:, b, a] = slopes[CONTEXTS:].T
        first = slopes[:CONTEXTS].T - (self.weight - start)
        step = np.linalg.solve(bend + np.eye(CONTEXTS), first[:, :, None])[:, :, 0]
        return replace(self, weight=self.weight + np.clip(step, -1, 1))

    def followed(self, slots: np.ndarray, bit: np.ndarray, gate: np.ndarray, known: np.ndarray, times: np.ndarray) -> np.ndarray:
        """(ones, bits) that followed each entry of the refinement table."""
        low, part = _steps(self.mixed(slots, gate, bit)[0])
        out = np.zeros((2, 256 * (_STEPS + 1)))
        for at, own in ((low, (1 - part) * times), (low + 1, part * times)):
            out += [np.bincount(known * (_STEPS + 1) + at, x, out.shape[1]) for x in (bit * own, own)]
        return out

    def refined_by(self, followed: np.ndarray) -> Mixer:
        hits, seen = followed.reshape(2, 256, _STEPS + 1)
        return replace(self, refined=(hits + self.refined * 4) / (seen + 4))


def _steps(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = (np.clip(logit, -_LIMIT, _LIMIT) + _LIMIT) / (2 * _LIMIT) * _STEPS
    low = np.minimum(at.astype(np.int64), _STEPS - 1)
    return low, at - low


def learn(counts: np.ndarray, words: list[bytes], times: np.ndarray) -> Mixer:
    """Gate weights and the refinement table of words at hand, with hashed slots for all contexts."""
    slots, bit, gate, known, word = _bits(words)
    mixer = start = Mixer.new(counts)
    for _ in range(TURNS):
        mixer = mixer.moved(mixer.slopes(slots, bit, gate, times[word]), start.weight)
    return mixer.refined_by(mixer.followed(slots, bit, gate, known, times[word]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in (piece for whole in batches for piece in chunks(whole, "text", BLOCK_BYTES)):
        hashes, docs, known, names, size = [], [], [], [], []
        for piece in chunks(batch, "text"):
            texts = Texts.of(piece.column("text")).lower()
            words = Words(texts)
            value, at = np.unique(words.hash, return_index=True)
            data = texts.data.tobytes()
            names += [data[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)]
            known.append(value)
            hashes.append(words.hash)
            docs.append(words.doc + sum(map(len, size)))
            size.append(np.diff(texts.starts))
        doc, size = np.concatenate(docs), np.concatenate(size)
        inverse = np.unique(np.concatenate(hashes), return_inverse=True)[1]
        names = pa.array([names[i] for i in np.unique(np.concatenate(known), return_index=True)[1].tolist()], pa.binary())
        # In the order of the shelves, so that a shelf's answers stand together.
        order = pc.array_sort_indices(names).to_numpy()
        names = names.take(pa.array(order)).to_pylist()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        inverse = rank[inverse]
        learned = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        # The end is one more word of every row.
        names.append(END)
        times = np.bincount(inverse, learned[doc], len(names)).astype(np.int64)
        times[-1] = learned.sum()
        # The words in order, the end behind each row.
        seq = np.insert(inverse, np.cumsum(np.bincount(doc, minlength=len(size))), len(names) - 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number]), pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                pa.array([(~learned).tolist()], pa.list_(pa.bool_())), pa.array([size.tolist()], pa.list_(pa.int64())),
                pa.array([pack(seq.astype(np.uint32).tobytes())]),
                pa.array([pack(b" ".join(names))]), pa.array([pack(times.tobytes())]),
            ],
            ["block", "ids", "held", "bytes", "seq", "words", "times"],
        )
        number += 1


_BLOCK = (
    "block long, ids array<long>, held array<boolean>, bytes array<long>, seq binary, words binary, times binary"
)


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word of every block, with its place there."""
    for batch in batches:
        for block, words, times in zip(*[batch.column(c).to_pylist() for c in ("block", "words", "times")], strict=True):
            names = pa.array(zstandard.ZstdDecompressor().decompress(words).split(b" "), pa.binary())
            at = pa.array(np.arange(len(names), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([names, pa.array(_unpack(times, np.int64)), pa.array(np.full(len(names), block)), at], ["word", "n", "block", "at"])


def _shelves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words in packed runs of bounded size, and which block uses which word at which place, block by block.

    A word's rows are neighbours; if they are cut by the end of a batch, they wait for the next.
    """
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    press = zstandard.ZstdCompressor(level=3).compress

    def cut(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal number
        word = rows.column("word").combine_chunks()
        coded = pc.dictionary_encode(word)
        code, names = coded.indices.to_numpy(), coded.dictionary
        n = np.bincount(code, rows.column("n").to_numpy(), len(names)).astype(np.int64)
        block, place = rows.column("block").to_numpy(), rows.column("at").to_numpy()
        begin = np.searchsorted(code, np.arange(len(names) + 1))
        size = np.cumsum(pc.binary_length(names).to_numpy() + 1)
        at = 0
        while at < len(names):
            most = np.searchsorted(size, (size[at - 1] if at else 0) + SHELF_BYTES, side="right")
            to = max(at + 1, min(at + SHELF_WORDS, int(most)))
            uses = slice(begin[at], begin[to])
            count = n[at:to]
            order = np.argsort(block[uses], kind="stable")
            used = [press(np.diff(x[uses][order], prepend=0).astype(kind).tobytes()) for x, kind in ((code - at, np.int32), (block, np.int64), (place, np.int32))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), pa.array([count.sum()]), pa.array([np.count_nonzero(count)]), pa.array([press(count.tobytes())]),
                    pa.array([press(b" ".join(names.slice(at, to - at).to_pylist()))]), *[pa.array([x]) for x in used],
                ],
                ["shelf", "tokens", "distinct", "n", "words", "uses", "blocks", "ats"],
            )
            number += 1
            at = to

    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        held += batch.num_rows
        if held < _SHELF_ROWS:
            continue
        rows = pa.Table.from_batches(waiting)
        word = rows.column("word").combine_chunks()
        last = pc.equal(word, word[-1])
        keep = int(pc.index(last, True).as_py())
        if keep:
            yield from cut(rows.slice(0, keep))
        waiting = rows.slice(keep).combine_chunks().to_batches()
        held = sum(b.num_rows for b in waiting)
    if waiting:
        yield from cut(pa.Table.from_batches(waiting))


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Places, np.ndarray]]:
    """(row, places, how often each word occurs) of every shelf."""
    for batch in batches:
        for number in range(batch.num_rows):
            row = batch.slice(number, 1).to_pylist()[0]
            words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b" ")
            yield row, Places(words), _unpack(row["n"], np.int64)


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What follows the beginnings that a shelf may share with others."""
    for row, places, times in _opened(batches):
        at = np.flatnonzero(places.ends())
        key = np.unique(np.stack([places.prefix[at].view(np.int64), places.data[at].astype(np.int64)]), axis=1, return_inverse=True)
        n = np.bincount(key[1].ravel(), times[places.word[at]]).astype(np.int64)
        shelf = np.full(len(n), row["shelf"])
        yield pa.RecordBatch.from_arrays([pa.array(shelf), pa.array(key[0][0]), pa.array(key[0][1].astype(np.int32)), pa.array(n)], ["shelf", "prefix", "byte", "n"])


def _count_low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, LOW))
    flat = total.reshape(-1)
    for _, places, times in _opened(batches):
        n = places.times(times).astype(float)
        for at in _cuts(places):
            slots, bit, *_ = places.bits(places.edges[at])
            for own in slots:
                np.add.at(flat, own + bit * np.int64(LOW), np.repeat(n[at], 8))
    at = np.flatnonzero(total.any(0))
    yield pa.RecordBatch.from_pydict({"slot": at, "zeros": total[0][at], "ones": total[1][at]})


def _cuts(places: Places) -> Iterator[slice]:  # of its edges
    return (slice(at, at + _BYTES_AT_ONCE) for at in range(0, len(places.edges), _BYTES_AT_ONCE))


def _exact(row: dict, places: Places, times: np.ndarray, mixer: Mixer) -> Iterator[tuple[Mixer, tuple[np.ndarray, ...]]]:
    """Bits of the edges of a shelf, with a mixer that has the counts of each bit's own beginning, and their edges."""
    shared = row["shared"] or []
    prefix = np.array([s["prefix"] for s in shared], np.int64).view(np.uint64)
    byte, n = (np.array([s[c] for s in shared], np.int64) for c in ("byte", "n"))
    own = places.so_far_of_edges(times, prefix, byte, n)
    for at in _cuts(places):
        slots, bit, gate, known, _ = places.bits(places.edges[at])
        now = own[:, at].reshape(2, -1)
        edge = np.repeat(np.arange(at.start, at.start + now.shape[1] // 8), 8)
        yield replace(mixer, own=now), (np.vstack([slots, LOW + np.arange(now.shape[1])]), bit, gate, known, edge)


class _Sent:
    """A mixer whose table of the low contexts is sent once."""

    def __init__(self, low: Broadcast, mixer: Mixer):
        self.low, self.weight, self.refined = low, mixer.weight, mixer.refined

    @property
    def value(self) -> Mixer:
        return Mixer(self.low.value, np.zeros((2, 0), np.float32), self.weight, self.refined)


def _slopes(mixer: Mixer, slots: np.ndarray, bit: np.ndarray, gate: np.ndarray, known: np.ndarray, times: np.ndarray) -> np.ndarray:
    return mixer.slopes(slots, bit, gate, times)


def _summed(shelves: DataFrame, sent: _Sent, of: Callable[..., np.ndarray], size: int) -> np.ndarray:
    """Sum over all training words of what `of` gives for (mixer, slots, bit, gate, known, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for row, places, times in _opened(batches):
            n = places.times(times)
            for mixer, bits in _exact(row, places, times, sent.value):
                slots, bit, gate, known, edge = bits
                used = np.flatnonzero(n[edge])
                if len(used):
                    total += of(mixer, slots[:, used], bit[used], gate[used], known[used], n[edge[used]]).ravel()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": at, "value": total[at]})

    sums = shelves.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[sums.column("at").to_numpy()] = sums.column("value").to_numpy()
    return out


class Stream:
    """The words of a block in order, the end behind each row."""

    def __init__(self, row: dict):
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["words"]), np.uint8)
        # Every word but the last, the end, is followed by a space.
        space = np.flatnonzero(self.data == 32)
        self.start = np.concatenate([[0], space + 1])
        self.size = np.diff(np.append(self.start, len(self.data)))
        self.hash = run_hashes(self.data, self.start, self.start + np.maximum(self.size - 1, 1))
        self.prefix = run_hashes(self.data, np.repeat(self.start, self.size), np.arange(len(self.data)))
        self.seq = _unpack(row["seq"], np.uint32).astype(np.int32)
        # Number of the first word of each row, and the end.
        self.first = np.concatenate([[0], np.flatnonzero(self.seq == len(self.size) - 1) + 1])
        total = np.concatenate([[0], np.cumsum(self.size[self.seq])])
        self.length = np.diff(total[self.first])

    def pieces(self, rows: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row, place in the row, place in `data`, context across words) of every byte, some words at a time."""
        before = np.zeros(len(self.seq), np.uint64)
        before[1:] = self.hash[self.seq[:-1]]
        before[self.first[:-1]] = 0
        row = np.repeat(np.arange(len(self.length), dtype=np.int32), np.diff(self.first))
        size = self.size[self.seq]
        begin = np.cumsum(size) - size
        begin -= np.repeat(begin[self.first[:-1]], np.diff(self.first))
        take = np.arange(len(size)) if rows is None else np.flatnonzero(rows[row])
        done = np.cumsum(size[take])
        for words in np.split(take, np.searchsorted(done, np.arange(_STREAM_BYTES, int(done[-1]) if len(done) else 0, _STREAM_BYTES))):
            n = size[words]
            place = run_index(n)
            at = np.repeat(self.start[self.seq[words]], n) + place
            slot = mix(np.repeat(mix(before[words] + GOLDEN), n) + self.prefix[at]) >> np.uint64(64 - ACROSS_LOG2)
            yield np.repeat(row[words], n), np.repeat(begin[words], n) + place, at, slot.astype(np.uint16)


def _count_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each byte followed each context across words, in packed parts."""
    total = np.zeros(1 << ACROSS_LOG2 + 8, np.uint32)
    for batch in batches:
        for number in range(batch.num_rows):
            row = batch.slice(number, 1).to_pylist()[0]
            stream = Stream(row)
            for _, _, at, slot in stream.pieces(~np.array(row["held"], bool)):
                np.add.at(total, slot.astype(np.int64) << 8 | stream.data[at], np.uint32(1))
    press = zstandard.ZstdCompressor(level=1).compress
    for part, own in enumerate(total.reshape(ACROSS_PARTS, -1)):
        if own.any():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "counts": [press(own.tobytes())]})


def _across_logits(parts: pa.Table) -> pa.Table:
    """Coded logits of a part, context by context and node by node."""
    total = sum(_unpack(own, np.uint32).astype(np.float32) for own in parts.column("counts").to_pylist()).reshape(-1, 256)
    out = np.zeros(total.shape, np.int8)
    for bit in range(7, -1, -1):
        # `total` counts the nodes below the next bit.
        zeros, ones = total[:, ::2], total[:, 1::2]
        logit = np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4)))
        out[:, 1 << bit : 2 << bit] = _coded(logit)
        total = zeros + ones
    return pa.table({"part": pa.array([parts.column("part")[0].as_py()], pa.int32()), "logits": [out.tobytes()]})


def _coded(logit: np.ndarray) -> np.ndarray:
    """Codes of logits; `_LOGIT` has the logit of each code."""
    return np.rint(np.arcsinh(np.clip(logit, -_LIMIT, _LIMIT)) / _CODE_STEP).astype(np.int8)


def along(stream: Stream, words: np.ndarray, across: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each row, read in order.

    `words` holds the coded logits, eight in a number, that the first layer gives the bits of `stream.data` in favour
    of what stands there; `across` those of a one, by context across words and node.
    """
    rows = len(stream.length)
    order = np.argsort(-stream.length, kind="stable")
    rank = np.empty(rows, np.int64)
    rank[order] = np.arange(rows)
    strides = -(-stream.length[order] // STRIDE)
    # Rows that are not at their end yet, at each stride, and where the stride begins.
    active = rows - np.searchsorted(strides[::-1], np.arange(strides.max(initial=0)), side="right")
    offset = np.concatenate([[0], np.cumsum(active * STRIDE)])
    # Behind the end of a row stands one more byte, of code 256 and logits 0.
    source, context = np.full(offset[-1], len(stream.data), np.int32), np.zeros(offset[-1], np.uint16)
    for row, place, at, slot in stream.pieces():
        to = offset[place // STRIDE] + rank[row] * STRIDE + place % STRIDE
        source[to], context[to] = at, slot
    byte = np.append(stream.data, np.uint16(256)).astype(np.uint16)
    gate = np.minimum(np.append(run_index(stream.size), 0), PLACES - 1).astype(np.int32)
    given = np.append(words, np.uint64(0))

    weight = np.tile(np.array(START, np.float32), (rows * PLACES, 1))
    # The refinement: how often the side of the logit was right, by its size; of size 0 there is no side.
    middle = _squash(np.arange(1, _SIDES + 1.0))
    right, seen = np.zeros((rows, _SIDES)), np.zeros((rows, _SIDES))
    kinds = 2 * _SIDES + 1
    shift = np.zeros((rows, kinds), np.float32)
    own = np.repeat(np.arange(rows, dtype=np.int32), STRIDE)
    total = np.zeros(rows)
    for stride, n in enumerate(active.tolist()):
        at = slice(offset[stride], offset[stride + 1])
        here = own[: n * STRIDE]
        place = source[at]
        b = byte[place]
        one = _LOGIT.take(given[place].view(np.uint8).reshape(-1, 8))
        node = _NODE[b]
        node += (context[at].astype(np.int32) << 8)[:, None]
        two = _LOGIT.take(across.take(node).view(np.uint8))
        two *= _SIGN[b]
        key = here * PLACES + gate[place]
        w = weight[key]
        logit = one * w[:, :1]
        logit += two * w[:, 1:]
        np.clip(logit, -_LIMIT, _LIMIT, out=logit)
        kind = np.rint(logit).astype(np.int32)
        kind += (here * kinds + _SIDES)[:, None]
        np.negative(logit, out=logit)
        np.exp(logit, out=logit)
        logit += 1
        p = np.reciprocal(logit, out=logit)
        mixed = shift.ravel().take(kind)
        mixed += p
        # Four bits together are far from the least float.
        half = mixed[:, :4] * mixed[:, 4:]
        total[:n] += np.log(half[:, :2] * half[:, 2:]).reshape(n, -1).sum(1, dtype=np.float64)
        error = np.subtract(1, p, out=p)
        for number, x in enumerate((one, two)):
            weight[: n * PLACES, number] += _RATE * np.bincount(key, np.einsum("ib,ib->i", error, x), n * PLACES)
        found = np.bincount(kind.ravel(), minlength=n * kinds).reshape(n, kinds)
        right[:n] += found[:, _SIDES + 1 :]
        seen[:n] += found[:, _SIDES + 1 :] + found[:, _SIDES - 1 :: -1]
        side = ((right[:n] + _INERTIA * middle) / (seen[:n] + _INERTIA) - middle) / 2
        shift[:n, _SIDES + 1 :], shift[:n, _SIDES - 1 :: -1] = side, -side
    out = np.empty(rows)
    out[order] = total - np.log(0.5) * 8 * (strides * STRIDE - stream.length[order])
    return out


def score_in_order(docs: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte, word_score) per row.

    `word_score` is the first layer's alone, which does not depend on the order of words.
    """
    given = docs.select(
        F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    blocks = written(given.mapInArrow(_blocks, _BLOCK), "blocks")
    listed = blocks.select("block", "words", "times").mapInArrow(_vocabulary, "word binary, n long, block long, at int")
    # Words that begin alike are neighbours; only beginnings of a shelf's first and last word go on in others.
    shelf = "shelf long, tokens long, distinct long, n binary, words binary, uses binary, blocks binary, ats binary"
    shelves = written(listed.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(_shelves, shelf), "shelves")
    tokens, distinct = shelves.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    parts = written(shelves.select("shelf", "words", "n").mapInArrow(_beginnings, "shelf long, prefix long, byte int, n long"), "beginnings")
    whole = parts.groupBy("prefix", "byte").agg(F.sum("n").alias("n")).filter("n > 0")
    shared = parts.select("shelf", "prefix").distinct().join(whole, "prefix")
    shared = shared.groupBy("shelf").agg(F.collect_list(F.struct("prefix", "byte", "n")).alias("shared"))
    shelves = written(shelves.select("shelf", "n", "words", "uses", "blocks", "ats").join(shared, "shelf", "left"), "shelves")

    # Tables of fixed size: the low contexts, weights and refinement, and the contexts across words.
    sums = shelves.select("words", "n").mapInArrow(_count_low, "slot long, zeros double, ones double").groupBy("slot")
    table = sums.agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()
    counts = np.zeros((2, LOW), np.float32)
    for row, name in enumerate(("zeros", "ones")):
        counts[row, table.column("slot").to_numpy()] = table.column(name).to_numpy()
    share = docs.sparkSession.sparkContext.broadcast
    trained = shelves.select("shelf", "n", "words", "shared")
    mixer = start = Mixer.new(counts)
    low = share(counts)
    for _ in range(TURNS):
        slopes = _summed(trained, _Sent(low, mixer), _slopes, GATES * (CONTEXTS + CONTEXTS * (CONTEXTS + 1) // 2))
        mixer = mixer.moved(slopes.reshape(-1, GATES), start.weight)
    mixer = mixer.refined_by(_summed(trained, _Sent(low, mixer), Mixer.followed, 2 * mixer.refined.size))
    sent = _Sent(low, mixer)
    followed = blocks.select("held", "seq", "words").mapInArrow(_count_across, "part int, counts binary")
    followed = followed.groupBy("part").applyInArrow(_across_logits, "part int, logits binary").toArrow()
    across = np.zeros((ACROSS_PARTS, 1 << ACROSS_LOG2 + 8 >> ACROSS_PARTS.bit_length() - 1), np.int8)
    for part, logits in zip(*[followed.column(c).to_pylist() for c in ("part", "logits")], strict=True):
        across[part] = np.frombuffer(logits, np.int8)
    across = share(across.ravel())

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for row, places, times in _opened(batches):
            value, logits = [], []
            for own, (slots, bit, gate, known, _) in _exact(row, places, times, sent.value):
                one = own.probability(slots, gate, known)
                one = np.where(bit == 1, one, 1 - one)
                value.append(np.log10(one).reshape(-1, 8).sum(1))
                logits.append(_coded(np.log(one / (1 - one))))
            value = np.bincount(places.word, np.concatenate(value)[places.edge], len(times))
            logits = np.concatenate(logits).view(np.uint64)[places.edge]
            size = np.bincount(places.word, minlength=len(times))
            start = np.cumsum(size) - size
            used, at = (np.cumsum(_unpack(row[c], np.int32)) for c in ("uses", "ats"))
            block = np.cumsum(_unpack(row["blocks"], np.int64))
            begin = np.flatnonzero(np.diff(block, prepend=-1))
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(block)], strict=True):
                own = used[a:b]
                n = size[own]
                bits = logits[np.repeat(start[own], n) + run_index(n)]
                reply = [pa.array([int(block[a])]), *[pa.array([press(x.tobytes())]) for x in (np.diff(at[a:b], prepend=0).astype(np.int32), times[own], value[own].astype(np.float32), bits)]]
                yield pa.RecordBatch.from_arrays(reply, ["block", "at", "n", "value", "bits"])

    replies = shelves.mapInArrow(rate, "block long, at binary, n binary, value binary, bits binary")
    spread = float(np.log10(tokens + distinct + 1))

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            stream = Stream(row)
            words = len(stream.size)
            n, value, logits = np.zeros(words, np.int64), np.zeros(words), np.zeros(len(stream.data), np.uint64)
            for reply in zip(*[right.column(c).to_pylist() for c in ("at", "n", "value", "bits")], strict=True):
                at, own_n, own_value, bits = (_unpack(raw, kind) for raw, kind in zip(reply, (np.int32, np.int64, np.float32, np.uint64), strict=True))
                at = np.cumsum(at)
                n[at], value[at] = own_n, own_value
                logits[np.repeat(stream.start[at], stream.size[at]) + run_index(stream.size[at])] = bits

            def total(of: np.ndarray, stream=stream) -> np.ndarray:
                return np.add.reduceat(of[stream.seq], stream.first[:-1])

            score = along(stream, logits, across.value) / np.log(10)
            out.append(
                pa.table(
                    {
                        key: pa.array(row["ids"], pa.int64()),
                        "held_out": pa.array(row["held"], pa.bool_()),
                        "n_tokens": np.diff(stream.first).astype(np.int64),
                        "n_known": total((n > 0).astype(np.int64)),
                        "train_tokens": np.full(len(score), tokens, np.int64),
                        "base_score": total(np.log10(n + 1.0) - spread),
                        "score": score,
                        "bits_per_byte": -score / np.log10(2) / (np.array(row["bytes"]) + 1),
                        "word_score": total(value),
                    }
                )
            )
        return pa.concat_tables(out)

    held = blocks.select("block", "ids", "held", "bytes", "seq", "words")
    out = (
        f"{key} long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double,"
        " bits_per_byte double, word_score double"
    )
    return held.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(gather, out)


def score(docs: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """Like `score_in_order`, by the first layer alone: a text is the sum of its words, in whatever order."""
    per_byte = F.col("bits_per_byte") * F.col("word_score") / F.col("score")
    rated = score_in_order(docs, key, text, held_out).withColumn("bits_per_byte", per_byte)
    return rated.withColumn("score", F.col("word_score")).drop("word_score")


def op9(spark, sf_dir: str) -> DataFrame:
    return score_in_order(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", remainder("doc_id", 7) == 2)
