"""Packing of tokenised documents into fixed windows by minimum bin slack.

Documents are cut at full windows; what is left over of each is 1 to window - 1 tokens long. How
many pieces there are of each length is all that packing needs to know, whatever the number of
documents: a bitset subset-sum over these counts finds the multiset of lengths that fills a window
best next to the longest piece left, the counts are traced back from the bitsets, and the multiset
is used for as many windows as the counts allow. The resulting plan has a few thousand lines.
Pieces then find their window from their length and their number among pieces of that length.

Defined results: null text is an empty document, which still has its end token. Repeated rows and
rows without an id are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.arrays import run_index
from marlstone.sources.scratch import written

WINDOW = 1024
END = 0
# Pieces of one length that are numbered within one group.
_GROUP_ROWS = 20_000
_RANK_BITS = 44
_encoders: dict[tuple[str, str], object] = {}


class Encoder:
    """Ids of a byte-level vocabulary, given as the `tokenizers` file and as ranks.

    The ranks are the faster way to the same ids. Texts that contain an added token of the
    vocabulary are left to the tokenizer of the file, which knows those.
    """

    def __init__(self, file: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(file)
        self.added = [t.content for t in self.full.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(t in text for t in self.added):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def _encoder(file: str, ranks: str, pattern: str) -> Encoder:
    if (file, ranks) not in _encoders:
        _encoders[file, ranks] = Encoder(file, ranks, pattern)
    return _encoders[file, ranks]


def best_fill(counts: Sequence[int], room: int) -> dict[int, int]:
    """{length: how many} with the largest total of at most `room`, from counts[length] pieces."""
    reached, steps = 1, []
    within = (1 << room + 1) - 1
    for length in range(min(room, len(counts) - 1), 0, -1):
        left, times = min(counts[length], room // length), 1
        while left > 0:
            # Powers of two make up every number of pieces with few steps.
            take = min(times, left)
            steps.append((reached, length, take))
            reached = (reached | reached << take * length) & within
            left, times = left - take, times * 2
        if reached >> room & 1:
            break
    total, used = reached.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            total -= take * length
            used[length] = used.get(length, 0) + take
    return used


def plan(counts: Sequence[int], window: int) -> np.ndarray:
    """Lines (length, first number of that length, pieces per window, first window, offset)."""
    left = [0, *counts[1 : window + 1]]
    given, lines, windows = [0] * (window + 1), [], 0
    longest = window
    while longest:
        if not left[longest]:
            longest -= 1
            continue
        rest = left[:]
        rest[longest] -= 1
        fill = best_fill(rest, window - longest)
        fill[longest] = fill.get(longest, 0) + 1
        times = min(left[length] // n for length, n in fill.items())
        offset = 0
        for length, n in sorted(fill.items(), reverse=True):
            lines.append((length, given[length], n, windows, offset))
            given[length] += n * times
            left[length] -= n * times
            offset += n * length
        windows += times
    return np.array(sorted(lines), np.int64).reshape(-1, 5)


def tokenised(docs: DataFrame, key: str, text: str, window: int, file: str, ranks: str, pattern: str) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file, ranks, pattern)
        for batch in batches:
            sizes, sums = [], []
            for value in batch.column("text").to_pylist():
                ids = np.append(encoder.ids(value or ""), np.uint32(END)).astype("<u4")
                sizes.append(len(ids))
                sums.extend(zlib.crc32(ids[at : at + window]) for at in range(0, len(ids), window))
            size = np.array(sizes, np.int64)
            pieces = -(-size // window)
            start = run_index(pieces) * window
            total = np.repeat(size, pieces)
            ids_of = batch.column("id").take(pa.array(np.repeat(np.arange(len(size)), pieces)))
            yield pa.RecordBatch.from_arrays(
                [ids_of, pa.array(start), pa.array(np.minimum(window, total - start)), pa.array(sums, pa.int64()), pa.array(total)],
                ["id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    given = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return given.mapInArrow(cut, "id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(
    docs: DataFrame,
    file: str,
    ranks: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Add sequence_id and offset to the pieces of `tokenised`."""
    pieces = written(tokenised(docs, key, text, window, file, ranks, pattern), "pieces")
    # One number per length: at most `window` of them reach the driver.
    counts = [0] * (window + 1)
    for length, n in pieces.groupBy("length").count().collect():
        counts[length] = n
    lines = plan(counts, window)
    places = (lines[:, 0] << _RANK_BITS) + lines[:, 1]

    # Number the pieces of each length: within groups first, then by the groups before.
    groups = F.array(*[F.lit(max(1, -(-n // _GROUP_ROWS))) for n in counts])
    spread = F.xxhash64("id", "start", "ids_crc32", "doc_tokens")
    grouped = pieces.withColumn("group", F.pmod(spread, F.element_at(groups, F.col("length").cast("int") + 1)))
    sums = grouped.groupBy("length", "group").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("length", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "group").orderBy("id", "start", "ids_crc32", "doc_tokens")
    numbered = grouped.withColumn("number", F.row_number().over(inside)).join(before, ["length", "group"])
    numbered = numbered.withColumn("number", F.col("number") - 1 + F.col("before")).drop("group", "before")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "number"))
            line = lines[np.searchsorted(places, (length << _RANK_BITS) + number, side="right") - 1]
            at = number - line[:, 1]
            columns = [batch.column(c) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")]
            columns += [pa.array(line[:, 3] + at // line[:, 2]), pa.array(line[:, 4] + at % line[:, 2] * length)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    out = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return numbered.mapInArrow(place, out).withColumnRenamed("id", key)


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    file, ranks = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    return pack(docs, file, ranks, public_tokenizers.PATTERN)


def op7(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
