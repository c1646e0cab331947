"""Tasks and joins sized by the stored bytes of the tables they read.

Left to itself, adaptive execution sizes tasks by the compressed bytes of a shuffle, and wide rows that
compress well fill gigabytes of a task's memory when they are sorted. What is here knows the tables
before they are shuffled. Rows that come from no file are left to adaptive execution.
"""

from __future__ import annotations

from math import ceil
from urllib.parse import unquote

from pyspark.sql import DataFrame

# Stored bytes per task that sorts or sums rows.
TASK_BYTES = 8 << 20
# Stored bytes from which a looked-up table is hashed by its key instead of sorted with the rows.
HASHED_BYTES = 1 << 20
# Stored bytes that are joined and written in one go, since their shuffles take several times as much disk. Every
# round reads the tables; beyond three, summing what was written takes more disk than a round.
ROUND_BYTES, MOST_ROUNDS = 1 << 28, 3


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that the rows are read from; 0 if they come from none."""
    files = df.inputFiles()
    if not files:
        return 0
    sizes = df.sparkSession.read.format("binaryFile").load([unquote(f) for f in files])
    return sizes.agg({"length": "sum"}).first()[0] or 0


def rounds(df: DataFrame) -> int:
    """In how many shares to write joined rows, so that only the shuffles of one share are on the disks at a time."""
    return min(MOST_ROUNDS, max(1, ceil(stored_bytes(df) / ROUND_BYTES)))


def spread_pair(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> tuple[DataFrame, DataFrame]:
    """Two tables about to be merged by a key that no few values of own, over as many tasks as their bytes ask for.

    Up to one task per core that is what adaptive execution does, so it is left to do it.
    """
    tasks = ceil((stored_bytes(left) + stored_bytes(right)) / TASK_BYTES)
    if tasks <= left.sparkSession.sparkContext.defaultParallelism:
        return left, right
    return left.repartition(tasks, left_key), right.repartition(tasks, right_key)


def hashed_if_large(looked_up: DataFrame) -> DataFrame:
    """A table of one row per key, marked to be hashed by partition unless it is small.

    The rows that look it up then stream past it, however many there are in a task: only its own share
    is held. Adaptive execution still splits a hot key. A small table is left to Spark, which broadcasts it.
    """
    return looked_up.hint("shuffle_hash") if stored_bytes(looked_up) > HASHED_BYTES else looked_up
