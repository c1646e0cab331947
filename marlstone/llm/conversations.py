"""Repair of the turn structure of conversations by cheapest edits.

Rows are partitioned by conversation and sorted by turn, so that every conversation streams through
one task. A row is blank (no visible character), a duplicate (role and text seen earlier) or
truncated (the last visible character is not one of `.!?`). Kept rows must read as an optional
system turn and then pairs of user and assistant turns, or nothing at all. Keep costs 0, a new role
3, deletion 4 (blank and duplicate rows must go), an inserted empty turn 3, a truncated row that
stays 3. Of the cheapest edits those are taken whose letters (D, I, K, R in order) are least.

The dynamic programme has four states: nothing written, system, user, assistant last. It carries one
cost and one rank per state over the Arrow batches; the rank orders the letters written so far, so
ties are settled without keeping them. Steps are learned once per difference of costs, of which there
are few, since a state far dearer than the best can never win. A conversation that outgrows a block
of rows or bytes is spilled block by block: for each state at its end, the state at its start and the
letters between. A second pass walks the blocks from the last to the first and picks the letters.
Memory is bounded by a block, at any length of a conversation; one conversation stays in one task.

Defined results: a null role or text counts as one space. Rows without a turn come first, equal turns
are ordered by role and text. Rows without a conversation id are one conversation. A row whose role
is empty can't be kept as it is. A conversation that lost all rows gets zeros, no letters and the
hash of the empty string. Columns other than the four named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.sources.scratch import written

BLOCK_ROWS, BLOCK_BYTES = 4096, 8 << 20

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
# The state that an inserted or renamed turn leads to, and all states by the initial of a kept role.
_TURN = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEEP = {(NOTHING, "s"): SYSTEM} | {(state, "ua"[to - USER]): to for state, to in _TURN.items()}
_LEGAL = {"su", "ua", "au"}
CLEAN, MUST_GO, TRUNCATED = range(3)
# Any state can go on like any other for at most 10 more, so one that is this much dearer never wins.
_HOPELESS = 16

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_EDITS = "edits array<struct<edit: string, turn: bigint, role: string, text: string>>"
# Nullable whole numbers in columns of their own would reach pandas as floats.
_SUMMARY = "counts array<bigint>, repaired_sha256 string"
_WALKED = f"conv_id string, part int, last boolean, {_EDITS}, starts array<int>, letters array<string>, {_SUMMARY}"
_REPAIRED = f"conv_id string, part int, {_EDITS}, audit string, {_SUMMARY}"


def _insertions(state: int) -> Iterator[tuple[int, int]]:
    """(number of turns inserted, state then); a third would repeat the first."""
    for count in range(3):
        yield count, state
        state = _TURN[state]


@cache
def _step(costs: tuple, ranks: tuple, initial: str, fault: int):
    """One row from relative costs and ranks: (rise of the least cost, costs, ranks, back pointers)."""
    found: list[list] = [[] for _ in range(4)]
    for state, cost in enumerate(costs):
        if cost is None:
            continue
        for inserted, at in _insertions(state):
            so_far, letters = cost + 3 * inserted, "I" * inserted
            stays = 3 if fault == TRUNCATED else 0
            found[at].append((so_far + 4, ranks[state], letters + "D", state))
            if fault != MUST_GO:
                found[_TURN[at]].append((so_far + 3 + stays, ranks[state], letters + "R", state))
                if (at, initial) in _KEEP:
                    found[_KEEP[at, initial]].append((so_far + stays, ranks[state], letters + "K", state))
    best = [min(ways) if ways else None for ways in found]
    least = min(way[0] for way in best if way)
    best = [way if way and way[0] - least <= _HOPELESS else None for way in best]
    order = sorted(way[1:3] for way in best if way)
    return (
        least,
        tuple(way and way[0] - least for way in best),
        tuple(way and order.index(way[1:3]) for way in best),
        tuple(way and (way[3], way[2]) for way in best),
    )


def _edits(start: int, letters: str, rows: list) -> Iterator[tuple[str, int | None, str, str]]:
    """(edit, turn, role, text) for the letters of a block whose rows are (turn, role, text)."""
    state, at = start, 0
    for letter in letters:
        if letter == "I":
            state = _TURN[state]
            yield letter, None, _ROLES[state], ""
            continue
        turn, role, text = rows[at]
        at += 1
        if letter == "R":
            state = _TURN[state]
            role = _ROLES[state]
        elif letter == "K":
            state = _KEEP[state, role[:1]]
        yield letter, turn, role, text


class _Conversation:
    """One conversation on its way through a task."""

    def __init__(self, key: str | None):
        self.key = key
        self.cost, self.costs, self.ranks = 0, (0, None, None, None), (0, None, None, None)
        self.rows: list = []
        self.back: list = []
        self.bytes = self.part = 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.hashes = {NOTHING: hashlib.sha256()}
        self.initial = self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        visible = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        fault, kind = CLEAN, None
        if not visible:
            fault, kind = MUST_GO, "blank"
        elif seen:
            fault, kind = MUST_GO, "duplicate"
        elif visible[-1] not in ".!?":
            fault, kind = TRUNCATED, "truncated"
        if kind:
            self.counts[kind] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.counts["illegal"] += 1
        self.initial = initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        rise, self.costs, self.ranks, back = _step(self.costs, self.ranks, initial if initial in ("s", "u", "a") else "", fault)
        self.cost += rise
        self.rows.append((turn, role, text))
        self.back.append(back)
        self.bytes += len(text) + len(role)

    def full(self, rows: int, size: int) -> bool:
        return len(self.rows) >= rows or self.bytes >= size

    def _trace(self, state: int) -> tuple[int, str]:
        """The state at the start of the block, and the letters from there to this state."""
        steps = []
        for back in reversed(self.back):
            state, step = back[state]
            steps.append(step)
        return state, "".join(reversed(steps))

    def _digest(self, start: int, letters: str):
        digest, first = self.hashes[start].copy(), start == NOTHING
        for edit, _, role, text in _edits(start, letters, self.rows):
            if edit != "D":
                digest.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
                first = False
        return digest

    def spill(self) -> dict:
        """The block as it is, with the way through it for every state at its end."""
        ways = {state: self._trace(state) for state, cost in enumerate(self.costs) if cost is not None}
        out = self._record(False, [(None, *row) for row in self.rows], ways)
        self.hashes = {state: self._digest(*way) for state, way in ways.items()}
        self.rows, self.back, self.bytes = [], [], 0
        self.part += 1
        return out

    def end(self) -> dict:
        ends = []
        for state, cost in enumerate(self.costs):
            if cost is not None:
                for inserted, at in _insertions(state):
                    if at in (NOTHING, ASSISTANT):
                        ends.append((cost + 3 * inserted, self.ranks[state], "I" * inserted, state))
        cost, _, inserted, state = min(ends)
        start, letters = self._trace(state)
        letters += inserted
        self.counts["cost"] = self.cost + cost
        if self.turns:
            self.counts["gaps"] = self.high - self.low + 1 - self.turns
        out = self._record(True, list(_edits(start, letters, self.rows)), {0: (start, letters)})
        return out | {"counts": list(self.counts.values()), "repaired_sha256": self._digest(start, letters).hexdigest()}

    def _record(self, last: bool, edits: list, ways: dict) -> dict:
        found = [ways.get(state, (-1, "")) for state in range(1 if last else 4)]
        return {
            "conv_id": self.key,
            "part": self.part,
            "last": last,
            "edits": [dict(zip(("edit", "turn", "role", "text"), edit, strict=True)) for edit in edits],
            "starts": [start for start, _ in found],
            "letters": [letters for _, letters in found],
            "counts": None,
            "repaired_sha256": None,
        }


def _frame(records: list[dict], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(records, columns=columns, dtype=object)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.replace(f"{_EDITS}, ", "edits x, ").split(", ")]


def _walk(rows: int, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns, current, done, held = _names(_WALKED), None, [], 0
        for batch in batches:
            columns_of = [batch[name] for name in ("key", "turn", "role", "text", "seen", "dropped")]
            for key, turn, role, text, seen, dropped in zip(*columns_of, strict=True):
                if current is None or key != current.key:
                    if current is not None:
                        done.append(current.end())
                        held += current.bytes
                    current = _Conversation(key)
                if not dropped:
                    if current.full(rows, size):
                        held += current.bytes
                        done.append(current.spill())
                    current.add(None if turn is None else int(turn), role, text, seen)
                if held >= size or len(done) >= rows:
                    yield _frame(done, columns)
                    done, held = [], 0
        if current is not None:
            done.append(current.end())
        yield _frame(done, columns)

    return run


def _choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of long conversations, last block first: the letters that lead to the chosen end."""
    columns, key, state = _names(_REPAIRED), None, NOTHING
    for batch in batches:
        out = []
        for block in batch.to_dict("records"):
            if block["last"]:
                key, state, edits = block["conv_id"], block["starts"][0], block["edits"]
                audit = block["letters"][0]
            else:
                if block["conv_id"] != key:
                    raise ValueError(f"conversation {block['conv_id']} has lost its last block")
                audit, start = block["letters"][state], block["starts"][state]
                rows = [(row["turn"], row["role"], row["text"]) for row in block["edits"]]
                edits = [dict(zip(("edit", "turn", "role", "text"), edit, strict=True)) for edit in _edits(start, audit, rows)]
                state = start
            summary = {name: block[name] for name in ("counts", "repaired_sha256")}
            out.append({"conv_id": key, "part": block["part"], "edits": edits, "audit": audit, **summary})
        yield _frame(out, columns)


def damage(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, dropped) after a fixed share of them was damaged.

    By crc32 of `conv_id:turn` modulo 20: 0 marks a row dropped, 1 empties its text, 2 takes its
    `.!?`, 3 doubles it, 4 makes its role user. Nulls count as one space.
    """

    def written_out(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", written_out("conv_id"), written_out("turn")).cast("binary")) % 20
    text = written_out("text")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, F.lit("user")).otherwise(written_out("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), copies.alias("copy"))
    return out.drop("copy")


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per conversation, or per block of a long one: conv_id, part, edits (edit, turn, role,
    text in order, deleted rows too), audit (their letters); and with the last part the counts (as
    named in COUNTS) and the hash of the whole repaired conversation.

    Reads conv_id, turn, role, text and, if there, dropped: such rows are as good as absent, but
    their conversation is returned.
    """
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = rows.select(
        F.col("conv_id").cast("string").alias("key"),
        F.col("turn").cast("long").alias("turn"),
        F.when(~dropped, text("role")).alias("role"),
        F.when(~dropped, text("text")).alias("text"),
        dropped.alias("dropped"),
    )
    # The window and the order below both keep this partitioning, so rows are shuffled once.
    rows = rows.repartition("key")
    same = Window.partitionBy("key", "dropped", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("seen", F.row_number().over(same) > 1)
    rows = rows.sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text", "seen")
    rows = rows.withColumn("turn", F.col("turn").cast("string"))
    walked = written(rows.mapInPandas(_walk(block_rows, block_bytes), _WALKED), "walked")
    whole = F.col("last") & (F.col("part") == 0)
    short = walked.filter(whole).withColumn("audit", F.col("letters")[0])
    long = walked.filter(~whole).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"))
    return short.select(_names(_REPAIRED)).union(long.mapInPandas(_choose, _REPAIRED))


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """(conv_id, part, place, turn, role, text) of all rows that stay or were inserted."""
    rows = repaired.select("conv_id", "part", F.posexplode("edits").alias("place", "row")).filter("row.edit <> 'D'")
    return rows.select("conv_id", "part", "place", "row.turn", "row.role", "row.text")


def summaries(repaired: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, all letters, and the hash of its repaired rows."""
    letters = F.array_sort(F.collect_list(F.struct("part", "audit")))
    audit = F.array_join(F.transform(letters, lambda x: x["audit"]), "")
    last = repaired.groupBy("conv_id").agg(F.max("counts").alias("counts"), F.max("repaired_sha256").alias("repaired_sha256"), audit.alias("audit"))
    counts = [F.col("counts")[at].alias(name) for at, name in enumerate(COUNTS)]
    return last.select("conv_id", *counts, "audit", "repaired_sha256")


def op11(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = summaries(repair(damage(rows.select("conv_id", "turn", "role", "text"))))
    id_type = rows.schema["conv_id"].dataType
    return found.select(F.col("conv_id").cast(id_type), *COUNTS, "audit", "repaired_sha256")
