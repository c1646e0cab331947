"""Repair of conversations against a search of all edits, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from marlstone.llm import conversations
from marlstone.llm.conversations import COUNTS, damage, repair, repaired_rows, summaries

ROWS = "conv_id long, turn long, role string, text string, part string, edits int, last double, key string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not visible:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if visible[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost, letters and rows of the best of all edits; only for few rows."""
    found = faults(rows)
    inserts = [[("I", 3, (role, "")) for role in way] for way in ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user"))]
    choices = [inserts]
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        stays = 3 if fault == "truncated" else 0
        ways = [[("D", 4, None)]]
        if fault not in ("blank", "duplicate"):
            ways += [[("K", stays, (role, text))], [("R", 3 + stays, ("user", text))], [("R", 3 + stays, ("assistant", text))]]
        choices += [ways, inserts]
    best = None
    for pick in itertools.product(*choices):
        edits = [edit for group in pick for edit in group]
        kept = [row for _, _, row in edits if row]
        if re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in kept)):
            way = (sum(cost for _, cost, _ in edits), "".join(letter for letter, _, _ in edits), kept)
            best = way if best is None or way[:2] < best[:2] else best
    return best


def expected(rows):
    out = {}
    for conv in {row[0] for row in rows}:
        mine = damaged([row for row in rows if row[0] == conv])
        found = faults(mine)
        turns = {turn for _, turn, _, _ in mine if turn is not None}
        pairs = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, kept = cheapest(mine)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), pairs, cost, audit, digest)
    return out


def found(df):
    return {r.conv_id: (*[r[name] for name in COUNTS], r.audit, r.repaired_sha256) for r in summaries(df).collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "user", "assistant", None, "tool", "", "sage"]
    words = ["one.", "two", "  ", "", None, "three? ", "four!\n", "wö. ", " ", "five:x"]
    out = []
    for conv in range(70):
        for turn in rng.sample([None, 0, 1, 2, 3, 5, -4, 2**60], rng.randint(1, 3)):
            out.append((conv, turn, rng.choice(roles), rng.choice(words)))
    out += [(None, 1, "user", "no id."), (None, None, None, None), (500, 2, "user", "a."), (500, 2, "user", "a."), (501, None, "user", "x.")]
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([(*row, "p", 1, 0.5, "k") for row in rows], ROWS).repartition(3)


def test_cheapest_edits_equal_a_search_of_all_edits(frame, rows):
    want = {None if conv is None else str(conv): row for conv, row in expected(rows).items()}
    assert found(repair(damage(frame))) == want


def test_long_conversations_spilled_by_block_give_the_same(spark, frame, rows):
    whole = found(repair(damage(frame)))
    assert found(repair(damage(frame), block_rows=1)) == whole
    rng = random.Random(5)
    long = [(i % 3, i, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "", f"{i}."])) for i in range(3000)]
    long += [(7, i, "user", " ") for i in range(500)]
    long = spark.createDataFrame(long, "conv_id int, turn int, role string, text string")
    once = found(repair(damage(long)))
    for rows_, size in ((7, 1 << 20), (100, 1 << 20), (4096, 40)):
        assert found(repair(damage(long), rows_, size)) == once


def test_repaired_rows_are_what_was_hashed(spark, frame):
    done = repair(damage(frame), block_rows=2)
    texts = {}
    for r in repaired_rows(done).orderBy("conv_id", "part", "place").collect():
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, row in found(done).items():
        kept = texts.get(conv, [])
        assert row[-1] == hashlib.sha256("\n".join(kept).encode()).hexdigest()


def test_a_conversation_that_lost_all_rows_and_an_empty_table(spark, frame):
    gone = spark.createDataFrame([(1, 0, "user", "a.", True)], "conv_id long, turn long, role string, text string, dropped boolean")
    assert found(repair(gone)) == {"1": (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert found(repair(damage(frame.filter(F.lit(False))))) == {}


def test_a_very_long_text_is_kept_whole(spark):
    text = "wörd " * 400_000 + "end."
    rows = spark.createDataFrame([(1, 1, "user", text), (1, 3, "assistant", text)], "conv_id long, turn long, role string, text string")
    got = found(repair(rows))["1"]
    assert got[:-1] == (1, 0, 0, 0, 0, 0, "KK")
    assert got[-1] == hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()


def test_states_far_dearer_are_never_needed(monkeypatch, frame):
    near = found(repair(damage(frame)))
    monkeypatch.setattr(conversations, "_HOPELESS", 10**6)
    conversations._step.cache_clear()
    assert found(repair(damage(frame))) == near
