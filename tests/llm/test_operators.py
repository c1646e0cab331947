"""Every operator against brute force on small frames, and on nulls, repeats, long and empty input."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from marlstone.llm import (
    automaton_dedup,
    decontaminate,
    language,
    mixing,
    near_dedup,
    packing,
    private_data,
    quality,
    repeats,
    search,
    suffix_dedup,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, base string, leaks int"


def _words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 160))) for _ in range(40)]
    near = []
    for text in base[:20]:
        for _ in range(4):
            words = text.split()
            for _ in range(len(words) // 25):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            near.append(" ".join(words))
    return [*base, *near, base[3], base[3], None, "", "   ", "A a", "a A", "x" * 3000, "12 " * 900, base[5] + " " + base[5]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("en", "fr")[i % 2], None, None if i % 7 == 0 else i, 0.0, "b", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_near_duplicates_are_the_exact_components(docs, texts):
    sets = []
    for text in texts:
        words = _words(text)
        sets.append(set(zip(words, words[1:], strict=False)) or ({tuple(words)} if words else set()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs, shingle=2).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(s), root(i), root(i) == i) for i, s in enumerate(sets)
    }


def test_suffix_dedup_removes_what_repeats(docs, texts, monkeypatch):
    seen = Counter(t.encode()[i : i + 400] for t in texts if t for i in range(len(t.encode()) - 399))
    for hot in (repeats.HOT, 1):
        monkeypatch.setattr(repeats, "HOT", hot)
        got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
        for i, text in enumerate(texts):
            raw = (text or "").encode()
            gone = np.zeros(len(raw), bool)
            for at in range(len(raw) - 399):
                if seen[raw[at : at + 400]] > 1:
                    gone[at : at + 400] = True
            spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(raw) else 0
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            row = got[i]
            assert (row.n_bytes, row.n_removed, row.n_spans) == (len(raw), gone.sum(), spans)
            assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_automaton_dedup_removes_what_an_earlier_document_holds(docs, texts, monkeypatch):
    for hot in (repeats.HOT, 1):
        monkeypatch.setattr(repeats, "HOT", hot)
        got = {r.doc_id: r for r in automaton_dedup.remove_repeats(docs).collect()}
        seen = set()
        for i, text in enumerate(texts):
            words = (text or "").encode().split()
            windows = [tuple(words[j : j + 13]) for j in range(len(words) - 12)]
            gone = {j + k for j, w in enumerate(windows) if w in seen for k in range(13)}
            seen |= set(windows)
            kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
            row = got[i]
            assert (row.n_words, row.n_removed) == (len(words), len(gone))
            assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_packing_is_gapless_and_every_id_lies_in_one_piece(docs, texts):
    rows = packing.pack_documents(docs).collect()
    places, pieces = {}, {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for start, length, crc, total in sorted(pieces[i]):
            assert (start, total) == (at, len(ids))
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)


def test_best_fill_is_the_best_of_all_multisets():
    rng = random.Random(1)
    for _ in range(50):
        counts = [0] + [rng.choice((0, 0, 0, 1, 2)) for _ in range(12)]
        sums = {0}
        for length, n in enumerate(counts):
            for _ in range(n):
                sums |= {s + length for s in sums}
        fill = packing.best_fill(counts, 17)
        assert sum(length * n for length, n in fill.items()) == max(s for s in sums if s <= 17)
        assert all(n <= counts[length] for length, n in fill.items())


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 6)).round(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(300, None), (301, [None] + [0.0] * 5), (302, [float("nan")] * 6), (303, [1.0]), (304, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in search.top_k(frame, F.col("vec_id") % 50 == 0, 5).collect())
    whole = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows[:300] + rows[304:]}
    expected = []
    for q in range(0, 300, 50):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        expected += [(q, rank, i, -score) for rank, (score, i) in enumerate(best, 1)]
    assert got == sorted(expected)
    assert search.top_k(frame.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_search_lets_every_row_ask(spark, monkeypatch):
    rng = np.random.default_rng(6)
    n = 10_000
    whole = rng.integers(-128, 128, (n, 64))
    whole[100:1000] = whole[100]
    ids = np.r_[np.arange(n - 1), 100]
    frame = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": pa.array((whole / 256).tolist(), pa.list_(pa.float32()))}))
    score = whole.astype(float) @ whole.T
    score[ids[:, None] == ids[None]] = -np.inf
    order = np.lexsort((np.broadcast_to(ids, score.shape), -score))[:, :3]
    expected = {}
    for i, row in enumerate(order):
        expected.setdefault(int(ids[i]), set()).update((-int(score[i, j]), int(ids[j])) for j in row)
    expected = {i: sorted(found)[:3] for i, found in expected.items()}
    for group in (search.QUERY_GROUP, 4000):
        monkeypatch.setattr(search, "QUERY_GROUP", group)
        got = {}
        for r in search.top_k(frame, F.lit(True), 3).collect():
            got.setdefault(r.query_id, {})[r.rank] = (-r.score, r.vec_id)
        assert {i: [found[rank] for rank in (1, 2, 3)] for i, found in got.items()} == expected


def test_private_data_forms_contexts_and_redaction(spark):
    seeds = [(i, f"please call +1 555 123 45{i:02d} now") for i in range(20)]
    rows = [*seeds, (50, "please call 0171-99 now"), (51, None), (52, "a@b.c, 1.2.3.4 and 4111 1111 1111 1111")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    text = {r.doc_id: r.text for r in private_data.redact(frame).collect()}
    assert text[0] == "please call [PHONE] now"
    assert text[50] == "please call [PHONE] now"
    assert text[51] is None
    assert text[52] == "[EMAIL], [IP] and [CARD]"


def test_private_data_patterns_do_not_depend_on_a_hot_source(spark):
    label = "l" * 90
    rows = [(i, f"please call +1 555 123 45{i % 100:02d} now") for i in range(4)]
    rows += [(10 + i, f"{label}{' ' * 80}+1 555 123 46{i:02d} now") for i in range(4)]
    rows += [(20, "please call 0171-99 now"), (21, f"{label}{' ' * 80}0171-98 now"), (22, f"x{label} 0171-97 now")]
    # 5,000 more phones behind another word: a share of all seeds would drop the others.
    rows += [(100 + i, " ".join(f"dial +1 555 {i:03d} {k:04d} ;" for k in range(100))) for i in range(50)]
    text = {r.doc_id: r.text for r in private_data.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(text) == len(rows)
    assert text[20] == "please call [PHONE] now"
    assert text[21] == f"{label}{' ' * 80}[PHONE] now"
    assert text[22] == f"x{label} 0171-97 now"


def test_leaks_equal_brute_force(spark, docs, texts):
    items = [(0, texts[0]), (1, " ".join(texts[45].split()[3:40])), (2, None), (3, "a a"), (4, "nowhere at all to be found here")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, x.item_id) for r in decontaminate.leaks(docs, frame).collect() for x in r.leaks}

    def grams(words, k):
        return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))

    expected = set()
    for item, text in items:
        own = _words(text)
        k = min(5, len(own))
        for i, other in enumerate(texts):
            words = _words(other)
            for at in range(max(1, len(words) - len(own) + 1)):
                x, y = grams(words[at : at + len(own)], k), grams(own, k)
                both = sum((x & y).values())
                if k and both and 100 * both >= 80 * (sum(x.values()) + sum(y.values()) - both):
                    expected.add((i, item))
    assert got == expected


def test_mixing_base_scores(docs, texts):
    got = {r.doc_id: r for r in mixing.score(docs, "doc_id", "text", F.col("doc_id") % 3 == 1).collect()}
    counts = Counter(w for i, t in enumerate(texts) if i % 3 != 1 for w in [*_words(t), b"\n"])
    total, distinct = sum(counts.values()), len(counts)
    for i, text in enumerate(texts):
        words = [*_words(text), b"\n"]
        base = sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        row = got[i]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (i % 3 == 1, len(words), total)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert row.base_score == pytest.approx(base)
        assert row.score < 0


def test_word_probabilities_of_a_byte_sum_to_one():
    mixer = mixing.learn(np.random.default_rng(0).integers(0, 9, (2, mixing.CONTEXTS << mixing.SLOTS_LOG2)).astype(float), [b"ab", b"b"], np.array([2, 1]))
    firsts = [bytes([b]) for b in range(256)]
    slots, bit, gate, known, word = mixing._bits(firsts)
    one = mixer.probability(slots, gate, known)
    own = np.log(np.where(bit == 1, one, 1 - one)).reshape(-1, 8)
    # The first eight bits of each word are its first byte.
    first = np.flatnonzero(np.diff(np.repeat(word, 1).reshape(-1, 8)[:, 0], prepend=-1))
    assert np.exp(own[first].sum(1)).sum() == pytest.approx(1, abs=0.01)


def test_mixing_counts_are_exact_across_shelves():
    rng = random.Random(3)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))) for _ in range(900)} | {mixing.END, b"z" * 400})
    times = np.array([rng.randrange(4) for _ in words])
    expected = Counter()
    for word, n in zip(words, times.tolist(), strict=True):
        whole = word if word == mixing.END else word + b" "
        for at in range(len(whole)):
            for bit in range(9):
                expected[whole[:at], bit, whole[at] >> 8 - bit] += n
    press = mixing.zstandard.ZstdCompressor().compress
    cuts = [(0, 100), (100, 101), (101, 300), (300, len(words))]
    assert len(words) > 400
    rows = [{"shelf": a, "words": press(b" ".join(words[a:b])), "n": press(times[a:b].tobytes())} for a, b in cuts]
    parts = pa.Table.from_batches(mixing._beginnings([pa.RecordBatch.from_pylist(rows)]))
    total = parts.group_by(["prefix", "byte"]).aggregate([("n", "sum")])
    for a, b in cuts:
        places = mixing.Places(words[a:b])
        own = total.filter(pc.is_in(total["prefix"], parts.filter(pc.equal(parts["shelf"], a))["prefix"].combine_chunks()))
        prefix, byte, n = (own[c].to_numpy() for c in ("prefix", "byte", "n_sum"))
        got = places.so_far(times[a:b], prefix.view(np.uint64), byte, n)
        for at in range(len(places.data)):
            before, byte = bytes(places.data[at - places.place[at] : at]), int(places.data[at])
            for bit in range(8):
                start = byte >> 8 - bit << 1
                assert got[:, at, bit].tolist() == [expected[before, bit + 1, start + value] for value in (0, 1)]


def test_mixing_learns_from_every_training_word(spark):
    rng = random.Random(4)
    held = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(50)) for _ in range(2)]
    train = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(1000)) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(held + train)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in mixing.score(frame, "doc_id", "text", F.col("doc_id") < 2).collect()}
    seen = Counter(w for t in train for w in [*_words(t), mixing.END])
    words = sorted(set(seen) | {w for t in held for w in _words(t)})
    times = np.array([seen[w] for w in words])
    assert len(seen) > 20_000
    # The same, of one shelf that holds all words.
    places = mixing.Places(words)
    slots, bit, gate, known, word = places.bits(slice(None))
    counts = np.zeros((2, mixing.LOW))
    for own in slots:
        np.add.at(counts, (bit, own), times[word])
    press = mixing.zstandard.ZstdCompressor().compress
    row = {"shelf": 0, "words": press(b" ".join(words)), "n": press(times.tobytes())}
    ends = next(mixing._beginnings([pa.RecordBatch.from_pylist([row])]))
    ends = [ends[c].to_numpy() for c in ("prefix", "byte", "n")]
    slots = np.vstack([slots, mixing.LOW + np.arange(len(bit))])
    mixer = start = mixing.Mixer.new(np.hstack([counts, places.so_far(times, ends[0].view(np.uint64), *ends[1:]).reshape(2, -1)]))
    for _ in range(mixing.TURNS):
        mixer = mixer.moved(mixer.slopes(slots, bit, gate, times[word]), start.weight)
    mixer = mixer.refined_by(mixer.followed(slots, bit, gate, known, times[word]))
    one = mixer.probability(slots, gate, known)
    value = dict(zip(words, np.bincount(word, np.log10(np.where(bit == 1, one, 1 - one))), strict=True))
    for i, text in enumerate(held + train):
        assert got[i] == pytest.approx(sum(value[w] for w in [*_words(text), mixing.END]), rel=1e-4)


def test_classifiers_learn_and_take_any_row(spark, docs):
    en = ["the cat sat on the mat with that other thing", "this is the thing that the others with them"]
    fr = ["le chat est sur la table avec une autre chose", "la maison est dans une rue avec les autres"]
    rows = [(i, (en, fr)[i % 2][i // 2 % 2] + f" {i}", ("en", "fr")[i % 2]) for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(train, "text", "lang", F.col("doc_id"))
    told = {r.doc_id: r for r in language.identify(train, model).collect()}
    assert all(told[i].lang_pred == lang for i, _, lang in rows)
    odd = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd.values())
    assert {r.lang_pred for r in odd.values() if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert language.fit(train.filter("false"), "text", "lang", F.col("doc_id")) is None
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (3, None)], "doc_id long, quality int")
    machine = quality.fit(docs, labels, "doc_id", "text", "n_chars", F.col("quality"))
    rated = quality.rate(docs, machine).collect()
    assert len(rated) == docs.count() and all(0 <= r.score <= 1 for r in rated)


def test_empty_tables(spark, docs):
    none = docs.filter("doc_id < 0")
    items = spark.createDataFrame([(0, "a b c d e f")], "item_id long, text string")
    assert near_dedup.near_duplicates(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert automaton_dedup.remove_repeats(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert private_data.redact(none).count() == 0
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(docs, items.filter("false")).filter(F.size("leaks") > 0).count() == 0
    assert mixing.score(none, "doc_id", "text", F.lit(False)).count() == 0
    assert language.identify(none, None).count() == 0
    assert quality.rate(none, None).count() == 0
