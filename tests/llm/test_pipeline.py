"""Every stage of the corpus pipeline, on nulls, repeated ids, clashing columns and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from marlstone.llm import near_dedup, private_data

# Names that operators use inside.
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, "
    "ambiguous int, leaks int, base string, more string, instances string, kept int, _stage_0 int, `a b` string"
)
EXTRA = (0.25, "mine", 7, 8, "b", "m", "i", 9, 10, "odd")
PASSAGE = "the quick brown benchmark passage that nobody may learn from at all today"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, PASSAGE), (None, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    en = "the that with this those thing there then them which when what where who".split()
    fr = "le la les une des est dans avec pour sur que qui mais ou".split()
    out = []
    for i in range(120):
        words = (en, fr)[i % 2]
        out.append((i, " ".join(rng.choice(words) for _ in range(60)) + f" {i}", ("en", "fr")[i % 2]))
    out += [(200, out[0][1], "en"), (200, out[0][1], "en"), (201, out[2][1] + " more", "en"), (5, out[1][1], None)]
    out += [(300, None, None), (301, "", "en"), (302, "12 34 ..", "en"), (None, out[4][1], "en"), (None, out[4][1], "en")]
    out += [(303, f"{out[6][1]} {PASSAGE} {out[8][1]}", "en"), (304, out[10][1] + " mail me@host.example now", "en")]
    return [(i, text, lang, "s", len(text or ""), *EXTRA) for i, text, lang in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def kept(docs):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("name", [name for name, _ in pipeline.STAGES[:-1]])
def test_a_stage_keeps_columns_and_clean_rows_as_they_are(spark, docs, rows, folder, name):
    stage = dict(pipeline.STAGES)[name]
    out = stage(spark, docs, folder)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = out.collect()
    assert all(tuple(r)[5:] == EXTRA and r.source == "s" for r in got)
    ids = [r.doc_id for r in got]
    if name == "language":
        assert {300, 301, 302}.isdisjoint(ids) and len(ids) == len(rows) - 3
    if name == "near_dedup":
        # 200 copies 0, 201 is near 2, and one text of 5 is that of 1.
        assert {200, 201, 5}.isdisjoint(ids) and ids.count(None) == 2
        assert len(ids) == len(set(i for i in ids if i is not None)) + 2
        assert set(range(120)) - {5} <= set(ids)
    if name == "decontaminate":
        assert kept(out) == kept(docs.filter("doc_id IS NULL OR doc_id <> 303"))
    if name == "private_data":
        texts = {r.doc_id: r for r in got}
        assert texts[304].text.endswith(" mail [EMAIL] now") and texts[304].n_chars == len(texts[304].text)
        assert kept(out.filter("doc_id <> 304")) == kept(docs.filter("doc_id <> 304"))


@pytest.mark.parametrize("name", [name for name, _ in pipeline.STAGES])
def test_a_stage_takes_an_empty_table(spark, docs, folder, name):
    assert dict(pipeline.STAGES)[name](spark, docs.filter(F.lit(False)), folder).count() == 0


def test_the_whole_run(spark, docs, rows, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    packed = pipeline.run(spark, folder)
    by_stage = docs
    for _, stage in pipeline.STAGES[:-1]:
        by_stage = stage(spark, by_stage, folder)
    want = sorted(str(r.doc_id) for r in by_stage.select("doc_id").collect())
    first = packed.filter("start = 0")
    assert sorted(str(r.doc_id) for r in first.collect()) == want
    assert packed.agg(F.sum("length")).first()[0] == first.agg(F.sum("doc_tokens")).first()[0]


def test_rows_of_one_id_share_a_component(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(0, a), (1, a), (1, b), (2, b), (3, "other words alone"), (4, None), (None, a)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None) == [
        (0, 0, True), (1, 0, False), (1, 0, False), (2, 0, False), (3, 3, True), (4, 4, True),
    ]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_matches_are_placed_right_over_many_blocks(spark):
    for count in (1, private_data._TOGETHER, private_data._TOGETHER + 1, 1000):
        text = " ".join(f"é{i} 1.2.3.{i % 256}" for i in range(count))
        out = private_data.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
        assert out == " ".join(f"é{i} [IP]" for i in range(count))
