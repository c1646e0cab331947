import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone import rules
from marlstone.operators import pii
from marlstone.sources import writers
from marlstone.sources.catalog import tables_of
from marlstone.sources.scratch import scratch_path
from tests.conftest import rows

SCHEMA = "id int, CPF_cliente string, contato string, nota string, cargo string, vazio string"


@pytest.fixture
def people(spark):
    data = [(i, "x", f"p{i}@mail.com" if i % 4 == 0 else "none", "n", "chefe", None)
            for i in range(20)]
    return spark.createDataFrame(data, SCHEMA)


def test_first_hint_wins():
    assert pii.hint_for("EMAIL_CPF").pii_type == "CPF"
    assert pii.hint_for("hash_senha").hint == "senha"
    assert pii.hint_for("cargo").pii_type == "RG"
    assert pii.hint_for("cargo", match="token") is None
    assert pii.hint_for("num_rg", match="token").pii_type == "RG"
    assert pii.hint_for("valor") is None


def test_scan(people):
    found = {r.column: r for r in pii.scan_table(people, "db", "people").collect()}
    assert set(found) == {"CPF_cliente", "contato", "cargo"}
    assert found["CPF_cliente"].confidence == "high" and found["CPF_cliente"].match_rate is None
    assert (found["contato"].pii_type, found["contato"].match_rate) == ("Email", 0.25)
    assert pii.scan_table(people.select("id"), "db", "t").count() == 0
    token = pii.scan_table(people, "db", "people", match="token")
    assert {r.column for r in token.collect()} == {"CPF_cliente", "contato"}


def test_patterns_agree_with_plain_regex_search(spark):
    texts = [
        "123.456.789-09", "12345678909", "cpf 123.456.789-0", "12.345.678/0001-95",
        "A@B.CO", "a@b", "+55 (11) 98765-4321", "11987654321", "01310-100", "01310100",
        "12.345.678-X", "1.234.567-8", "é12345678", "123", "", "１２３４５６７８", "9 9 9", "ab\n01310-100",
    ]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    found = {r.pii_type: r for r in pii.pattern_rates(df, "t").collect()}
    for p in rules.PATTERNS:
        expected = sum(
            bool(re.search(p.regex, t, re.IGNORECASE if p.ignore_case else 0)) for t in texts
        )
        assert (p.pii_type, found[p.pii_type].matched) == (p.pii_type, expected)
        assert found[p.pii_type]["values"] == len(texts)


def test_what_patterns_need_never_hides_a_match(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bare = [p._replace(needs=None) for p in rules.PATTERNS]
    assert rows(pii.pattern_rates(df, "d")) == rows(pii.pattern_rates(df, "d", patterns=bare))


def test_tags_survive_parquet(spark, people):
    found = pii.findings_of(pii.scan_table(people, "db", "people"), "db", "people")
    tagged = pii.tag_columns(people, found, "2024-01-01")
    path = scratch_path(spark, "tagged")
    writers.write_parquet(tagged, path)
    tags = pii.column_tags(spark.read.parquet(path))
    assert set(tags) == {"CPF_cliente", "contato", "cargo"}
    assert tags["contato"]["PII"] == "Email"
    assert tags["contato"]["LGPD_Classification"] == rules.PERSONAL
    assert tags["contato"]["pii_confidence"] == "medium"


def test_masking(people):
    found = pii.findings_of(pii.scan_table(people, "db", "people"), "db", "people")
    masked = pii.mask_found(people, found)
    assert masked.schema == people.schema or masked.columns == people.columns
    assert masked.filter("contato is not null or CPF_cliente is not null").count() == 0
    assert masked.select("nota").distinct().count() == 1
    assert pii.mask_found(people, found, drop=True).columns == ["id", "nota", "vazio"]
    typed = pii.mask_as_null(people, {"contato": "string"})
    assert isinstance(typed.schema["contato"].dataType, T.StringType)


def test_excluded_view(people):
    view = pii.column_excluded_view(people, "people_view", ["CPF_cliente"], F.col("id") < 3)
    assert "CPF_cliente" not in view.columns and view.count() == 3


def test_databases_and_report(spark, people):
    root = scratch_path(spark, "lake")
    writers.save_model(people, "pii_db", "people", root)
    writers.save_model(people.select("id"), "pii_db", "ids", root)
    tables = tables_of(spark, "pii_db")
    assert set(tables) == {"people", "ids"}
    found = pii.scan_databases({"pii_db": tables})
    report = json.loads(pii.findings_report(found, "2024-01-01", ["pii_db"]).first().json)
    assert report["total_pii_cols"] == 3
    assert report["findings"][0]["match_rate"] is None
