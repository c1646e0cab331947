import pytest

from marlstone.operators import pii, rescan
from marlstone.sources.scratch import scratch_path
from tests.conftest import rows

TEXTS = [("a", "mail ana@example.com"), ("b", "nothing here"), ("c", "ip 10.0.0.1"), ("d", None)]


def put(spark, path, *lines, parts=1):
    spark.createDataFrame(list(lines), "key string, body string").coalesce(parts).write.mode("append").parquet(path)


@pytest.fixture
def lake(spark):
    root = scratch_path(spark, "lake")
    put(spark, f"{root}/notes", *TEXTS)
    spark.createDataFrame([(1, "x@y.com")], "id int, email string").write.parquet(f"{root}/people")
    return {"lake": {"notes": f"{root}/notes", "people": f"{root}/people"}}


def expected(spark, lake):
    return rows(pii.scan_databases({d: {t: spark.read.parquet(p) for t, p in of.items()} for d, of in lake.items()}))


def test_a_rescan_reads_new_files_only(spark, lake):
    book = scratch_path(spark, "ledger")
    first = rescan.scan(spark, book, lake)
    assert first.kept == 0 and first.read >= 2
    assert rows(rescan.findings(spark, book, lake)) == expected(spark, lake)
    put(spark, lake["lake"]["notes"], ("e", "bob@example.org"), ("f", "eve@example.org"))
    again = rescan.scan(spark, book, lake)
    assert (again.read, again.kept) == (1, first.read)
    assert rows(rescan.findings(spark, book, lake)) == expected(spark, lake)
    assert rescan.scan(spark, book, lake).read == 0


def test_replaced_files_are_counted_anew(spark, lake):
    book, notes = scratch_path(spark, "ledger"), lake["lake"]["notes"]
    rescan.scan(spark, book, lake)
    spark.createDataFrame([("z", "plain")], "key string, body string").write.mode("overwrite").parquet(notes)
    rescan.scan(spark, book, lake)
    found = rows(rescan.findings(spark, book, lake))
    assert found == expected(spark, lake)
    assert {r[1] for r in found} == {"people"}


def test_other_patterns_read_all_files_again(spark, lake):
    book = scratch_path(spark, "ledger")
    total = rescan.scan(spark, book, lake).read
    ascii_only = rescan.Rules(unicode=False)
    assert rescan.scan(spark, book, lake, ascii_only).read == total
    assert rescan.scan(spark, book, lake, ascii_only).read == 0


def test_tables_that_are_not_named_keep_their_counts(spark, lake):
    book = scratch_path(spark, "ledger")
    rescan.scan(spark, book, lake)
    people = {"lake": {"people": lake["lake"]["people"]}}
    assert rescan.scan(spark, book, people).read == 0
    assert rescan.scan(spark, book, lake).read == 0


def test_files_without_rows_and_tables_without_text(spark):
    root, book = scratch_path(spark, "lake"), scratch_path(spark, "ledger")
    spark.createDataFrame([], "key string, body string").coalesce(1).write.parquet(f"{root}/none")
    spark.range(3).coalesce(1).write.parquet(f"{root}/numbers")
    lake = {"lake": {"none": f"{root}/none", "numbers": f"{root}/numbers"}, "empty": {}}
    rescan.scan(spark, book, lake)
    assert rescan.scan(spark, book, lake).read == 0
    assert rows(rescan.findings(spark, book, lake)) == []
    assert rows(rescan.findings(spark, book, {})) == []


def test_a_scan_that_fails_changes_nothing(spark, lake):
    book = scratch_path(spark, "ledger")
    rescan.scan(spark, book, lake)
    before = rows(rescan.ledger(spark, book))
    put(spark, lake["lake"]["notes"], ("e", "bob@example.org"))
    broken = {"lake": {**lake["lake"], "gone": scratch_path(spark, "gone")}}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        rescan.scan(spark, book, broken)
    assert rows(rescan.ledger(spark, book)) == before


def test_partitioned_tables_and_names_with_blanks(spark):
    root, book = scratch_path(spark, "lake"), scratch_path(spark, "ledger")
    data = [("a b", "ana@example.com"), ("a b", "x"), ("c", "joe@example.com")]
    spark.createDataFrame(data, "part string, body string").write.partitionBy("part").parquet(f"{root}/parted")
    lake = {"lake": {"parted": f"{root}/parted"}}
    rescan.scan(spark, book, lake)
    assert rows(rescan.findings(spark, book, lake)) == expected(spark, lake)
    assert rescan.scan(spark, book, lake).read == 0
