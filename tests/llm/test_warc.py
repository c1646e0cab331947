"""Archives against a sequential reader of their own, and the index against a scan of all records."""

import base64
import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marlstone.llm import warc

PAGES = "page_id long, url string, html string, key string, file string, offset int, sha1 string"


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(12)
    hosts = ["a.example.com", "b.example.com", "example.org", "U@Example.ORG:8080", "hot.example.net"]
    htmls = ["", None, "<p>é</p>", "x\r\n\r\ny", "WARC/1.1\r\n\r\n", "<p>" + "long " * 60_000 + "</p>"]
    out = []
    for page in range(300):
        host = "hot.example.net" if page % 3 == 0 else rng.choice(hosts)
        html = rng.choice(htmls) if page % 4 else f"<p>{page}</p>"
        out.append((page, f"http://{host}/{rng.randint(0, 4)}", html))
    out += [(None, None, "<p>é</p>"), (None, "http://a.example.com/0", "alone"), (400, None, "no url"), (401, "", "empty url")]
    out += [(402, "not a url\twith\nblanks", "odd"), (403, "http://a.example.com/\r\nX: y", "odd"), (-5, "http://a.example.com/0", "negative")]
    return out + [(404, "http://a.example.com/0", "twice"), (404, "http://a.example.com/0", "twice"), (404, "http://b.example.com/0", "once")]


@pytest.fixture(scope="module")
def frame(spark, pages):
    return spark.createDataFrame([(*page, "k", "f", 1, "s") for page in pages], PAGES).repartition(5)


@pytest.fixture(scope="module")
def archive(spark, frame, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("archive"))
    captures = warc.write_archives(frame, f"{folder}/warc", file_bytes=20_000)
    # Few lines would make one shard otherwise.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shards = warc.build_index(captures, f"{folder}/index", block_lines=7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return folder, captures, shards


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(pages):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page."""
    latest = {}
    for page, _, html in pages:
        old = latest.setdefault(html or "", page)
        if old is None or (page is not None and page > old):
            latest[html or ""] = page
    out = Counter()
    for page, _, html in pages:
        first = latest[html or ""] == page
        kind = ("response", None) if first else ("revisit", latest[html or ""])
        out[(page, len((html or "").encode()), digest(html), *kind)] += 1
    return out


def test_every_page_is_read_back_as_it_was_written(frame, pages, archive):
    folder, captures, shards = archive
    got = warc.fetch(warc.lookup(frame, f"{folder}/index", shards), f"{folder}/warc", tasks=warc.reading_tasks(captures))
    rows = got.collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r[n] for n in names) for r in rows) == expected(pages)
    by_id = {}
    for page, _, html in pages:
        by_id.setdefault(page, set()).add((html or "").encode())
    assert all(bytes(r.payload) in by_id[r.page_id] for r in rows if r.record_type == "response")
    assert all(r.payload is None for r in rows if r.record_type == "revisit")


def test_files_are_whole_archives(pages, archive):
    """Read from the front by the lengths in the records, without the index."""
    found = Counter()
    for file in Path(archive[0], "warc").iterdir():
        data = gzip.decompress(file.read_bytes())
        while data:
            head, rest = data.split(b"\r\n\r\n", 1)
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            length = int(fields[b"Content-Length"])
            block, data = rest[:length], rest[length:]
            assert head.startswith(b"WARC/1.1\r\n") and data.startswith(b"\r\n\r\n")
            data = data[4:]
            page = fields[b"WARC-Record-ID"][len(b"<page:") : -1]
            kind = fields[b"WARC-Type"].decode()
            payload = block.split(b"\r\n\r\n", 1)[1]
            found[(int(page) if page else None, kind)] += 1
            if kind == "response":
                assert fields[b"WARC-Payload-Digest"].decode() == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
            else:
                assert payload == b"" and b"WARC-Refers-To" in fields
    want = Counter()
    for (page, _, _, kind, _), n in expected(pages).items():
        want[(page, kind)] += n
    assert found == want


def test_a_url_finds_all_its_captures_over_blocks_and_shards(spark, frame, archive):
    folder, captures, shards = archive
    assert len(shards) > 1
    hot = [(f"http://HOT.example.net/{i}",) for i in range(5)] + [("http://nowhere.example/",), (None,)]
    asked = spark.createDataFrame(hot, "url string")
    got = warc.lookup(asked, f"{folder}/index", shards)
    want = captures.join(frame.select("page_id", "url"), warc._line_key(warc.url_key("url"), F.col("page_id")) == captures["key"], "left_semi")
    want = want.filter(F.col("key").startswith("net,example,hot)/") | F.col("key").startswith(" "))
    assert Counter(map(tuple, got.collect())) == Counter((r.file, r.offset, r.length) for r in want.collect())


def test_keys_sort_by_domain_and_page(spark):
    asked = [("http://a.b.example.com/x?q#f",), ("HTTPS://u:p@Example.com:80/X",), ("no host",), (None,), ("http://example.com",)]
    got = [r[0] for r in spark.createDataFrame(asked, "url string").select(warc.url_key("url")).collect()]
    assert got == ["com,example,b,a)/x?q#f", "com,example:80)/X", "no+host", "", "com,example)"]
    ids = spark.createDataFrame([(-(2**63),), (-1,), (0,), (7,), (2**63 - 1,), (None,)], "i long")
    keys = [r[0] for r in ids.select(warc._line_key(F.lit("k"), F.col("i"))).collect()]
    assert sorted(keys) == [keys[-1], *keys[:-1]]


def test_damage_is_noticed(archive):
    record = warc._record(1, "http://a/", b"payload", digest("payload"), None)
    assert warc._parse(record)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc._parse(record.replace(b"payload\r\n\r\n", b"paxload\r\n\r\n"))


def test_no_pages(frame, tmp_path):
    folder = str(tmp_path)
    none = frame.filter(F.lit(False))
    shards = warc.build_index(warc.write_archives(none, f"{folder}/warc"), f"{folder}/index")
    assert shards == []
    assert warc.fetch(warc.lookup(frame, f"{folder}/index", shards), f"{folder}/warc").collect() == []
