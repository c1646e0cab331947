"""WARC archives with a two-level index of captures.

Archives: every task writes the records of its rows, one gzip member each, into files of its own and
returns one line per record: key, file, offset, length. A record whose payload another page of a
larger id also has is a revisit: it keeps the headers and names the record it refers to.

Index: the key of a capture is its URL with the host's labels reversed, then the page id, so that
captures of one domain and of one URL lie together. Lines are range-partitioned and sorted by key and
written as shards; a shard holds compressed blocks of lines and, at its end, a sparse directory with
the last key, offset and length of each block. Only the last key and the size of each shard, as many
as there are partitions, are known to all tasks. A lookup searches the shards and then the directory
of one shard by bisection and reads the one block by its range. Records are read by file and place,
those that lie close together in one range.

Files are written through Arrow's file systems (local or mounted paths, hdfs, s3, gs). A task tried
again writes new files; files that no line names are not read. Lines are kept in a written table, so
a lost executor repeats only its part.

Defined results: null html is an empty payload; a null URL has an empty key, one without scheme and
host is its own key. A null page id counts as smaller than all others; of records with equal payloads
and the largest id all are responses, if rows repeat under that id or have none. Columns other than
page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.scratch import scratch_path, written

FILE_BYTES = 1 << 30
BLOCK_LINES = 2000
# Ranges of one file that lie this close are read at once, up to this much.
GAP, RANGE_BYTES = 1 << 16, 8 << 20
# What one task reads of one file.
PIECE_BYTES = 16 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def _storage(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def url_key(url: str) -> Column:
    """`http://a.example.com/x?y` as `com,example,a)/x?y`, without blanks and control characters."""
    column = F.coalesce(F.col(url).cast("string"), F.lit(""))
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*://"
    host = F.lower(F.regexp_replace(F.regexp_extract(column, scheme + "([^/?#]*)", 1), "^.*@", ""))
    name, port = F.regexp_extract(host, "^(.*?)(:[0-9]*)?$", 1), F.regexp_extract(host, "(:[0-9]*)$", 1)
    rest = F.regexp_replace(column, scheme + "[^/?#]*", "")
    turned = F.concat(F.array_join(F.reverse(F.split(name, r"\.")), ","), port, F.lit(")"), rest)
    return F.regexp_replace(F.when(host != "", turned).otherwise(column), r"[\x00-\x20\x7F]", "+")


def _line_key(key: Column, page_id: Column) -> Column:
    """Sorts by URL key and then by page id, as text."""
    number = F.lpad(F.hex(page_id.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat_ws(" ", key, F.coalesce(number, F.lit("")))


def _header_value(url: str) -> str:
    return "".join(c if " " <= c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One record; `original` is the page that a revisit refers to."""
    answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = answer if original is not None else answer + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: <page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if original is not None:
        head += [f"WARC-Refers-To: <page:{original}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _parse(record: bytes) -> dict:
    """The fields of a record and its payload; a response that does not fit its digest is an error."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    answer, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in answer.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of record {fields['WARC-Record-ID']} is damaged")

    def page(name: str) -> int | None:
        value = fields.get(name, "")[len("<page:") : -1]
        return int(value) if value else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


class _Files:
    """Files of one task, a new one whenever the last is full."""

    def __init__(self, folder: str, suffix: str, most: int):
        self.fs, self.folder = _storage(folder)
        self.suffix, self.most = suffix, most
        self.name, self.stream, self.at = "", None, 0

    def add(self, data: bytes) -> tuple[str, int]:
        if self.stream is not None and self.at >= self.most:
            self.close()
        if self.stream is None:
            self.fs.create_dir(self.folder, recursive=True)
            self.name, self.at = f"{uuid.uuid4().hex}{self.suffix}", 0
            self.stream = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        place = self.at
        self.stream.write(data)
        self.at += len(data)
        return self.name, place

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per page; one line (key, file, offset, length) for each, as a written table."""
    pages = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("sha1", F.sha1("payload"))
    # Payloads that occur once need no partner, so this table is small and its size is known when it is joined.
    shared = pages.groupBy("sha1").agg(F.max(F.col("page_id").cast("long")).alias("latest"), F.count(F.lit(1)).alias("n"))
    shared = written(shared.filter("n > 1").select("sha1", "latest"), "shared")
    pages = pages.join(shared, "sha1", "left").withColumn("key", _line_key(url_key("url"), F.col("page_id")))
    original = F.when(~F.col("page_id").cast("long").eqNullSafe(F.col("latest")), F.col("latest"))
    rows = pages.select("key", F.col("page_id").cast("long").alias("page_id"), "url", "payload", "sha1", original.alias("original"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, ".warc.gz", file_bytes)
        for batch in batches:
            places = []
            columns = [batch.column(name).to_pylist() for name in ("page_id", "url", "payload", "sha1", "original")]
            for page_id, url, payload, sha1, original in zip(*columns, strict=True):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                member = gzip.compress(_record(page_id, url, payload, digest, original), 6, mtime=0)
                places.append((*files.add(member), len(member)))
            name, offset, length = zip(*places, strict=True) if places else ((), (), ())
            types = (pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(x, t) for x, t in zip((name, offset, length), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *arrays], ["key", "file", "offset", "length"])
        files.close()

    return written(rows.mapInArrow(write, "key string, file string, offset long, length long"), "captures")


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[bytes, str, int, int]]:
    """Write the index of captures; one (last key, file, offset, length of the directory) per shard."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, directory, lines, last = _Files(folder, ".cdx", 1 << 62), [], [], ""

        def block() -> None:
            data = zlib.compress("\n".join(lines).encode(), 6)
            directory.append((last, files.add(data)[1], len(data)))
            lines.clear()

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("key", "file", "offset", "length")]
            for line in zip(*columns, strict=True):
                last = line[0]
                lines.append("\t".join(map(str, line)))
                if len(lines) >= block_lines:
                    block()
        if lines:
            block()
        if directory:
            data = zlib.compress(json.dumps(directory).encode(), 6)
            name, place = files.add(data)
            files.close()
            columns = {"last": [last], "file": [name], "offset": [place], "length": [len(data)]}
            yield pa.RecordBatch.from_pydict(columns)

    ordered = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    shards = written(ordered.mapInArrow(write, "last string, file string, offset long, length long"), "shards")
    # One row per partition.
    return sorted((r["last"].encode(), r["file"], r["offset"], r["length"]) for r in shards.collect())


class _Index:
    """Shards of an index, searched by ascending keys; keeps one directory and one block."""

    def __init__(self, folder: str, shards: list[tuple[bytes, str, int, int]]):
        self.fs, self.folder = _storage(folder)
        self.shards, self.last = shards, [shard[0] for shard in shards]
        self.held: dict[str, tuple] = {}

    def _range(self, kind: str, file: str, offset: int, length: int) -> bytes:
        place = (file, offset)
        if self.held.get(kind, (None,))[0] != place:
            with self.fs.open_input_file(f"{self.folder}/{file}") as stream:
                stream.seek(offset)
                self.held[kind] = place, self._decode(kind, zlib.decompress(stream.read(length)))
        return self.held[kind][1]

    @staticmethod
    def _decode(kind: str, data: bytes):
        if kind == "directory":
            blocks = json.loads(data)
            return [key.encode() for key, _, _ in blocks], blocks
        lines = [line.split(b"\t") for line in data.split(b"\n")]
        return [line[0] for line in lines], lines

    def find(self, low: bytes, high: bytes) -> Iterator[list[bytes]]:
        """All lines with low <= key <= high, over as many blocks and shards as hold them."""
        for shard in range(bisect_left(self.last, low), len(self.shards)):
            _, file, offset, length = self.shards[shard]
            ends, blocks = self._range("directory", file, offset, length)
            for at in range(bisect_left(ends, low), len(blocks)):
                keys, lines = self._range("block", file, *blocks[at][1:])
                for line in range(bisect_left(keys, low), len(lines)):
                    if keys[line] > high:
                        return
                    yield lines[line]


def lookup(asked: DataFrame, folder: str, shards: list[tuple[bytes, str, int, int]]) -> DataFrame:
    """Places (file, offset, length) of the captures of the asked rows: `url`, and `page_id` if there.

    Without page_id, all captures whose URL has the same key are found. Asking twice finds once.
    """
    key = url_key("url")
    if "page_id" in asked.columns:
        low = high = _line_key(key, F.col("page_id"))
    else:
        low, high = F.concat(key, F.lit(" ")), F.concat(key, F.lit(" ~"))
    asked = asked.select(low.alias("low"), high.alias("high")).distinct()
    asked = asked.repartitionByRange("low").sortWithinPartitions("low")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(folder, shards)
        for batch in batches:
            found = []
            for low, high in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), strict=True):
                for _, file, offset, length in index.find(low.encode(), high.encode()):
                    found.append((file.decode(), int(offset), int(length)))
                    if len(found) >= 10_000:
                        yield _places(found)
                        found = []
            yield _places(found)

    return asked.mapInArrow(find, "file string, offset long, length long")


def _places(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in found], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))], ["file", "offset", "length"]
    )


def fetch(places: DataFrame, folder: str, with_payload: bool = True, tasks: int | None = None) -> DataFrame:
    """The records at these places: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and, if wanted, payload (null for revisits).

    Places are far smaller than what is read for them, so tasks are better counted by `reading_tasks`
    than left to the size of the places.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", payload binary" if with_payload else ""
    names = [field.split()[0] for field in schema.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[field.split()[1]] for field in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, top = _storage(folder)
        open_name, stream = None, None
        for batch in batches:
            rows = list(zip(*[batch.column(name).to_pylist() for name in ("file", "offset", "length")], strict=True))
            at = 0
            while at < len(rows):
                file, begin, length = rows[at]
                to, end = at + 1, begin + length
                while to < len(rows) and rows[to][0] == file and rows[to][1] <= end + GAP and rows[to][1] + rows[to][2] <= begin + RANGE_BYTES:
                    end = max(end, rows[to][1] + rows[to][2])
                    to += 1
                if file != open_name:
                    if stream is not None:
                        stream.close()
                    open_name, stream = file, storage.open_input_file(f"{top}/{file}")
                stream.seek(begin)
                data = stream.read(end - begin)
                found = [_parse(gzip.decompress(data[o - begin : o - begin + n])) for _, o, n in rows[at:to]]
                yield pa.RecordBatch.from_arrays([pa.array([row[c] for row in found], t) for c, t in zip(names, types, strict=True)], names)
                at = to
        if stream is not None:
            stream.close()

    piece = ("file", F.floor(F.col("offset") / PIECE_BYTES))
    pieces = places.repartition(tasks, *piece) if tasks else places.repartition(*piece)
    return pieces.sortWithinPartitions("file", "offset").mapInArrow(read, schema)


def reading_tasks(captures: DataFrame) -> int:
    """As many tasks as all these records fill pieces."""
    return -(-(captures.agg(F.sum("length")).first()[0] or 1) // PIECE_BYTES)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = scratch_path(spark, "archives")
    captures = write_archives(pages, f"{folder}/warc")
    shards = build_index(captures, f"{folder}/index")
    places = lookup(pages.select("page_id", "url"), f"{folder}/index", shards)
    return fetch(places, f"{folder}/warc", False, reading_tasks(captures)).drop("url")
