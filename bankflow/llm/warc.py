"""WARC archives, written from and read back into a chunked record table.

A record is one or more rows (record, chunk number) of at most ``CHUNK_BYTES`` of its payload, so no task holds more of a
record than a chunk once it has been read from its table. Every chunk carries the SHA-1 digest of the payload up to its
end, computed as the chunks go by; the last one has the digest of the whole. The digests decide which records are copies:
of equal payloads that of the smallest id is written as ``response``, the others as ``revisit`` records without payload.

Writing: the headers join the chunks as chunk number -1, all are sorted by record and chunk, and a task streams them into
archives of about ``ARCHIVE_BYTES``, each record a gzip member of its own. A file has a name that no other attempt uses,
and counts only if its row reached the written table of archives, so a lost executor leaves no half archive behind.

Reading: a task takes an archive as a stream, record by record and chunk by chunk, and compares the digest it arrives at
with the header's; a damaged or cut archive fails the read. Archives lie in the cluster's shared folder, which Arrow's
file systems (local and mounted paths, HDFS, S3, GCS) must reach.

Defined results: a null payload is empty; equal payloads are those equal in length and SHA-256 as well; a null id comes
after all others; rows that repeat an id are records of their own, the first read is the response; null or odd addresses
are left out or percent-encoded; an empty table writes no archive and reads as no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import Any
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankflow.plans.workspace import materialize, new_path

CHUNK_BYTES = 1 << 18
ARCHIVE_BYTES = 1 << 30
# Bytes of chunks in one Arrow batch.
BATCH_BYTES = 1 << 22
DATE = "2000-01-01T00:00:00Z"

_CHUNKS = "record long, chunk int, last boolean, key long, uri string, data binary, bytes long, digest string, strong string"
_ARCHIVES = "path string, records long, bytes long"
_READ = ("record long, chunk int, last boolean, key long, uri string, type string, refers_record long, data binary, "
         "bytes long, digest string")
_CHUNKS_ARROW = pa.schema([
    ("record", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("key", pa.int64()), ("uri", pa.string()),
    ("data", pa.binary()), ("bytes", pa.int64()), ("digest", pa.string()), ("strong", pa.string())])
_READ_ARROW = pa.schema([
    ("record", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("key", pa.int64()), ("uri", pa.string()),
    ("type", pa.string()), ("refers_record", pa.int64()), ("data", pa.binary()), ("bytes", pa.int64()),
    ("digest", pa.string())])


def base32(digest: Any) -> str:
    """Bare upper-case form of what a hash has seen so far."""
    return base64.b32encode(digest.digest()).decode()


def _flushed(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["data"] or b"") + 200
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            records, keys, uris = (batch.column(c).to_pylist() for c in ("record", "key", "uri"))
            for at, payload in enumerate(batch.column("payload")):
                whole = memoryview(payload.as_buffer()) if payload.is_valid else memoryview(b"")
                digest, strong = hashlib.sha1(), hashlib.sha256()
                for number in range(max(1, math.ceil(len(whole) / CHUNK_BYTES))):
                    piece = whole[number * CHUNK_BYTES : (number + 1) * CHUNK_BYTES]
                    digest.update(piece)
                    strong.update(piece)
                    end = number * CHUNK_BYTES + len(piece)
                    last = end == len(whole)
                    yield {
                        "record": records[at], "chunk": number, "last": last, "key": keys[at],
                        "uri": uris[at] if last else None, "data": bytes(piece), "bytes": end, "digest": base32(digest),
                        "strong": strong.hexdigest() if last else None,
                    }

    yield from _flushed(rows(), _CHUNKS_ARROW)


def chunk_table(pages: DataFrame, key: str, payload: str, uri: str | None = None) -> DataFrame:
    """The chunked record table: ``record, chunk, last, key, uri, data, bytes, digest, strong``, written.

    ``record`` numbers the rows; ``bytes`` and ``digest`` are of the payload up to the end of the chunk; ``strong``, the
    SHA-256 of the whole, and ``uri`` stand in the last chunk.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("record"), F.col(key).cast("long").alias("key"),
        (F.lit(None) if uri is None else F.col(uri)).cast("string").alias("uri"),
        F.col(payload).cast("binary").alias("payload"))
    path = new_path(pages.sparkSession, "chunks")
    rows.mapInArrow(_chunked, _CHUNKS).write.option("compression", "zstd").parquet(path)
    return pages.sparkSession.read.schema(_CHUNKS).parquet(path)


def record_headers(chunks: DataFrame, least_bytes: int = 0) -> DataFrame:
    """One row per record: what its header says. Copies of ``least_bytes`` or more refer to their response."""
    records = chunks.filter("last").select("record", "key", "uri", "bytes", "digest", "strong")
    groups = (
        records.filter(F.col("bytes") >= least_bytes).groupBy("strong", "bytes")
        .agg(F.min(F.struct(F.col("key").isNull().alias("late"), "key", "record", "uri")).alias("first"),
             F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("strong", "bytes", "first")
    )
    refers = F.col("first").isNotNull() & (F.col("first.record") != F.col("record"))
    return records.join(groups, ["strong", "bytes"], "left").select(
        "record", "key", "uri", "bytes", "digest", F.when(refers, "revisit").otherwise("response").alias("type"),
        F.when(refers, F.col("first.record")).alias("refers_record"),
        F.when(refers, F.col("first.uri")).alias("refers_uri"))


def _record_id(record: int) -> str:
    return f"<urn:record:{record}>"


def _address(uri: str | None) -> str | None:
    """An address fit for a header line."""
    return quote(uri, safe="!#$%&'()*+,/:;=?@[]~-._") if uri else None


def _head(row: dict) -> bytes:
    """Header of a record and the beginning of its block, an HTTP head without the payload."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {row['bytes']}\r\n\r\n"
    revisit = row["type"] == "revisit"
    fields = {
        "WARC-Type": row["type"],
        "WARC-Record-ID": _record_id(row["record"]),
        "WARC-Date": DATE,
        "WARC-Target-URI": _address(row["uri"]),
        "WARC-Payload-Digest": f"sha1:{row['digest']}",
        "WARC-Refers-To": _record_id(row["refers_record"]) if revisit else None,
        "WARC-Refers-To-Target-URI": _address(row["refers_uri"]),
        "WARC-Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest" if revisit else None,
        "Record-Key": row["key"],
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(http) + (0 if revisit else row["bytes"]),
    }
    named = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return f"WARC/1.0\r\n{named}\r\n{http}".encode()


class _Archive:
    """An archive being written: every record is a gzip member, and goes out as it comes in."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        store, path = fs.FileSystem.from_uri(self.path)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(path, compression=None)
        self.records = self.bytes = 0

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.records += 1
        self.add(head)

    def add(self, data: bytes) -> None:
        self._out(self.member.compress(data))

    def end(self) -> None:
        self._out(self.member.compress(b"\r\n\r\n") + self.member.flush())

    def _out(self, data: bytes) -> None:
        self.bytes += len(data)
        self.out.write(data)

    def closed(self) -> pa.RecordBatch:
        self.out.close()
        return pa.RecordBatch.from_pylist([{"path": self.path, "records": self.records, "bytes": self.bytes}], pa.schema(
            [("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))


def _writing(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, open_, due, seen = None, None, 0, 0

        def finish() -> None:
            if open_["type"] == "response" and seen != open_["bytes"]:
                raise ValueError(f"record {open_['record']} has {seen} bytes of {open_['bytes']}")
            archive.end()

        for batch in batches:
            for at in range(len(batch)):
                if batch.column("chunk")[at].as_py() < 0:
                    if open_ is not None:
                        finish()
                        if archive.bytes >= ARCHIVE_BYTES:
                            yield archive.closed()
                            archive = None
                    archive = archive or _Archive(folder)
                    open_ = batch.slice(at, 1).to_pylist()[0]
                    seen = 0
                    archive.begin(_head(open_))
                elif open_["type"] == "response":
                    data = batch.column("data")[at].as_py()
                    seen += len(data)
                    archive.add(data)
        if archive is not None:
            finish()
            yield archive.closed()

    return run


def write_archives(chunks: DataFrame, headers: DataFrame, folder: str) -> DataFrame:
    """Writes all records below ``folder``; returns ``path, records, bytes`` of the archives, written."""
    spark = chunks.sparkSession
    columns = ["record", "chunk", "type", "key", "uri", "bytes", "digest", "refers_record", "refers_uri", "data"]
    total = headers.agg(F.sum("bytes")).first()[0]
    # At least an archive for each core, so that small tables are written in parallel too.
    parts = max(math.ceil((total or 0) / ARCHIVE_BYTES), spark.sparkContext.defaultParallelism)
    rows = headers.withColumn("chunk", F.lit(-1)).unionByName(
        chunks.select("record", "chunk", "data"), allowMissingColumns=True).select(*columns)
    return materialize(
        rows.repartition(parts, "record").sortWithinPartitions("record", "chunk").mapInArrow(_writing(folder), _ARCHIVES),
        "archives")


def _fields(archive: gzip.GzipFile) -> dict[str, str] | None:
    """Named fields of the next record, None at the end."""
    line = archive.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/1."):
        raise ValueError(f"no record begins with {line[:40]!r}")
    fields = {}
    while (line := archive.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        fields[name.lower()] = value.strip()
    return fields


def _number(record_id: str) -> int:
    return int(record_id.removeprefix("<urn:record:").removesuffix(">"))


def records_in(archive: gzip.GzipFile, payloads: bool = True) -> Iterator[dict]:
    """Chunks of the records of an archive, in their order; without ``payloads`` only their sizes and digests."""
    while (fields := _fields(archive)) is not None:
        left = int(fields["content-length"])
        kind, expected = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
        key = fields.get("record-key")
        row = {
            "record": _number(fields["warc-record-id"]), "key": None if key is None else int(key),
            "uri": fields.get("warc-target-uri"), "type": kind, "refers_record": None, "data": None,
        }
        while left:
            line = archive.readline(left)
            left -= len(line)
            if line in (b"\r\n", b""):
                break
        if kind == "revisit":
            yield row | {"chunk": 0, "last": True, "refers_record": _number(fields["warc-refers-to"]), "bytes": None,
                         "digest": expected}
        else:
            digest, size, number, whole = hashlib.sha1(), 0, 0, left
            while number == 0 or size < whole:
                piece = archive.read(min(CHUNK_BYTES, whole - size))
                if not piece and size < whole:
                    raise EOFError(f"record {row['record']} ends after {size} of {whole} bytes")
                digest.update(piece)
                size += len(piece)
                found = base32(digest)
                if size == whole and found != expected:
                    raise ValueError(f"record {row['record']} has digest {found}, its header says {expected}")
                yield row | {"chunk": number, "last": size == whole, "data": piece if payloads else None, "bytes": size,
                             "digest": found}
                number += 1
        if archive.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {row['record']} has no end")


def _reading(payloads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for uri in batch.column("path").to_pylist():
                    store, path = fs.FileSystem.from_uri(uri)
                    with store.open_input_stream(path, compression=None, buffer_size=1 << 20) as source, \
                            gzip.GzipFile(fileobj=source) as archive:
                        yield from records_in(archive, payloads)

        yield from _flushed(rows(), _READ_ARROW)

    return run


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The chunked record table of archives (``path``): ``record, chunk, last, key, uri, type, refers_record, data,
    bytes, digest``. An archive is read by one task."""
    spark = archives.sparkSession
    files = max(1, archives.count())
    return archives.select("path").repartition(min(files, max(files // 4, spark.sparkContext.defaultParallelism))).mapInArrow(
        _reading(payloads), _READ)


def round_trip(
    pages: DataFrame, key: str = "page_id", payload: str = "html", uri: str | None = "url", least_bytes: int = 0,
    folder: str | None = None,
) -> DataFrame:
    """Archives all rows and reads the archives back: one row per record, ``record, key, uri, type, refers_to, bytes,
    digest``; sizes and digests are of what was read, for a revisit of the record that it refers to."""
    chunks = chunk_table(pages, key, payload, uri)
    headers = materialize(record_headers(chunks, least_bytes), "headers")
    archives = write_archives(chunks, headers, folder or new_path(pages.sparkSession, "warc"))
    read = materialize(read_archives(archives, payloads=False).filter("last").drop("data", "chunk", "last"), "records")
    responses = read.filter("type = 'response'")
    revisits = read.filter("type = 'revisit'").drop("bytes", "digest")
    named = responses.select(
        F.col("record").alias("refers_record"), F.col("key").alias("refers_to"), "bytes", "digest")
    resolved = revisits.join(named, "refers_record")
    columns = ["record", "key", "uri", "type", "refers_to", "bytes", "digest"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(
        resolved.select(*columns))


def warc_digest(pages: DataFrame) -> DataFrame:
    return round_trip(pages).select(
        F.col("key").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
