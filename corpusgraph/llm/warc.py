"""WARC archives from tables of pages, and tables from archives.

Records are sorted by page into ranges. A task writes its range as files of gzip members,
one per record, and begins a new file when the compressed size passes a limit; names come
from the range and a counter, so a task that runs again writes the same files. Files are
written under temporary names and moved when complete. The manifest, written last, lists
the files of the archive; what it does not list is not part of the archive.

Payloads that repeat are found from digests, in narrow rows. They meet the pages in the
sort: a row per repeated page travels to the range of its page and arrives just before it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_BYTES = 16 << 20  # compressed; a file passes it by one record at most
RANGE_BYTES = 64 << 20  # of payload
LEAST_REVISIT = 0  # payload bytes
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("8f1d3c1e-6f0b-4c58-9a52-0d6a3f0c7b11")

_MANIFEST = "file string, records bigint, bytes bigint, sha256 string, first_page bigint, last_page bigint"
_RECORDS = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, date string, file string"
)


def sha1_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page} {digest}')}>"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page, url, payload: bytes, refers_to, target_digest: str, date: str) -> bytes:
    """One record, headers and digests made anew. A revisit has no payload.

    The page's key is kept as ``X-Page-Id``; a missing address becomes ``urn:page:<key>``,
    and is marked so that reading gives null again.
    """
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    target = url if url is not None else f"urn:page:{page}"
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page, target_digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in target)),
        ("WARC-Payload-Digest", f"sha1:{target_digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Page-Id", json.dumps(page)),
        ("X-Payload-Length", str(len(payload))),
        ("X-Target", json.dumps(url)),
    ]
    if kind == "revisit":
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to, target_digest)),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


class _Files:
    """Files of one range, rolled by compressed size."""

    def __init__(self, folder: str, limit: int):
        self._system, self._folder = fs.FileSystem.from_uri(folder)
        self._uri, self._limit = folder, limit
        task = TaskContext.get()
        self._range, self._attempt = task.partitionId(), task.taskAttemptId()
        self._count, self._open = 0, None
        self.rows: list[tuple] = []

    def add(self, page: int | None, data: bytes) -> None:
        if self._open is None:
            self._name = f"part-{self._range:05d}-{self._count:05d}.warc.gz"
            self._temporary = f"{self._folder}/_temporary-{self._attempt}-{self._name}"
            self._open = self._system.open_output_stream(self._temporary, compression=None)
            self._seen, self._first = [0, 0, hashlib.sha256()], page
            self._put(_member(_info(self._name)))
        self._put(_member(data))
        self._seen[0] += 1
        self._last = page
        if self._seen[1] >= self._limit:
            self.close()

    def _put(self, data: bytes) -> None:
        self._open.write(data)
        self._seen[1] += len(data)
        self._seen[2].update(data)

    def close(self) -> None:
        """Move the finished file to its name."""
        if self._open is None:
            return
        self._open.close()
        self._system.move(self._temporary, f"{self._folder}/{self._name}")
        records, size, digest = self._seen
        self.rows.append(
            (f"{self._uri}/{self._name}", records, size, digest.hexdigest(), self._first, self._last)
        )
        self._count, self._open = self._count + 1, None


def _info(name: str) -> bytes:
    """The record that opens a file."""
    block = b"software: corpusgraph\r\nformat: WARC File Format 1.1\r\n"
    head = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, name)}>\r\n"
        f"WARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\n"
        f"Content-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def _write_range(folder: str, limit: int, date: str):
    """Sorted rows (page, url, payload, key, first) to the files' manifest rows.

    Rows without payload and with a key tell where the payloads of the page repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, limit)
        current, firsts, answered = object(), {}, set()
        for batch in batches:
            for page, url, payload, key, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if page != current:
                    current, firsts, answered = page, {}, set()
                if key is not None:
                    firsts[key] = first
                    continue
                refers_to = None
                if firsts:
                    own = hashlib.sha256(payload).hexdigest()
                    first = firsts.get(own)
                    if first is not None and (first != page or own in answered):
                        refers_to = first
                    answered.add(own)
                files.add(page, record(page, url, payload, refers_to, sha1_digest(payload), date))
        files.close()
        if files.rows:
            columns = zip(*files.rows, strict=True)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            names = [c.split()[0] for c in _MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    file_bytes: int = FILE_BYTES,
    range_bytes: int = RANGE_BYTES,
    least_revisit: int = LEAST_REVISIT,
    date: str = DATE,
) -> DataFrame:
    """Write one record per row below ``folder`` and return the manifest.

    Of records with equal payloads of at least ``least_revisit`` bytes, that with the
    smallest id is the response, the others are revisits of it. Ranges run over ids, so a
    payload that a third of all pages share does not gather anywhere.

    Null payloads are empty. Of rows that repeat an id and a payload, one is the response,
    the others revisit it. Rows without id are responses. An empty table gives an empty
    manifest and no files. ``folder`` must be one that all executors reach by its URI.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), payload.alias("payload")
    )
    digests = rows.filter("page is not null").select("page", F.sha2("payload", 256).alias("key"), F.octet_length("payload").alias("size"))
    digests = digests.filter(F.col("size") >= least_revisit)
    repeated = digests.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("first"))
    notes = digests.join(repeated.filter("n > 1"), "key").select("page", "key", "first").distinct()
    nothing = F.lit(None)
    both = rows.select("*", nothing.cast("string").alias("key"), nothing.cast("long").alias("first")).unionByName(
        notes.select("page", nothing.cast("string").alias("url"), nothing.cast("binary").alias("payload"), "key", "first")
    )
    size = rows.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    made = _folder_uri(spark, folder)
    manifest = (
        both.repartitionByRange(max(1, -(-size // range_bytes)), "page")
        .sortWithinPartitions("page", F.col("key").asc_nulls_last(), "url", F.sha2("payload", 256))
        .select("page", "url", "payload", "key", "first")
        .mapInArrow(_write_range(made, file_bytes, date), _MANIFEST)
    )
    manifest.write.mode("errorifexists").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def _folder_uri(spark: SparkSession, folder: str) -> str:
    """The folder, made if need be, as a URI with a scheme."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    uri = system.makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a file of gzip members."""
    at = 0
    while at < len(data):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            part = data[at : at + (1 << 14)]
            if not part:
                raise ValueError("the file ends within a record")
            parts.append(unpack.decompress(part))
            at += len(part)
        at -= len(unpack.unused_data)
        whole = b"".join(parts)
        head, _, block = whole.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")[1:]
        headers = dict(line.split(": ", 1) for line in lines)
        block = block[: int(headers["Content-Length"])]
        if headers.get("WARC-Block-Digest", f"sha1:{sha1_digest(block)}") != f"sha1:{sha1_digest(block)}":
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
        yield headers, block


def _read_files(folder: str, with_payload: bool):
    """Batches of (file) to records."""
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())

    def rows_of(file: str, data: bytes) -> Iterator[tuple]:
        for headers, block in parse_records(data):
            if headers["WARC-Type"] == "warcinfo":
                continue
            payload = block.partition(b"\r\n\r\n")[2]
            kind = headers["WARC-Type"]
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            size = int(headers["X-Payload-Length"])
            if kind == "response":
                size, digest = len(payload), sha1_digest(payload)
            refers_to = headers.get("X-Refers-To-Page")
            yield (
                json.loads(headers["X-Page-Id"]),
                json.loads(headers["X-Target"]),
                payload if with_payload and kind == "response" else None,
                size,
                digest,
                kind,
                None if refers_to is None else int(refers_to),
                headers["WARC-Date"],
                file,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(file)
                with system.open_input_stream(path, compression=None) as stream:
                    data = stream.read()
                held: list[tuple] = []
                for row in rows_of(file, data):
                    held.append(row)
                    if len(held) == 512:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of an archive's manifest; only a response has a payload of its own.

    A file, bounded by its compressed size, is read by one task. Digests of responses are
    computed from the payloads that were read; damaged blocks raise.
    """
    files = read_manifest(spark, folder).select("file")
    count = max(1, files.count())
    return (
        files.repartition(count)
        .mapInArrow(_read_files(folder, with_payload), _RECORDS)
    )
