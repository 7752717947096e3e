"""Web archives: one gzip member per record, written and read back as a stream.

``write`` puts each row into a WARC 1.1 record.  Of records with equal payloads
of at least ``REVISIT_BYTES`` the one with the largest id is a response, the
others are revisits that name it and hold headers only.  ``read`` goes through
an archive from front to back: zlib inflates a chunk at a time, records are
framed by their content length, one member must hold exactly one record, and
the payload digest is recomputed as the payload passes by.  Memory per task is
one record when writing and, unless payloads are wanted, one chunk when reading.

Archives go to the shared folder through the file system that its address
names.  Every task attempt writes files of its own; the table of finished files
is written by Spark, so a file left by a lost executor is never read.

Cases: a null payload is empty, a null URL has no target field, a null id has no
id field and is never referred to; rows with the same largest id are all
responses; rows that share an id each keep their own payload and referral; repeated
rows give repeated records; extra columns are not read; an
empty table gives no archive and no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ..functions.segments import durable, shared_folder

REVISIT_BYTES = 1000
FILE_BYTES = 1 << 28
CHUNK = 1 << 16
LEVEL = 6
WRITTEN_AT = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = "path string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, digest_ok boolean, payload binary"


class BadArchive(ValueError):
    """The bytes do not follow the archive format."""


def revisits(pages: DataFrame, page_id: str = "page_id", payload: str = "html") -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload another page holds with a larger id.

    Only digests and ids are grouped; group maxima are combined before the shuffle.
    """
    data = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    small = pages.where(F.octet_length(data) >= REVISIT_BYTES).select(F.col(page_id).cast("long").alias("page_id"), F.sha1(data.cast("binary")).alias("digest"))
    groups = small.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return small.join(groups, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, not yet compressed."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {WRITTEN_AT}"]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"Refers-To-Page-Id: {refers_to}"]
    head += [f"WARC-Payload-Digest: {digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    return zlib.compress(data, level, 31)


def write(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write all rows to archives under ``folder`` (a new shared one if null); one row per finished file."""
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(payload).cast("string").alias("payload"))
    # Rows may share an id and differ in their payloads, so the digest is part of the key.
    data = F.coalesce("payload", F.lit(""))
    rows = rows.withColumn("digest", F.when(F.octet_length(data) >= REVISIT_BYTES, F.sha1(data.cast("binary"))))
    rows = rows.join(revisits(rows, "page_id", "payload"), ["page_id", "digest"], "left").select("page_id", "url", "refers_to", "payload")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        done, out, size, count, name = [], None, 0, 0, ""
        for batch in batches:
            for page, target, refers, text in zip(*(batch.column(c) for c in ("page_id", "url", "refers_to", "payload"))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size, count = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = member(record(page.as_py(), target.as_py(), (text.as_py() or "").encode(), refers.as_py()))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done) if done else [[], [], []], (pa.string(), pa.int64(), pa.int64()))], ["path", "n_records", "n_bytes"])

    return durable(rows.mapInArrow(put, FILES))


class _Record:
    """Takes the inflated bytes of one record and keeps what its frame asks for."""

    def __init__(self, keep: bool) -> None:
        self.head, self.http, self.keep = b"", b"", keep
        self.fields: dict[str, str] | None = None
        self.left, self.in_payload, self.n, self.tail = 0, False, 0, b""
        self.sha, self.parts = hashlib.sha1(), []

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                return
            data = self.head[end + 4:]
            lines = self.head[:end].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise BadArchive("a record must begin with its version")
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            self.left = int(self.fields["content-length"])
        block, self.tail = data[:self.left], self.tail + data[self.left:]
        self.left -= len(block)
        if not self.in_payload:
            self.http += block
            end = self.http.find(b"\r\n\r\n")
            if end < 0:
                return
            block, self.http, self.in_payload = self.http[end + 4:], self.http[:end], True
        self.sha.update(block)
        self.n += len(block)
        if self.keep:
            self.parts.append(block)

    def finish(self) -> tuple:
        if self.fields is None or self.left or self.tail != b"\r\n\r\n":
            raise BadArchive("a gzip member must hold exactly one whole record")
        kind, digest = self.fields["warc-type"], base64.b32decode(self.fields["warc-payload-digest"].removeprefix("sha1:"))
        length = int(re.search(rb"(?im)^content-length:\s*(\d+)", self.http)[1])
        ok = None if kind == "revisit" else digest == self.sha.digest() and length == self.n
        whole = lambda k: int(self.fields[k]) if k in self.fields else None
        return whole("page-id"), self.fields.get("warc-target-uri"), kind, whole("refers-to-page-id"), length, digest.hex(), ok, b"".join(self.parts) if self.keep and kind != "revisit" else None


def records(chunks: Iterator[bytes], keep: bool = False) -> Iterator[tuple]:
    """Records of one archive, read as a stream of chunks of any size."""
    inflate, now = zlib.decompressobj(31), _Record(keep)
    begun = False
    for chunk in chunks:
        while chunk:
            begun = True
            now.feed(inflate.decompress(chunk, CHUNK * 16))
            chunk = inflate.unconsumed_tail
            if inflate.eof:
                yield now.finish()
                chunk, inflate, now, begun = inflate.unused_data, zlib.decompressobj(31), _Record(keep), False
    if begun:
        raise BadArchive("the archive ends within a member")


def read(files: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the archives listed in column ``path``, one archive after the other within a task."""
    names = [f.split()[0] for f in RECORDS.split(", ")]
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary())

    def chunks(path: str) -> Iterator[bytes]:
        store, place = fs.FileSystem.from_uri(path)
        with store.open_input_stream(place, compression=None) as stream:
            while data := stream.read(CHUNK):
                yield data

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for r in records(chunks(path), payloads):
                    rows.append(r)
                    held += len(r[-1] or b"") + 1000
                    if held >= 1 << 23:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)

    spark = files.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.select("path").repartition(tasks, "path").mapInArrow(get, RECORDS)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the pages, read the archives back."""
    return read(write(pages, None, page_id, url, payload))
