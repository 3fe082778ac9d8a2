"""WARC records in ZIP archives: a writer, and a reader that seeks.

An archive is a ZIP whose members are stored, not deflated: ``archive/data.warc.gz``
with one gzip member per record, and ``indexes/index.cdxj``, a line of JSON per
record with its offset and length inside the first member.  Because members are
stored, a record's place in the archive file is known from the directory, and
the reader touches only the end of the file, the directory, the index and the
ranges of the records asked for; nothing is extracted.  ZIP64 directories and
sizes are read always and written where a field needs them (or on request).

Archives are written through Spark's text writer, one row per file, so they
reach any store that Spark writes to; the newline that it adds is the archive's
one-byte comment.  Ranges are read with pyarrow's file systems; a path of another
kind of store is read through Spark's binaryFile source, and the same reader
seeks in its bytes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import slices, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES = 16 << 20       # an archive ends with the record that reaches this size
READ_BYTES = 4 << 20           # neighbouring records are fetched in ranges of at most this
BROADCAST_GROUPS = 500_000     # repeated payloads: rows of 40 bytes
SEEKABLE = ("", "file", "hdfs", "s3", "gs", "abfs")
DATE = "2000-01-01T00:00:00Z"  # records of a table have no capture time of their own
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

# Signatures of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATE64 = (
    b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07")
MAX32, MAX16 = 0xFFFFFFFF, 0xFFFF

ReadAt = Callable[[int, int], bytes]     # (offset, length) -> bytes


# -- ZIP ----------------------------------------------------------------------

def zip_stored(members: list[tuple[str, bytes]], force64: bool = False) -> bytes:
    """A ZIP of stored members, without the last byte of its comment."""
    out, directory, at = [], [], 0
    for name, data in members:
        raw, crc, n = name.encode(), zlib.crc32(data), len(data)
        big = force64 or n >= MAX32 or at >= MAX32
        size = MAX32 if big else n
        extra = struct.pack("<HHQQ", 1, 16, n, n) if big else b""
        out += [LOCAL, struct.pack("<HHHHHIIIHH", 45 if big else 20, 0x800, 0, 0, 0x21, crc, size, size,
                                   len(raw), len(extra)), raw, extra, data]
        extra = struct.pack("<HHQQQ", 1, 24, n, n, at) if big else b""
        directory += [CENTRAL, struct.pack("<HHHHHHIIIHHHHHII", 45, 45 if big else 20, 0x800, 0, 0, 0x21, crc,
                                           size, size, len(raw), len(extra), 0, 0, 0, 0,
                                           MAX32 if big else at), raw, extra]
        at += 30 + len(raw) + (20 if big else 0) + n
    central = b"".join(directory)
    count = len(members)
    if force64 or at + len(central) >= MAX32 or count >= MAX16:
        out += [central, END64, struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, len(central), at),
                LOCATE64, struct.pack("<IQI", 0, at + len(central), 1),
                END, struct.pack("<HHHHIIH", 0, 0, MAX16, MAX16, MAX32, MAX32, 1)]
    else:
        out += [central, END, struct.pack("<HHHHIIH", 0, 0, count, count, len(central), at, 1)]
    return b"".join(out)


def zip_members(read_at: ReadAt, size: int) -> dict[str, tuple[int, int]]:
    """name -> (offset of the data, length) of every stored member."""
    tail_at = max(0, size - 22 - MAX16 - 20)
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no end of central directory")
    _, _, _, count, length, start, _ = struct.unpack_from("<HHHHIIH", tail, end + 4)
    if MAX16 in (count,) or MAX32 in (length, start):
        locator = tail.rfind(LOCATE64, 0, end)
        if locator < 0:
            raise ValueError("no ZIP64 locator")
        _, at, _ = struct.unpack_from("<IQI", tail, locator + 4)
        record = read_at(at, 56)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, members = read_at(start, length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        (_, _, _, method, _, _, _, packed, plain, n_name, n_extra, n_comment, _, _, _, local
         ) = struct.unpack_from("<HHHHHHIIIHHHHHII", directory, at + 4)
        name = directory[at + 46:at + 46 + n_name].decode("utf-8", "replace")
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        plain, packed, local = _sizes64(extra, plain, packed, local)
        if method == 0:
            head = read_at(local, 30)
            if head[:4] != LOCAL:
                raise ValueError(f"no local header for {name}")
            skip = sum(struct.unpack_from("<HH", head, 26))
            members[name] = (local + 30 + skip, packed)
        at += 46 + n_name + n_extra + n_comment
    return members


def _sizes64(extra: bytes, *fields: int) -> list[int]:
    """Fields that are all ones come from the ZIP64 extra field, in order."""
    at, values = 0, list(fields)
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            values = [next(wide) if v == MAX32 else v for v in values]
        at += 4 + n
    return values


# -- WARC ---------------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    name = urn.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def _safe(url: str) -> str:
    """A URL as a header value: control characters and spaces are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def warc_record(page_id, url, payload: bytes, digest: str, response: int | None, revisit: bool) -> bytes:
    """A response record, or a revisit record without the payload; the HTTP
    headers of both give the payload's full length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_safe(url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(response)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = _headers(head)
    block = rest[:int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, _headers(http), payload


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


# -- Spark --------------------------------------------------------------------

def planned(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): of equal payloads the largest
    page_id is the response and the others refer to it; a null id is smaller than
    all others, and rows that repeat the largest id are all responses."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    groups = stored(rows.groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
                    .filter("n > 1").select(F.col("sha1").alias("__sha1"), "last"), "warc-repeats")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return (rows.join(groups, F.col("sha1") == F.col("__sha1"), "left")
            .select("page_id", "url", "payload", "sha1", refers.alias("refers_to")))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html).

    A null html is an empty payload.  A task cuts its rows into archives of about
    ``archive_bytes``; a longer record has an archive of its own."""
    def run(batches):
        data, index, at = [], [], 0

        def archive() -> pa.RecordBatch:
            members = [(DATA, b"".join(data)), (INDEX, "".join(index).encode())]
            return pa.RecordBatch.from_arrays([pa.array([zip_stored(members)], pa.binary())], ["data"])

        for batch in batches:
            for b in slices(batch, "payload"):
                for page_id, url, payload, sha1, refers in zip(*[c.to_pylist() for c in b.columns], strict=True):
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    record = gzip.compress(warc_record(page_id, url, payload, digest, refers,
                                                       refers is not None), 4, mtime=0)
                    index.append(json.dumps({"id": page_id, "offset": at, "length": len(record)}) + "\n")
                    data.append(record)
                    at += len(record)
                    if at >= archive_bytes:
                        yield archive()
                        data, index, at = [], [], 0
        if data:
            yield archive()

    files = planned(pages).mapInArrow(run, "data binary")
    files.select(F.col("data").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def records_of(read_at: ReadAt, size: int, wanted=None) -> Iterator[tuple[dict, dict, bytes]]:
    """Parsed records of an archive, or of those ids that ``wanted`` accepts; each
    range read covers neighbouring records of at most READ_BYTES."""
    members = zip_members(read_at, size)
    start, _ = members[DATA]
    lines = read_at(*members[INDEX]).decode().splitlines()
    entries = [e for e in map(json.loads, lines) if wanted is None or wanted(e["id"])]
    at = 0
    while at < len(entries):
        first, to = entries[at]["offset"], at + 1
        end = first + entries[at]["length"]
        while to < len(entries) and entries[to]["offset"] == end and end - first < READ_BYTES:
            end += entries[to]["length"]
            to += 1
        data = read_at(start + first, end - first)
        for e in entries[at:to]:
            begin = e["offset"] - first
            yield parse_record(gzip.decompress(data[begin:begin + e["length"]]))
        at = to


def _rows(records: Iterator[tuple[dict, dict, bytes]]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    rows, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for warc, http, payload in records:
        revisit = warc["warc-type"] == "revisit"
        digest = warc["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {warc['warc-record-id']} does not have its digest")
        rows.append((page_of(warc["warc-record-id"]), warc.get("warc-target-uri"), int(http["content-length"]),
                     digest, warc["warc-type"], page_of(warc["warc-refers-to"]) if revisit else None,
                     None if revisit else payload))
        held += len(payload)
        if held >= 16 << 20 or len(rows) >= 4096:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    payload) of every record below ``path``; a revisit's payload is null.
    Payloads are checked against their digests."""
    schema = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, "
              "record_type string, refers_to bigint, payload binary")
    files = spark.read.format("binaryFile").load(path)
    if path.partition("://")[0] in SEEKABLE or path.startswith("file:") or "://" not in path:
        def seek(batches):
            for batch in batches:
                for uri, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    store, name = fs.FileSystem.from_uri(
                        "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)
                    with store.open_input_file(name) as f:
                        yield from _rows(records_of(lambda at, n, f=f: f.read_at(n, at), size))
        return files.select("path", "length").mapInArrow(seek, schema)    # the scan deals files by their bytes

    def whole(batches):
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                yield from _rows(records_of(lambda at, n, d=data: d[at:at + n], len(data)))
    return files.select("content").mapInArrow(whole, schema)
