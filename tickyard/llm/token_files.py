"""Token-id files: patched frame-of-reference blocks with an index.

A file holds the ids of consecutive documents.  Ids are cut into blocks of
BLOCK values.  A block stores its minimum, the values less the minimum in
``width`` bits each, where ``width`` is what the PERCENTILE-th percentile needs,
and for larger values the position and the upper bits in an exception list.
The footer has the byte offset of every block, so that any range of ids is read
by decoding only the blocks that it touches, and each document's id and end.

    magic "PFOR0001"
    block*    <u4 minimum, <u2 values, <u2 exceptions, u1 width>, packed bits,
              <u2 position>*, <u4 upper bits>*
    footer    <u8 block offset>*, <i8 doc_id>*, <u1 has an id>*, <u8 end>*
    trailer   <u8 footer offset, u4 blocks, u4 documents, i8 part, i8 number>
    "\\n"

The last byte is the record separator of Spark's text writer, through which the
files are written, so they reach any store that Spark writes to, with its
commit protocol; part and number give the order of the files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import SLICE, held
from .common import slices, stored

MAGIC = b"PFOR0001"
BLOCK = 4096
PERCENTILE = 95
FILE_IDS = 8_000_000      # a file ends with the document that reaches this many ids
HEAD, TRAILER = "<IHHB", "<QIIqq"     # struct formats


def pack_block(values: np.ndarray) -> bytes:
    low = int(values.min())
    rest = (values - np.uint32(low)).astype("<u4")
    at = min(len(rest) - 1, len(rest) * PERCENTILE // 100)
    width = int(np.partition(rest, at)[at]).bit_length()
    odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, int)
    kept = rest.astype("<u2") if width <= 16 else rest     # the low bits are all that is packed
    bits = np.unpackbits(kept.view(np.uint8).reshape(len(kept), -1), axis=1, bitorder="little")[:, :width]
    return b"".join([struct.pack(HEAD, low, len(rest), len(odd), width),
                     np.packbits(bits, bitorder="little").tobytes(),
                     odd.astype("<u2").tobytes(), (rest[odd] >> np.uint32(min(width, 31))).tobytes()])


def unpack_block(data: bytes | memoryview, at: int = 0) -> np.ndarray:
    low, n, n_odd, width = struct.unpack_from(HEAD, data, at)
    at += struct.calcsize(HEAD)
    size = (n * width + 7) // 8
    wide = 16 if width <= 16 else 32
    bits = np.zeros((n, wide), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), bitorder="little",
                                    count=n * width).reshape(n, width)
    rest = np.packbits(bits, axis=1, bitorder="little").view(f"<u{wide // 8}")[:, 0].astype("<u4")
    at += size
    odd = np.frombuffer(data, "<u2", n_odd, at)
    rest[odd] |= np.frombuffer(data, "<u4", n_odd, at + 2 * n_odd) << np.uint32(width)
    return rest + np.uint32(low)


def pack_file(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, part: int, number: int) -> bytes:
    """The whole file but for its last byte, which the writer adds."""
    out, at, starts = [MAGIC], len(MAGIC), []
    for i in range(0, len(ids), BLOCK):
        block = pack_block(ids[i:i + BLOCK])
        starts.append(at)
        at += len(block)
        out.append(block)
    out += [np.array(starts, "<u8").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is not None for d in doc_ids], np.uint8).tobytes(), ends.astype("<u8").tobytes(),
            struct.pack(TRAILER, at, len(starts), len(doc_ids), part, number)]
    return b"".join(out)


class TokenFile:
    """Reads a file's bytes; ``ids`` decodes only the blocks of the range."""

    def __init__(self, data: bytes):
        if data[:len(MAGIC)] != MAGIC or data[-1:] != b"\n":
            raise ValueError("not a token file, or not a whole one")
        self.data = data
        footer, blocks, docs, self.part, self.number = struct.unpack_from(
            TRAILER, data, len(data) - 1 - struct.calcsize(TRAILER))
        self.starts = np.frombuffer(data, "<u8", blocks, footer)
        footer += 8 * blocks
        ids, has = (np.frombuffer(data, "<i8", docs, footer),
                    np.frombuffer(data, np.uint8, docs, footer + 8 * docs))
        self.doc_ids = [int(i) if h else None for i, h in zip(ids, has, strict=True)]
        self.ends = np.frombuffer(data, "<u8", docs, footer + 9 * docs).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = start // BLOCK
        got = [unpack_block(self.data, int(self.starts[b])) for b in range(first, (stop - 1) // BLOCK + 1)]
        return np.concatenate(got)[start - first * BLOCK:stop - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in this file, ids), decoding each block once."""
        all_ids = self.ids(0, int(self.ends[-1])) if len(self.ends) else np.zeros(0, np.uint32)
        start = 0
        for doc, end in zip(self.doc_ids, self.ends.tolist(), strict=True):
            yield doc, start, all_ids[start:end]
            start = end


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id",
                 text: str = "text", file_ids: int = FILE_IDS) -> None:
    """Encode every text, append ``end_id`` and write the files in ascending key order.

    Null and empty texts are documents of the end id alone; a null key comes
    first; rows that repeat a key follow each other, ordered by their texts.
    """
    rows = (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id()))
    ordered = rows.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")

    def run(batches):
        bpe, part, number = held(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, ends, chunks, total = [], [], [], 0

        def file() -> pa.RecordBatch:
            data = pack_file(doc_ids, np.concatenate(ends), np.concatenate(chunks), part, number)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        for batch in batches:
            for b in slices(batch, "text", SLICE):
                offsets, flat = bpe.encode_all(b.column(1))
                offsets = offsets + np.arange(len(offsets))     # with one end id for each document
                ids = np.insert(flat, offsets[1:] - np.arange(1, len(offsets)), end_id)
                new, at = b.column(0).to_pylist(), 0
                while at < len(new):                            # documents that fit the open file
                    fit = max(1, int(np.searchsorted(offsets, offsets[at] + file_ids - total, "right")) - 1 - at)
                    to = min(len(new), at + fit)
                    doc_ids += new[at:to]
                    ends.append(offsets[at + 1:to + 1] - offsets[at] + total)
                    chunks.append(ids[offsets[at]:offsets[to]])
                    total, at = int(ends[-1][-1]), to
                    if total >= file_ids or at < len(new):
                        yield file()
                        doc_ids, ends, chunks, total, number = [], [], [], 0, number + 1
        if doc_ids:
            yield file()

    files = ordered.select("doc_id", "text").mapInArrow(run, "data binary")
    files.select(F.col("data").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, number, local_start, n_tokens, ids_crc32) from the files at ``path``."""
    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                f, rows = TokenFile(data.as_py()), []
                for doc, start, ids in f.documents():
                    rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array([f.part] * n, pa.int64()),
                     pa.array([f.number] * n, pa.int64()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                    ["doc_id", "part", "number", "local_start", "n_tokens", "ids_crc32"])
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "doc_id bigint, part bigint, number bigint, local_start bigint, "
                                 "n_tokens bigint, ids_crc32 bigint")


def with_starts(read: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): starts over all files in their order.
    The running sum is over one row per file."""
    read = stored(read, "token-documents")
    files = read.groupBy("part", "number").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", "number", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return read.join(bases, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
