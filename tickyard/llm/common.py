"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import fresh_dir

#: The word pattern of the contracts: runs without the six ASCII white-space characters.
WORD_SPLIT = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: For str.translate: A-Z only, other letters keep their case.
ASCII_LOWER = str.maketrans(UPPER, LOWER)

QueryFn = Callable[[SparkSession, str], DataFrame]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def key_of(c: str) -> Column:
    """A string key that keeps null apart from every value."""
    return F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, and a lost executor costs a re-read instead of a recomputation."""
    path = fresh_dir(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_text(docs: DataFrame, keep: tuple[str, ...], text: str) -> tuple[DataFrame, list[str], str]:
    """Rows for a mapInArrow function: the columns ``keep`` as k0, k1 and so on and
    the text; their names, and where ``column_of`` finds the text.  A field of a
    kept struct, like ``row.text``, goes to Python once, inside its struct."""
    names = [f"k{i}" for i in range(len(keep))]
    rows = [F.col(k).alias(n) for k, n in zip(keep, names, strict=True)]
    column, _, field = text.partition(".")
    if field and column in keep:
        return docs.select(*rows), names, f"{names[keep.index(column)]}.{field}"
    return docs.select(*rows, F.col(text).alias("text")), names, "text"


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column of the batch; ``row.text`` is the field of a struct column."""
    column, *fields = name.split(".")
    col = batch.column(batch.schema.get_field_index(column))
    for field in fields:
        col = col.field(field)
    return col


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice holds more than ``max_bytes`` of ``text``
    (one text longer than that is a slice of its own)."""
    col = column_of(batch, text)
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(size):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if batch.num_rows > start:
        yield batch.slice(start)


def let_go() -> None:
    """Free the encoder that earlier tasks left in this Python worker, if any, and
    give its pages back to the system where the C library can.  It is looked up
    among the loaded modules, since functions come here by value."""
    bpe = sys.modules.get("tickyard.llm.bpe")
    if bpe is not None and bpe._held.cache_info().currsize:
        bpe._held.cache_clear()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def by_slices(fn: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text",
              max_bytes: int = 4 << 20, encodes: bool = False):
    """A mapInArrow function that applies ``fn`` to bounded slices.  Freed Arrow
    buffers go back to the system after each batch, not at the worker's end; what
    the encoder remembered goes when a task starts that does not encode."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encodes:
            let_go()
        for batch in batches:
            for part in slices(batch, text, max_bytes):
                yield fn(part)
                part = None
            batch = None
            pa.default_memory_pool().release_unused()
    return run


def raw(texts: pa.StringArray) -> list[bytes | None]:
    """The texts' bytes in UTF-8, without decoding them."""
    return texts.cast(pa.binary()).to_pylist()


def int_lists(offsets: np.ndarray, flat: np.ndarray, dtype=np.int32) -> pa.ListArray:
    """A list column over one flat buffer."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                    pa.array(flat.astype(dtype, copy=False)))
