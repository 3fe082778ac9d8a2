"""Fill-in-the-middle by content-defined chunk memoization.

A rolling hash over the bytes cuts each text into chunks: a chunk ends where
the hash of its last WINDOW bytes has MASK_BITS zero bits, so texts that share a
passage share its chunks wherever it stands.  What the document cuts need to
know about a chunk is its boundary summary: how many words start in it, whether
it begins and ends inside a word, and how many code points it has.  Summaries
are remembered by the chunk's whole bytes, so a hit is verified by content, not
by a hash.  Summaries combine from left to right: a word that runs over the end
of a chunk was already counted where it started.  The running counts give the
number of units of the text and name the chunk that holds a cut; only that chunk
is read for the cut itself.

A unit is white space followed by a word; white space at the very end of the
text is a unit of its own.  Words and white space are those of the six ASCII
white-space characters, which UTF-8 never uses inside other characters.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import by_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
FIM_PERCENT = 50            # of the documents are transformed,
SPM_PERCENT = 80            # and of these have the suffix first
WINDOW = 32                 # bytes under the rolling hash, and the least length of a chunk
MASK_BITS = 8               # a chunk has some 2 ** MASK_BITS bytes
LONGEST = 8192              # bytes; a passage without an end is cut there
MEMO_BYTES = 48 << 20       # bytes of remembered chunks per task
SLICE_BYTES = 1 << 20       # bytes of texts that are treated at once, and hashed at once of a longer text

SPACES = b" \t\n\r\x0b\x0c"
SPACE = re.compile(rb"[\x20\x09-\x0D]")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

Summary = tuple[int, bool, bool, int]      # words begun, begins in a word, ends in a word, code points


class Chunker:
    """Ends of the content-defined chunks of many texts in one buffer."""

    def __init__(self, seed: int = 1):
        self.gear = np.random.default_rng(seed).integers(0, 1 << 32, 256, dtype=np.uint32)

    def ends(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sorted ends of all chunks; ``starts`` are the texts' offsets and the last one's end."""
        hit = np.concatenate([self._hits(data, a, a + SLICE_BYTES) for a in range(0, len(data), SLICE_BYTES)])
        begin = starts[np.searchsorted(starts, hit, "left") - 1]
        hit = hit[(hit - begin >= WINDOW) & (hit < len(data))]     # the window lies inside the text
        hit = hit[data[hit] & 0xC0 != 0x80]                        # the next byte begins a character
        ends = np.union1d(hit, starts[1:])
        ends = ends[ends > starts[0]]
        long = np.flatnonzero(np.diff(ends, prepend=starts[0]) > LONGEST)
        more = [self._cut(data, int(ends[i - 1]) if i else int(starts[0]), int(ends[i])) for i in long]
        return np.union1d(ends, np.concatenate(more)) if more else ends

    def _hits(self, data: np.ndarray, start: int, end: int) -> np.ndarray:
        """Positions after the bytes from ``start`` to ``end`` whose hash has the zero bits.  The
        hash is that of the last WINDOW bytes, so a block needs no more of what comes before."""
        first = max(start - WINDOW + 1, 0)
        h = self.gear[data[first:end]]
        width = 1
        while width < WINDOW:       # the hash of 2 w bytes from those of w bytes
            older = h[:-width] << np.uint32(width)
            h[width:] += older
            width *= 2
        return np.flatnonzero(h[start - first:] >> np.uint32(32 - MASK_BITS) == 0) + start + 1

    @staticmethod
    def _cut(data: np.ndarray, start: int, end: int) -> np.ndarray:
        out = []
        while end - start > LONGEST:
            start += LONGEST
            while data[start] & 0xC0 == 0x80:
                start -= 1
            out.append(start)
        return np.array(out, np.int64)


def summarize(chunk: bytes) -> Summary:
    inner = len(chunk) if chunk.isascii() else len(chunk.decode())
    first, last = chunk[0] not in SPACES, chunk[-1] not in SPACES
    return len(chunk.split()), first, last, inner


class Memo:
    """Boundary summaries by the chunk's bytes, in a bounded space."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.size, self.known = limit, 0, {}
        self.hits = 0

    def of(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = summarize(chunk)
        if self.size + len(chunk) + 200 > self.limit:      # 200: a rough cost of the entry itself
            self.known.clear()
            self.size = 0
        self.known[chunk] = found
        self.size += len(chunk) + 200
        return found


class Text:
    """A text with the combined counts of its chunks."""

    def __init__(self, data: bytes, ends: list[int], memo: Memo):
        self.data, self.ends = data, ends
        self.words, self.chars = [], []      # begun up to each chunk's end; code points up to there
        self.inside = []                     # whether the chunk continues a word
        words = chars = 0
        open_word, at = False, 0
        for end in ends:
            n, first, last, points = memo.of(data[at:end])
            self.inside.append(open_word and first)
            words += n - (open_word and first)
            chars += points
            self.words.append(words)
            self.chars.append(chars)
            open_word, at = last, end
        self.n = words + (bool(data) and not open_word)      # white space at the end is a unit

    def after(self, units: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the first ``units`` units."""
        if units == 0:
            return 0, 0
        if units == self.n:
            return len(self.data), self.chars[-1]
        chunk = int(np.searchsorted(self.words, units, "left"))      # the word begins in this chunk
        start = self.ends[chunk - 1] if chunk else 0
        before = self.words[chunk - 1] if chunk else 0
        words = WORD.finditer(self.data, start, self.ends[chunk])
        if self.inside[chunk]:
            next(words)
        for _ in range(units - before):
            word = next(words)
        end = word.end()
        if end == self.ends[chunk]:          # it may go on in the next chunks
            space = SPACE.search(self.data, end)
            end = space.start() if space else len(self.data)
            chunk = int(np.searchsorted(self.ends, end, "left"))
            start = self.ends[chunk - 1] if chunk else 0
        points = (self.chars[chunk - 1] if chunk else 0) + len(self.data[start:end].decode())
        return end, points


def draws(key: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four whole numbers from the hash of the seed and the key; a null key has no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) for every row of ``docs``.

    Null and empty texts are plain, with no units and an empty output; a text
    that holds one of the three marks is plain.  Rows that repeat a key draw the
    same numbers; a null key draws from the seed alone.  Texts of any length are
    treated whole, a chunk at a time.
    """
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        chunker, memo = Chunker(), Memo()

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            starts = np.cumsum([0, *map(len, texts)], dtype=np.int64)
            buffer = np.frombuffer(b"".join(texts), np.uint8)
            ends = chunker.ends(buffer, starts) if len(buffer) else np.zeros(0, np.int64)
            cut = np.searchsorted(ends, starts, "right")
            out = []
            for i, (k, data) in enumerate(zip(b.column(0).to_pylist(), texts, strict=True)):
                doc = Text(data, (ends[cut[i]:cut[i + 1]] - starts[i]).tolist(), memo)
                h1, h2, h3, h4 = draws(k, seed)
                if not data or h3 % 100 >= fim_percent or any(m in data for m in marks):
                    out.append((doc.n, "plain", None, None, data))
                    continue
                one, two = sorted((h1 % (doc.n + 1), h2 % (doc.n + 1)))
                (a, a_chars), (z, z_chars) = doc.after(one), doc.after(two)
                p, m, s = data[:a], data[a:z], data[z:]
                if h4 % 100 < spm_percent:
                    form, whole = "spm", b"".join([marks[1], s, marks[0], p, marks[2], m])
                else:
                    form, whole = "psm", b"".join([marks[0], p, marks[1], s, marks[2], m])
                out.append((doc.n, form, a_chars, z_chars - a_chars, whole))
            n, form, prefix, middle, output = zip(*out, strict=True) if out else [()] * 5
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                ["key", "n", "form", "prefix_chars", "middle_chars", "output"])
        yield from by_slices(one, max_bytes=SLICE_BYTES)(batches)

    schema = "key bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output of ``transform`` was made from.

    A transformed text holds no mark of its own, so the three marks part it."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    # the one split in an array, so that it is made once a row, not once a part, and for no plain text
    split = F.array(F.split(out, "|".join((PREFIX, SUFFIX, MIDDLE)), -1))
    order = lambda p, *at: F.concat(*(F.get(p, F.lit(i)) for i in at))
    joined = F.transform(split, lambda p: F.when(form == "psm", order(p, 1, 3, 2)).otherwise(order(p, 2, 3, 1)))
    return F.when(form.isin("psm", "spm"), joined[0]).otherwise(out)
