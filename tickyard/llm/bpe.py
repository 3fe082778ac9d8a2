"""BPE encoding and decoding by tree concatenation.

Long unsplit text is cut into halves, again and again, down to pieces that
are encoded in parallel; neighbouring pieces are then joined by encoding a
window of tokens around the cut anew and growing it until its first tokens
equal the left side's and its last tokens equal the right side's.

Why agreement is exact: a token sequence is the BPE encoding of its text as
soon as each adjacent pair of tokens is the encoding of its own text.  Left
of the window all pairs come from the left encoding, inside from the window's
and right of it from the right one; the agreeing tokens carry each seam.  The
same holds for the pre-split: from a common boundary on, two scans of the
same text find the same boundaries.

Two kinds of cut use this.  Documents over ``leaf`` characters are cut into
rows that Spark spreads over the cluster, whatever their content; inside a
task, a run without white space longer than ``RUN`` is halved as well.  Text
between white space is looked up in a bounded memo, since words repeat; the
memo lives as long as the Python worker, so later tasks find what earlier ones met.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .common import by_slices, int_lists

LEAF = 16_384        # characters; longer documents are encoded as several rows
RUN = 2_048          # characters; longer runs without white space are halved in the task
MEMO = 400_000       # remembered words per Python worker
SLICE = 32 << 20     # bytes of text whose distinct words are encoded at once
PART = 8 << 20       # the same for rows of encode, beside the stored words of a worker
AGREE = 4            # tokens that must agree on either side of a join
WINDOW = 16          # tokens of the first window on either side
AT_ONCE = 4_096      # words of the pre-split in one call of the library

# Unicode White_Space, as the pre-split understands it.
SPACE = "\t-\r \x85\xa0  -     　"
PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+?(?= [^{SPACE}])|[{SPACE}]")
ODD_SPACE = f" (?:[{SPACE}]|$)|^[{SPACE}]"

# Signs whose class no Unicode version moves; texts with others go to the library.
MOVING = re.compile("[^\x00-\x1b -\u024f]")

# Fixed value: the published pre-split pattern of byte-level BPE.
PRESPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_chars() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes for the characters from 256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Bpe:
    """A byte-level BPE tokenizer of the tokenizers library, for whole texts."""

    def __init__(self, path: str, run: int = RUN, memo: int = MEMO):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.run, self.memo_size, self.words = run, memo, {}
        self.model = self.tok.model
        added = self.tok.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take in neighbouring text are not supported")
        self.special = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        self.find_special = re.compile(
            "(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        alphabet = byte_chars()
        self.char_of = {b: c for c, b in alphabet.items()}
        self.space = self.char_of[ord(" ")]
        self.raw: list[bytes] = [b""] * self.tok.get_vocab_size(with_added_tokens=True)
        for token, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.raw[i] = bytes(alphabet[c] for c in token)
        for i, t in added.items():
            self.raw[i] = t.content.encode()
        # the merge model alone, for many words of the pre-split in one call; 0xFF is in no UTF-8
        self.merges = Tokenizer(self.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.lined = {**self.char_of, 0xFF: "\n"}
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)

    # -- encoding -------------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text, as the library's encode gives them."""
        return np.frombuffer(self._bytes(text), "<u4")

    def _bytes(self, text: str) -> bytes:
        if self.find_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(self.special.get(part) or self._plain(part)
                        for part in self.find_special.split(text) if part)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of all texts; each distinct word of the batch is encoded once.

        A space before a sign other than white space starts a new word of the
        pre-split, so texts in which each space is one are cut there."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        odd = odd.to_numpy(zero_copy_only=False)
        even = texts.filter(pa.array(~odd))
        cut = pc.split_pattern(even, " ")
        starts = cut.offsets.to_numpy()[:-1]
        words = cut.flatten().dictionary_encode()
        which = words.indices.to_numpy().astype(np.int64)
        first = words.dictionary.take(pa.array(which[starts])).to_pylist()
        distinct = words.dictionary.to_pylist()
        known = _concat(self._all_spaced(distinct), _table([self._plain(w) for w in first]))
        which[starts] = len(distinct) + np.arange(len(first))
        ids, ends = _gather(*known, which, np.append(starts, len(which)))
        if not odd.any():
            return ends, ids
        rows = np.split(ids, ends[1:-1]) if len(ends) > 1 else []
        even_rows, all_rows = iter(rows), []
        for text, is_odd in zip(texts.to_pylist(), odd, strict=True):
            all_rows.append(self.encode(text) if is_odd else next(even_rows))
        return np.cumsum([0, *map(len, all_rows)], dtype=np.int64), np.concatenate(all_rows)

    def _plain(self, text: str) -> bytes:
        words = self.words
        return b"".join([words.get(p) or self._piece(p) for p in PIECES.findall(text)])

    def _all_spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number per word) of a space and each of ``words``, which hold
        no space and do not start with white space.

        In the words' concatenation each space starts a word of the pre-split, so
        one scan splits them all, and each distinct piece is encoded once."""
        apart = [not w or len(w) >= self.run or MOVING.search(w) is not None for w in words]
        pieces = PRESPLIT.findall("".join([" " + w for w, a in zip(words, apart, strict=True) if not a]))
        index: dict[str, int] = {}
        which = np.array([index.setdefault(p, len(index)) for p in pieces], np.int64)
        begins = np.flatnonzero([p[0] == " " for p in pieces])
        ids, ends = _gather(*_table(self._all_words(list(index))), which, np.append(begins, len(pieces)))
        if not any(apart):
            return ids, np.diff(ends)
        joined = iter(np.split(ids, ends[1:-1]) if len(ends) > 1 else [])
        rows = [(np.frombuffer(self._spaced(w), "<u4") if w else np.zeros(0, "<u4")) if a else next(joined)
                for w, a in zip(words, apart, strict=True)]
        return np.concatenate(rows), np.array([len(r) for r in rows], np.int64)

    def _all_words(self, pieces: list[str]) -> list[bytes]:
        """``_word`` of distinct words of the pre-split; the unknown ones go to the
        library's merge model together and are told apart by their bytes."""
        words = self.words
        new = [p for p in pieces if p not in words]
        found: dict[str, bytes] = {}
        for i in range(0, len(new), AT_ONCE):
            some = new[i:i + AT_ONCE]
            lines = "\udcff".join(some).encode("utf-8", "surrogateescape").decode("latin-1").translate(self.lined)
            ids = np.array(self.merges.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4")
            size = np.cumsum([len(p.encode()) for p in some])
            covered = np.cumsum(self.raw_size[ids])
            ends = np.searchsorted(covered, size) + 1
            if ends[-1] != len(ids) or not np.array_equal(covered[ends - 1], size):
                continue                                      # a vocabulary without all bytes: one by one
            data = ids.tobytes()
            cuts = [0, *(4 * ends).tolist()]
            found.update(zip(some, [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        out = [words.get(p) or found.get(p) or self._word(p) for p in pieces]
        for p in found:
            if len(words) >= self.memo_size:
                break
            if len(p) <= 64:
                words[p] = found[p]
        return out

    def _spaced(self, word: str) -> bytes:
        """A space and text without one; plain words with a comma or a full stop
        are looked up as two."""
        if word.isascii() and len(word) <= 64:
            if word.isalpha():
                return self._word(" " + word)
            if word[-1:] in (",", ".") and word[:-1].isalpha():
                stem = " " + word[:-1]
                return (self.words.get(stem) or self._word(stem)) + (self.words.get(word[-1]) or self._word(word[-1]))
        return self._piece(" " + word) if len(word) < self.run else self._plain(" " + word)

    def _piece(self, piece: str) -> bytes:
        """Text that starts and ends at a boundary of the pre-split."""
        if len(piece) > self.run:
            return self._halves(piece).astype("<u4", copy=False).tobytes()
        if MOVING.search(piece):
            return self._library(piece).astype("<u4", copy=False).tobytes()
        words = self.words
        return b"".join([words.get(w) or self._word(w) for w in PRESPLIT.findall(piece)])

    def _word(self, word: str) -> bytes:
        """One word of the pre-split, by the library's own merge model."""
        if word.isascii() and word[1:].isalpha() and word[0] == " ":
            tokens = self.model.tokenize(self.space + word[1:])      # letters stand for themselves
        else:
            tokens = self.model.tokenize(word.encode().decode("latin-1").translate(self.char_of))
        out = pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(self.words) < self.memo_size and len(word) <= 64:
            self.words[word] = out
        return out

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")

    def _halves(self, piece: str) -> np.ndarray:
        if len(piece) <= self.run:
            return self._library(piece)
        half = len(piece) // 2
        return self.join(self._halves(piece[:half]), self._halves(piece[half:]), self._library)

    def join(self, left: np.ndarray, right: np.ndarray, encode=None) -> np.ndarray:
        """The encoding of the concatenated text from both encodings."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        encode, width = encode or self.encode, WINDOW
        while True:
            a, b = self._char_start(left, len(left) - width), self._char_end(right, width)
            window = encode(self.decode(np.concatenate([left[a:], right[:b]])))
            head = _agree(window, left[a:])
            tail = _agree(window[::-1], right[:b][::-1])
            if ((a == 0 or head >= AGREE) and (b == len(right) or tail >= AGREE)
                    and (a == 0 or b == len(right) or head + tail <= len(window))):
                return np.concatenate([left[:a], window, right[b:]])
            width *= 2

    def _char_start(self, ids: np.ndarray, at: int) -> int:
        """The last index up to ``at`` where a token starts with a whole character."""
        at = max(at, 0)
        while at > 0 and self.raw[ids[at]][0] & 0xC0 == 0x80:
            at -= 1
        return at

    def _char_end(self, ids: np.ndarray, at: int) -> int:
        at = min(at, len(ids))
        while at < len(ids) and self.raw[ids[at]][0] & 0xC0 == 0x80:
            at += 1
        return at

    def concat(self, parts: list[np.ndarray]) -> np.ndarray:
        """Join encoded neighbours pairwise, level by level."""
        parts = list(parts)
        while len(parts) > 1:
            pairs = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
            parts = pairs + parts[len(parts) // 2 * 2:]
        return parts[0] if parts else np.zeros(0, "<u4")

    # -- decoding -------------------------------------------------------------

    def decode(self, ids: Iterable[int]) -> str:
        """Text of token ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        raw = self.raw
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")


def held(path: str) -> Bpe:
    """The worker's tokenizer of a file: its tasks share one, with the words they have met."""
    st = os.stat(path)
    return _held(path, st.st_mtime_ns, st.st_size)


@lru_cache(maxsize=1)
def _held(path: str, mtime_ns: int, size: int) -> Bpe:
    return Bpe(path)


def _table(known: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and their number per entry."""
    return np.frombuffer(b"".join(known), "<u4"), np.array([len(k) // 4 for k in known], np.int64)


def _concat(*tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ids, sizes = zip(*tables, strict=True)
    return np.concatenate(ids), np.concatenate(sizes)


def _gather(table: np.ndarray, size: np.ndarray, which: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words ``which`` in a row, and the offsets of the texts
    that begin at the words ``starts``."""
    begin, n = np.cumsum(size) - size, size[which]
    end = np.cumsum(n)
    at = np.repeat(begin[which] - (end - n), n) + np.arange(end[-1] if len(end) else 0)
    return table[at], np.append(0, end)[starts]


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    n = min(len(x), len(y))
    same = x[:n] == y[:n]
    return n if same.all() else int(np.argmin(same))


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
           leaf: int = LEAF) -> DataFrame:
    """(key, ids array<int>) for every row of ``docs``; other columns are not read.

    A null or empty text has no ids.  Null and repeated keys are ordinary rows:
    pieces of a long text find each other by an id of the row, not by the key.
    Short texts are encoded where they are read; texts over ``leaf`` characters
    become rows of their own that are spread over the cluster and joined again.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return (_encode_short(rows.filter(F.length("text") <= leaf), tokenizer, kind)
            .unionByName(_encode_long(rows.filter(F.length("text") > leaf), tokenizer, kind, leaf))
            .withColumnRenamed("key", key))


def _encode_short(rows: DataFrame, tokenizer: str, kind: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(tokenizer)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([b.column(0), int_lists(*bpe.encode_all(b.column(1)))],
                                              ["key", "ids"])
        yield from by_slices(one, max_bytes=PART, encodes=True)(batches)
    return rows.mapInArrow(run, f"key {kind}, ids array<int>")


def _encode_long(rows: DataFrame, tokenizer: str, kind: str, leaf: int) -> DataFrame:
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                t = batch.column(2)[i].as_py()
                n = -(-len(t) // leaf)
                at = [len(t) * k // n for k in range(n + 1)]
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([one.column(0)] * n), pa.concat_arrays([one.column(1)] * n),
                     pa.array(range(n), pa.int32()),
                     pa.array([t[a:b] for a, b in zip(at, at[1:], strict=False)])],
                    ["row", "key", "part", "text"])

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(tokenizer)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            ends, flat = bpe.encode_all(b.column(3))
            ids = [flat[s:e].tobytes() for s, e in zip(ends, ends[1:], strict=False)]
            return pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(ids, pa.binary())],
                                              ["row", "key", "part", "ids"])
        yield from by_slices(one, encodes=True)(batches)

    def together(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by("part").combine_chunks()
        ids = held(tokenizer).concat([np.frombuffer(x, "<u4") for x in pieces["ids"].to_pylist()])
        return pa.table([pieces["key"].slice(0, 1), int_lists(np.array([0, len(ids)]), ids)], ["key", "ids"])

    parts = (rows.select(F.monotonically_increasing_id().alias("row"), "key", "text")
             .mapInArrow(cut, f"row bigint, key {kind}, part int, text string")
             .repartition("row", "part")
             .mapInArrow(pieces, f"row bigint, key {kind}, part int, ids binary"))
    return parts.groupBy("row").applyInArrow(together, f"key {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids",
           out: str = "decoded") -> DataFrame:
    """``key``, ``ids`` and the decoded text; null ids decode to the empty text."""
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                col = b.column(1)
                flat, ends = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
                texts = [bpe.decode(flat[s:e]) for s, e in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                                 ["key", "ids", "decoded"])
    return (rows.mapInArrow(run, f"key {kind}, ids array<int>, decoded string")
            .withColumnsRenamed({"key": key, "ids": ids, "decoded": out}))
