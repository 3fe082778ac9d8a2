"""Token counts by the whole-token shortcut.

Most words of ordinary text are a token of the vocabulary.  ``whole_tokens``
proves once, before the job starts, which vocabulary strings the merge rules
turn into that one token when they stand alone: each is merged by the library's
own model, and only those that come out as their own id are kept (a string may
well be in the vocabulary and still be merged into other tokens).  Byte-level
BPE merges inside a word of the pre-split only, so a word that is in the proven
set counts as one token wherever it stands.  Only the other words are merged.

Texts are cut at single spaces into words that are counted once for each batch
they occur in; what the pre-split does across other white space, special
strings and characters whose class moves between Unicode versions is left to
the pre-split pattern, the special strings' table or the library itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .bpe import MOVING, ODD_SPACE, PIECES, PRESPLIT, RUN, SLICE, Bpe, byte_chars
from .common import by_slices

LIMIT = 1024
MEMO = 400_000              # remembered words per task that are not whole tokens


def whole_tokens(path: str) -> frozenset[str]:
    """The strings that stand for exactly one token, proven by merging each."""
    tok = Tokenizer.from_file(path)
    alphabet = byte_chars()
    proven = set()
    for token, i in tok.get_vocab(with_added_tokens=False).items():
        got = tok.model.tokenize(token)
        if len(got) == 1 and got[0].id == i:
            try:
                proven.add(bytes(alphabet[c] for c in token).decode())
            except UnicodeDecodeError:
                pass                         # a part of a character, which is no text
    return frozenset(proven)


class Counter:
    """Counts the tokens of whole texts."""

    def __init__(self, path: str, whole: frozenset[str], memo: int = MEMO):
        self.whole, self.memo_size, self.memo = whole, memo, {}
        self.bpe = Bpe(path, memo=0)
        self.merged = 0                      # words that had to be merged

    def count(self, text: str) -> int:
        bpe = self.bpe
        if bpe.find_special is None or not any(s in text for s in bpe.special):
            return self._plain(text)
        return sum(1 if part in bpe.special else self._plain(part)
                   for part in bpe.find_special.split(text) if part)

    def _plain(self, text: str) -> int:
        return sum([self._piece(p) for p in PIECES.findall(text)])

    def _piece(self, piece: str) -> int:
        """Text between two boundaries of the pre-split."""
        known = self.memo.get(piece)
        if known is None:
            if len(piece) > RUN or MOVING.search(piece):
                known = len(self.bpe.encode(piece))
            else:
                known = sum([1 if w in self.whole else self._merge(w) for w in PRESPLIT.findall(piece)])
            if len(self.memo) < self.memo_size and len(piece) <= 64:
                self.memo[piece] = known
        return known

    def _merge(self, word: str) -> int:
        self.merged += 1
        return len(self.bpe.model.tokenize(word.encode().decode("latin-1").translate(self.bpe.char_of)))

    def _spaced(self, word: str) -> int:
        """A space and text without one."""
        if word.isascii() and word.isalpha() and " " + word in self.whole:
            return 1                         # one word of the pre-split, and a whole token
        return self._piece(" " + word) if len(word) < RUN else self._plain(" " + word)

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """The counts of all texts; each distinct word of the batch is counted once."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        for special in self.bpe.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        odd = odd.to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), np.int64)
        even = texts.filter(pa.array(~odd))
        cut = pc.split_pattern(even, " ")
        starts = cut.offsets.to_numpy()[:-1].astype(np.int64)
        words = cut.flatten().dictionary_encode()
        which = words.indices.to_numpy().astype(np.int64)
        n = np.array([self._spaced(w) for w in words.dictionary.to_pylist()], np.int64)[which]
        n[starts] = [self._plain(w) for w in words.dictionary.take(pa.array(which[starts])).to_pylist()]
        out[~odd] = np.add.reduceat(n, starts) if len(starts) else []
        out[odd] = [self.count(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        return out


def counts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
           limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    A null or empty text has no bytes and no tokens.  Null and repeated keys are
    ordinary rows.  Texts of any length are counted whole.  The proven set has at
    most as many strings as the vocabulary and travels with the tasks.
    """
    whole = whole_tokens(tokenizer)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer, whole)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            size = pc.cast(pc.binary_length(b.column(1)), pa.int64())
            return pa.RecordBatch.from_arrays([b.column(0), size, pa.array(counter.count_all(b.column(1)), pa.int64())],
                                              ["key", "n_bytes", "n_tokens"])
        yield from by_slices(one, max_bytes=SLICE)(batches)
    return (rows.mapInArrow(run, f"key {kind}, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("key", key))
