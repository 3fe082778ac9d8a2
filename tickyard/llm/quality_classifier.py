"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

A text is cut into tokens: runs of letters and digits, in lower case, and runs
of other signs.  Features are the tokens, neighbouring pairs and triples,
hashed into ``2 ** BITS`` weights.  A token equal to the one before it counts
as a repetition mark, and so does a token of all capitals beside its own form,
so that spam words never seen in training still leave known n-grams.
A feature's value is its count divided by the root of the text's n-gram count.

The model is fitted with follow-the-regularised-leader updates (per-coordinate
steps, L1 and L2) on at most ``MAX_LABELS`` labelled documents of the training
fold, the ones with the smallest hash of doc_id; scoring is a sparse dot
product per text.  The score sees nothing but the text.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import by_slices, column_of, with_text

BITS = 18
MAX_LABELS = 4_000     # labelled documents that the model is fitted on, at most
MAX_FEATURES = 16_384    # hashed features of a training document that reach the driver
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
HELD_OUT_FOLD, FOLDS = 1, 3

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
SAME, CAPITALS, STEP_1, STEP_2 = 0x9E37, 0x7F4A, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def fold_of(key: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(key.cast("string")) % FOLDS


class Features:
    """Hashed n-grams of a text; remembers the hashes of tokens it has seen."""

    def __init__(self, bits: int = BITS, memo: int = 150_000):
        self.shift, self.memo_size, self.memo = np.uint64(64 - bits), memo, {}

    def _hash(self, token: str) -> int:
        h = zlib.crc32(token.lower().encode()) << 1 | (token.isupper() and len(token) > 1)
        if len(self.memo) < self.memo_size:
            self.memo[token] = h
        return h

    def grams(self, text: str) -> np.ndarray:
        """The index of every n-gram of the text, repeats included."""
        get, tokens = self.memo.get, TOKEN.findall(text)
        codes = np.fromiter([get(t) or self._hash(t) for t in tokens], np.uint64, len(tokens))
        if not len(codes):
            return np.zeros(0, np.int64)
        capitals = codes[(codes & np.uint64(1)) == 1]
        t = codes >> np.uint64(1)
        t[1:][t[1:] == t[:-1].copy()] = SAME
        with np.errstate(over="ignore"):
            a, b = np.uint64(STEP_1), np.uint64(STEP_2)
            two = t[:-1] * a + t[1:]
            grams = [t * b, two * b + np.uint64(1), (two[:-1] * a + t[2:]) * b + np.uint64(2),
                     np.full(len(capitals), CAPITALS, np.uint64) * b]
        return (np.concatenate(grams) >> self.shift).astype(np.int64)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct indices, values); empty for no tokens."""
        grams = self.grams(text)
        index, count = np.unique(grams, return_counts=True)
        return index, count / np.sqrt(max(len(grams), 1))


class Ftrl:
    """FTRL-proximal logistic regression over sparse rows, with a free intercept."""

    def __init__(self, size: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.bias = size

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.where(np.asarray(at) == self.bias, 0.0, self.l1)
        w = -(z - np.sign(z) * pull) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= pull, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (sigmoid(np.dot(w, x)) - label) * x
        n = self.n[at]
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - step * w
        self.n[at] = n + g * g


def sigmoid(v: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(v, -35.0, 35.0))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the intercept) from (indices, values, label) rows.
    A row is widened to 64 bits and given its intercept only while it is used."""
    model = Ftrl(1 << bits)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x, label = rows[k]
            model.update(np.append(at.astype(np.int64), model.bias), np.append(x.astype(np.float64), 1.0), label)
    return model.weights(np.arange(model.bias + 1)).astype(np.float32)


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
                  limit: int = MAX_LABELS) -> DataFrame:
    """(doc_id, quality, text) of the bounded training sample: labelled rows
    outside the held-out fold, the ``limit`` ids with the smallest hash, and one
    text of each: that with the smallest hash, where rows repeat the id.  Rows
    without an id, a label or a text are not trained on."""
    picked = (labels.filter(F.col("quality").isNotNull() & (fold_of(F.col(key)) != HELD_OUT_FOLD))
              .groupBy(F.col(key).alias("doc_id")).agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    texts = docs.select(F.col(key).alias("doc_id"), "text").filter(F.col("text").isNotNull())
    found = texts.join(F.broadcast(picked), "doc_id")   # at most ``limit`` narrow rows
    return found.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def strongest(at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most MAX_FEATURES of a training row, in their order."""
    if len(at) <= MAX_FEATURES:
        return at, x
    keep = np.sort(np.lexsort((at, -x))[:MAX_FEATURES])
    return at[keep], x[keep]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", limit: int = MAX_LABELS) -> np.ndarray:
    """Fit the model.  Tasks hash the sample's texts; the driver gets the hashed
    rows of at most ``limit`` documents, at most MAX_FEATURES of each (those of
    the largest values), and runs the sequential updates.
    Without labelled rows every weight is 0 and every score 0.5."""
    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        f = Features()
        got = [strongest(*f.of(t)) for t in b.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*b.columns[:2], pa.array([i.astype("<u4").tobytes() for i, _ in got], pa.binary()),
             pa.array([x.astype("<f4").tobytes() for _, x in got], pa.binary())],
            ["doc_id", "quality", "at", "x"])
    rows = training_rows(docs, labels, key, limit).select(
        F.col("doc_id").cast("string"), F.col("quality").cast("int"), "text").mapInArrow(
        by_slices(one), "doc_id string, quality int, at binary, x binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.at)))
    return fit([(np.frombuffer(r.at, "<u4"), np.frombuffer(r.x, "<f4"), r.quality) for r in rows])


def score_texts(texts: list[str | None], weights: np.ndarray, f: Features) -> list[float]:
    out = []
    for t in texts:
        grams = f.grams(t or "")
        dot = float(weights[grams].sum(dtype=np.float64)) / np.sqrt(max(len(grams), 1))
        out.append(sigmoid(dot + float(weights[-1])))
    return out


def with_scores(docs: DataFrame, weights: np.ndarray, *keep: str, text: str = "text",
                out: str = "score") -> DataFrame:
    """Columns ``keep`` and the score; empty and null texts get the intercept's score.
    ``text`` may be a field of a struct in ``keep``, like ``row.text``."""
    rows, names, place = with_text(docs, keep, text)
    shared = docs.sparkSession.sparkContext.broadcast(weights)   # 2 ** BITS floats: 1 MB

    def run(batches):
        f, w = Features(), shared.value

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            score = score_texts(column_of(b, place).to_pylist(), w, f)
            return pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(score, pa.float64())],
                                              [*names, "score"])
        yield from by_slices(one, place)(batches)

    schema = rows.select(*names).schema.add("score", "double")
    return rows.mapInArrow(run, schema).withColumnsRenamed(
        {**dict(zip(names, keep, strict=True)), "score": out})


def scores(docs: DataFrame, weights: np.ndarray, key: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; a null id is not held out."""
    return with_scores(docs, weights, key).select(
        F.col(key), F.coalesce(fold_of(F.col(key)) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they were."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (with_scores(docs.select(whole.alias("__row")), weights, "__row", text="__row.text", out="__score")
            .filter(F.col("__score") >= threshold).select("__row.*"))
