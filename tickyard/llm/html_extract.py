"""Main text of pages by a recurrent block labeller.

A page is a sequence of leaf blocks.  Each block is a vector of its hashed tag
path (element names, class and id words, the innermost ones again), its hashed
words and a few shape figures.  A bidirectional LSTM, in numpy, reads the whole
sequence, so every block is labelled with the context of the whole document; the
blocks labelled as article are the main text.  The model is trained here, on a
fixed number of pages drawn from a layout grammar (html_training).
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices
from .html_blocks import Block, blocks
from .html_training import training_pages

PATH_DIM, WORD_DIM, SHAPE_DIM = 192, 32, 8
INPUT = 2 * PATH_DIM + WORD_DIM + SHAPE_DIM
HIDDEN = 24
TRAINING_PAGES, EPOCHS, BATCH, RATE, NAME_DROPOUT = 1_000, 5, 20, 0.01, 0.15
BATCH_BLOCKS = 8_192       # blocks that are labelled together, padding included, at least one page


def vectors(page: list[Block], memo: dict[str, int], drop=None) -> np.ndarray:
    """One row per block.  ``drop`` (training) leaves out path words at random."""
    out = np.zeros((len(page), INPUT), np.float32)
    for i, b in enumerate(page):
        path = b.path if drop is None else tuple(w for w in b.path if drop() > NAME_DROPOUT)
        row = out[i]
        for w in path:
            row[_code(w, memo) % PATH_DIM] = 1
        for w in path[-3:]:
            row[PATH_DIM + _code(w, memo) % PATH_DIM] = 1
        words = b.text.split(" ")
        codes = np.fromiter([_code(w, memo) for w in words], np.int64, len(words)) % WORD_DIM
        count = np.bincount(codes, minlength=WORD_DIM)
        row[2 * PATH_DIM:2 * PATH_DIM + WORD_DIM] = count / math.sqrt(float(np.dot(count, count)))
        n = len(b.text)
        row[2 * PATH_DIM + WORD_DIM:] = (
            1.0, math.log1p(n) / 8, math.log1p(len(words)) / 6, min(1.0, b.link_chars / n),
            i / max(1, len(page) - 1), 1.0 / len(page), b.text[-1] in ".!?", b.text[:1] == "©")
    return out


def _code(word: str, memo: dict[str, int]) -> int:
    code = memo.get(word)
    if code is None:
        code = zlib.crc32(word.encode())
        if len(memo) < 200_000:
            memo[word] = code
    return code


class BiLstm:
    """A bidirectional LSTM with a logistic output for every step."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = r.normal(0, 0.08, (INPUT, 4 * HIDDEN)).astype(np.float32)
            self.p[f"h{d}"] = r.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1.0
            self.p[f"c{d}"] = bias
        self.p["o"] = r.normal(0, 0.2, 2 * HIDDEN + INPUT).astype(np.float32)
        self.p["ob"] = np.zeros(1, np.float32)

    def _scan(self, x: np.ndarray, mask: np.ndarray, d: str):
        """Forward pass over (time, pages, input); steps under a zero mask keep the state."""
        steps, pages, _ = x.shape
        inner = (x.reshape(-1, INPUT) @ self.p[f"x{d}"] + self.p[f"c{d}"]).reshape(steps, pages, -1)
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        hs, keep = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            z = inner[t] + h @ self.p[f"h{d}"]
            i, f, o = (1 / (1 + np.exp(-np.clip(z[:, k * HIDDEN:(k + 1) * HIDDEN], -30, 30))) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            keep.append((t, h, c, i, f, o, g, tanh_c))
            c = m * new_c + (1 - m) * c
            h = m * (o * tanh_c) + (1 - m) * h
            hs[t] = h
        return hs, keep

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self._forward(x, mask)[0]

    def _forward(self, x, mask):
        (hf, kf), (hb, kb) = self._scan(x, mask, "f"), self._scan(x, mask, "b")
        top = np.concatenate([hf, hb, x], axis=2)
        z = top @ self.p["o"] + self.p["ob"]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), top, kf, kb

    def gradients(self, x, mask, y) -> dict[str, np.ndarray]:
        prob, top, kf, kb = self._forward(x, mask)
        dz = ((prob - y) * mask / mask.sum()).astype(np.float32)
        g = {"o": np.einsum("tb,tbk->k", dz, top), "ob": np.array([dz.sum()], np.float32)}
        dtop = dz[:, :, None] * self.p["o"]
        for d, keep, dh_out in (("f", kf, dtop[:, :, :HIDDEN]), ("b", kb, dtop[:, :, HIDDEN:2 * HIDDEN])):
            dzs = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            dw = np.zeros_like(self.p[f"h{d}"])
            for t, h0, c0, i, f, o, c_in, tanh_c in reversed(keep):
                m = mask[t][:, None]
                dh = dh + dh_out[t]
                inner = m * dc + m * dh * o * (1 - tanh_c ** 2)
                dzt = np.concatenate([inner * c_in * i * (1 - i), inner * c0 * f * (1 - f),
                                      m * dh * tanh_c * o * (1 - o), inner * i * (1 - c_in ** 2)], axis=1)
                dzs[t] = dzt
                dw += h0.T @ dzt
                dh = dzt @ self.p[f"h{d}"].T + (1 - m) * dh
                dc = inner * f + (1 - m) * dc
            flat = dzs.reshape(-1, 4 * HIDDEN)
            g[f"x{d}"], g[f"h{d}"], g[f"c{d}"] = x.reshape(-1, INPUT).T @ flat, dw, flat.sum(0)
        return g


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x = np.zeros((steps, len(rows), INPUT), np.float32)
    mask = np.zeros((steps, len(rows)), np.float32)
    for k, r in enumerate(rows):
        x[:len(r), k], mask[:len(r), k] = r, 1
    return x, mask


@lru_cache(maxsize=2)
def trained(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights of the labeller, by Adam over the grammar's pages; a few seconds."""
    model, memo, r = BiLstm(), {}, np.random.default_rng(seed)
    parsed = [p for p in map(blocks, training_pages(pages, seed)) if p]
    mean = {k: np.zeros_like(v) for k, v in model.p.items()}
    square = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for epoch in range(epochs):
        order = np.array(sorted(range(len(parsed)), key=lambda k: (len(parsed[k]) // 4, r.random())))
        groups = [order[k:k + BATCH] for k in range(0, len(order), BATCH)]
        for k in r.permutation(len(groups)):
            some = [parsed[j] for j in groups[k]]
            x, mask = padded([vectors(p, memo, r.random) for p in some])
            y = np.zeros_like(mask)
            for j, p in enumerate(some):
                y[:len(p), j] = [b.main for b in p]
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs) * math.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for name, g in model.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                mean[name] = 0.9 * mean[name] + 0.1 * g
                square[name] = 0.999 * square[name] + 0.001 * g * g
                model.p[name] -= (rate * mean[name] / (np.sqrt(square[name]) + 1e-8)).astype(np.float32)
    return model.p


def label(pages: list[list[Block]], model: BiLstm, memo: dict[str, int]) -> list[np.ndarray]:
    """Per page the probability of each block to be article; pages of like length go together."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and len(pages[order[to]]) * (to + 1 - at) <= BATCH_BLOCKS:
            to += 1
        x, mask = padded([vectors(pages[k], memo) for k in order[at:to]])
        prob = model.probabilities(x, mask)
        for j, k in enumerate(order[at:to]):
            out[k] = prob[:len(pages[k]), j]
        at = to
    return out


def extract(pages: DataFrame, threshold: float = 0.5, key: str = "page_id", url: str = "url",
            page: str = "html") -> DataFrame:
    """(page_id, url, text): the article blocks of every page, joined by a line break.

    A null or empty page, and one without article blocks, has the empty text.
    Null and repeated ids and urls are passed on."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    weights = pages.sparkSession.sparkContext.broadcast(trained())     # some 100,000 floats

    def run(batches):
        model, memo = BiLstm(), {}
        model.p = weights.value
        for batch in batches:
            for b in slices(batch, "html", 8 << 20):
                parsed = [blocks(h or "") for h in b.column(2).to_pylist()]
                texts = ["\n".join(x.text for x, v in zip(p, prob, strict=True) if v >= threshold)
                         for p, prob in zip(parsed, label(parsed, model, memo), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])
    return rows.mapInArrow(run, rows.select("page_id", "url").schema.add("text", "string"))
