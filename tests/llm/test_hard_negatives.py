import math
import random

import numpy as np

from tickyard.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every=50, positives=5, negatives=3):
    """All scores of every anchor, sorted."""
    used = []
    for at, (key, x, label) in enumerate(rows):
        if key is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(256 * float(np.float32(c))) for c in x]
        used.append((key, at, (label + 1) % 10 if key % 7 == 0 else label, v))
    out = []
    for key, at, label, v in used:
        if key % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), k, i, other)
                        for k, i, other, w in used if i != at)
        for p, pk, _, _ in [s for s in scored if s[3] == label][:positives]:
            fit = [s for s in scored if s[3] != label and -50 * p <= -100 * s[0] <= -95 * p][:negatives]
            out += [(key, pk, r + 1, k, -p, -n) for r, (n, k, _, _) in enumerate(fit)]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r[c] for c in NAMES) for r in H.mine(df, **kw).collect())


def vectors(seed, n, width=6, steps=8):
    """Coarse components, so that many scores tie."""
    r = random.Random(seed)
    return [(i, [r.randint(-steps, steps) / 16 for _ in range(width)], r.randrange(4)) for i in range(n)]


def test_against_all_scores_in_many_blocks(spark):
    for seed, n, block, anchors in ((1, 300, 4096, 128), (2, 420, 50, 3), (3, 130, 7, 2)):
        rows = vectors(seed, n)
        df = spark.createDataFrame(rows, SCHEMA)
        want = brute(rows)
        assert want and mined(df, block=block, anchors=anchors) == want


def test_hot_label_and_equal_vectors(spark):
    """Two thirds of the rows have one label, a third of them one vector."""
    rows = [(i, x if i % 3 else [0.5, -0.25, 0.125, 0.0, 0.25, 0.5], 1 if i % 3 < 2 else lab)
            for i, x, lab in vectors(5, 400)]
    assert mined(spark.createDataFrame(rows, SCHEMA), block=64, anchors=4) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(7, 160) + [
        (0, [0.25] * 6, 2), (50, [0.5] * 6, 2), (50, [0.5] * 6, 2),        # repeated keys and rows
        (None, [0.5] * 6, 1), (200, None, 1), (250, [0.5] * 6, None), (300, [0.5, None, 0.5, 0.5, 0.5, 0.5], 1),
        (350, [nan, 0.5, 0.5, 0.5, 0.5, 0.5], 1), (400, [0.5, -inf, 0.5, 0.5, 0.5, 0.5], 1),
        (450, [0.0] * 6, 1), (-50, [0.25, -0.5, 0.5, 0.25, 0.0, 0.5], 3)]
    clash = [(*r, 1, "x", 2, 3) for r in rows]
    df = spark.createDataFrame(clash, SCHEMA + ", row int, block string, score int, id int")
    assert mined(df, block=32) == brute(rows)
    assert mined(df.filter("vec_id < 0")) == [] and mined(df.filter("false")) == []
    short = [(0, [0.5, 0.5], 1), (1, [0.5], 1), (2, [], 1), (3, [0.25, 0.25, 0.25], 2), (4, [2.0 ** 30], 2)]
    filled = [(k, x + [0.0] * (3 - len(x)), c) for k, x, c in short[:4]]      # the last one is too large
    assert mined(spark.createDataFrame(short, SCHEMA)) == brute(filled)


def test_large_components_are_scored_in_integers():
    """Products beyond 2 ** 53 take the integer path and stay exact."""
    r = np.random.default_rng(0)
    v = r.integers(-H.LARGEST, H.LARGEST, (300, 5)).astype(np.int32)
    order = np.argsort(v, axis=0, kind="stable").astype("<i4")
    n = np.arange(300)
    block = H.Block(b"".join([n.astype("<i8").tobytes()] * 3 + [v.astype("<i4").tobytes(), order.T.tobytes()]), 5)
    anchors = v[:4]
    low, high = np.full(4, H.NONE + 1), np.full(4, np.iinfo(np.int64).max)
    w, at, s = H.best_in_windows(block, anchors, np.arange(4), low, high, lambda a: np.ones((4, len(a)), bool), 3)
    for a in range(4):
        exact = sorted(((-sum(int(x) * int(y) for x, y in zip(anchors[a], u)), i) for i, u in enumerate(v)))[:3]
        assert [(-s[i], at[i]) for i in np.flatnonzero(w == a)] == exact


def test_search_stops_early():
    """Rows far below the windows are not met: their lists are not read to the end."""
    r = np.random.default_rng(1)
    v = np.concatenate([r.integers(-20, 20, (4000, 4)), np.full((10, 4), 200)]).astype(np.int32)
    order = np.argsort(v, axis=0, kind="stable").astype("<i4")
    n = np.arange(len(v)).astype("<i8").tobytes()
    block = H.Block(n * 3 + v.astype("<i4").tobytes() + order.T.tobytes(), 4)
    met = []

    def admit(at):
        met.extend(at.tolist())
        return np.ones((1, len(at)), bool)
    w, at, s = H.best_in_windows(block, np.full((1, 4), 9, np.int32), np.zeros(1, np.int64),
                                 np.array([H.NONE + 1]), np.array([1 << 40]), admit, 3)
    assert sorted(at.tolist()) == [4000, 4001, 4002] and set(s.tolist()) == {7200}
    assert len(met) < 400
