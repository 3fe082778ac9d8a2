import random
import re

import numpy as np
from pyspark.sql import functions as F

from tickyard.llm import near_dedup as N
from tickyard.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    """Components of rows (doc_id, text) by comparing all pairs."""
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i is None, i or 0, len(shingles(t, k)), find(i) if i is not None else None) for i, t in rows)


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in rows)


def copies(seed, groups=12, size=8):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghijkl", k=r.randint(2, 6)))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(r.randint(3, 120))]
        for _ in range(r.randint(1, size)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 12))):
                w[r.randrange(len(w))] = word().upper() if r.random() < 0.5 else w[0]
            rows.append((len(rows), " ".join(w)))
    return rows


def test_against_all_pairs(spark):
    for seed, k in ((1, 2), (2, 5)):
        rows = copies(seed)
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert result(N.near_duplicates(df, k)) == brute(rows, k)


def test_chain_through_one_bucket(spark):
    """Links that do not touch a bucket's first member are found in the second round."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(words))]
    for i in range(1, 30):      # drifts a little from its predecessor
        words[r.randrange(100)] = f"n{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(N.near_duplicates(df, 2)) == brute(rows, 2)


def edited(seed, n=120, edits=4):
    """Copies of a text that is not there, similar around 0.8: few are linked with a bucket's leader."""
    r = random.Random(seed)
    for i in range(n):
        words = [f"w{j}" for j in range(100)]
        for at in r.sample(range(100), edits):
            words[at] = f"n{i}x{at}"
        yield i, " ".join(words)


def test_links_of_repeated_rows(spark):
    """Every row stands two or three times; copies must not take the places of rare shingles."""
    rows = [row for row in edited(9) for _ in range(2 + row[0] % 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(N.near_duplicates(df, 2)) == brute(rows, 2)


def test_links_of_ids_with_two_texts(spark):
    """An id's texts are sets of their own: one is edited, the other is like nothing."""
    rows = [(i, t) for i, copy in edited(9) for t in (copy, copy.upper(), " ".join(f"x{i}y{j}" for j in range(150)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(N.near_duplicates(df, 2)) == brute(rows, 2)


def test_odd_rows(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for k in (2, 5):
        assert result(N.near_duplicates(docs, k)) == brute(rows, k)


def test_survivors(docs, no_docs):
    out = N.survivors(docs, 2)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 9, 11] and ids.count(None) == 2
    assert N.survivors(no_docs, 2).collect() == [] and N.near_duplicates(no_docs, 2).collect() == []


def test_tensor_keys_agree_like_their_groups():
    t = N.Tensor()
    r = np.random.default_rng(0)
    a = np.unique(r.integers(0, 1 << 63, 400, dtype=np.uint64))
    b = a[:360]                                   # similarity 0.9
    x, y = (np.frombuffer(t.signature(s), "<u4").reshape(1, -1) for s in (a, b))
    left = (x[0, :36] == y[0, :36]).reshape(N.LEFT, N.LEFT_ROWS).all(1)
    right = (x[0, 36:] == y[0, 36:]).reshape(N.RIGHT, N.RIGHT_ROWS).all(1)
    same = N.keys_of(x)[0] == N.keys_of(y)[0]
    assert same.ravel().tolist() == np.outer(left, right).ravel().tolist() and same.any()


def test_components(spark):
    r = random.Random(4)
    for n, m in ((60, 40), (50, 200), (300, 299)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] if m != 299 else [(i, i + 1) for i in range(n - 1)]
        rows = [(i, f"x{i}") for i in range(n)]
        root = list(range(n))
        for _ in rows:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        assert all(got.get(i, i) == root[i] for i in range(n))
    assert components(spark.createDataFrame([], "a bigint, b bigint")).select(F.count("*")).first()[0] == 0


def drifted(seed, n, least=2, most=3):
    r = random.Random(seed)
    for i in range(n):
        words = [f"w{j}" for j in range(100)]
        for at in r.sample(range(100), r.randint(least, most)):
            words[at] = f"n{i}x{at}"
        yield i, " ".join(words)


def test_second_step_grows_with_the_group(spark, monkeypatch):
    """One group of near copies of a text that is not there: few are linked, none of the rest is
    paired with all others."""
    rows = {}
    keep = N.stored

    def counted(df, kind):
        out = keep(df, kind)
        rows.setdefault(kind, []).append(out.count())
        return out
    monkeypatch.setattr(N, "stored", counted)
    seen = []
    for n in (150, 300, 600):
        rows.clear()
        texts = list(drifted(9, n))
        df = spark.createDataFrame(texts, "doc_id bigint, text string")
        assert result(N.near_duplicates(df, 5)) == brute(texts, 5)
        first, second = rows["dedup-pairs"]
        seen.append((rows["dedup-places"][0] + second, first, second))
    for small, large in zip(seen, seen[1:], strict=False):
        assert large[0] <= 2.3 * small[0] and large[1] <= 2.4 * small[1]
    assert all(second < n for (_, _, second), n in zip(seen, (150, 300, 600), strict=True))


def test_short_and_long_sets_across(spark):
    """Sets of under sixteen shingles meet by their rarest ones, long ones by pieces."""
    r = random.Random(3)
    rows = []
    for base in range(6):
        words = [f"b{base}w{i}" for i in range(r.choice([6, 12, 20, 1500]))]
        for _ in range(25):
            w = list(words)
            for at in r.sample(range(len(w)), max(1, len(w) // 40)):
                w[at] = f"e{len(rows)}x{at}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for k in (2, 5):
        assert result(N.near_duplicates(df, k)) == brute(rows, k)


def test_very_long_text(spark):
    words = [f"w{i % 5000}x{i}" for i in range(120_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:110_000])), (3, " ".join(words[60_000:])), (4, "short one")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(N.near_duplicates(df, 5)) == brute(rows, 5)
