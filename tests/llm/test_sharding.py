import random
import zlib

import pytest

from tickyard.llm import sharding as S


def naive(sizes, capacity):
    """Best fit decreasing, one group at a time."""
    bins = []
    for size in sorted((s for s, n in sizes for _ in range(n)), reverse=True):
        fits = [b for b in range(len(bins)) if bins[b] >= size]
        if fits:
            b = min(fits, key=lambda b: (bins[b], b))
        else:
            bins.append(capacity)
            b = len(bins) - 1
        bins[b] -= size
    return sorted(bins)


def test_runs_equal_one_by_one_packing():
    r = random.Random(1)
    for _ in range(200):
        sizes = list({r.randint(1, 50): r.randint(1, 9) for _ in range(r.randint(1, 12))}.items())
        capacity = r.randint(50, 120)
        runs, shards = S.best_fit_decreasing(sizes, capacity)
        left = [capacity] * shards
        for size, _, n, b in runs:
            left[b] -= size * n
        assert sorted(left) == naive(sizes, capacity) and min(left) >= 0
        for size, n in sizes:       # ranks of a size are covered once
            ranks = sorted(k for s, first, m, _ in runs if s == size for k in range(first, first + m))
            assert ranks == list(range(n))
    with pytest.raises(ValueError):
        S.best_fit_decreasing([(10, 1)], 9)
    assert S.best_fit_decreasing([(6, 3)], 10, limit=2) is None


def test_tree():
    r, tree, model = random.Random(2), S.CapacityTree(), []
    for k in range(2000):
        if r.random() < 0.6:
            entry = (r.randint(0, 100), k)
            tree.add(*entry)
            model.append(entry)
        else:
            size = r.randint(0, 110)
            want = min((e for e in model if e[0] >= size), default=None)
            assert tree.take_tightest(size) == want
            if want:
                model.remove(want)


def test_balanced_with_giants():
    runs = S.balanced_runs([(1000, 1), (900, 2), (3, 40), (1, 25)], 8)
    load = [0] * 8
    for size, _, n, b in runs:
        load[b] += size * n
    assert sum(load) == 1000 + 1800 + 145 and sorted(load)[-3:] == [900, 900, 1000]
    assert max(load[b] for b in range(8) if load[b] < 900) - min(load) <= 3
    assert S.balanced_runs([], 8) == []


def check(rows, docs, shards):
    texts = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == texts
    for b in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == b)
        assert slots == list(range(len(slots)))
    where = {}
    for r in rows:
        where.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(w) == 1 for w in where.values())
    assert {r.shard for r in rows} <= set(range(shards))


def test_pack_odd_rows(spark, docs, no_docs):
    check(S.pack(docs, shards=8).collect(), docs.collect(), 8)
    assert S.pack(no_docs, shards=8).collect() == [] and S.pack(no_docs, capacity=10).collect() == []
    rows = S.pack(docs, capacity=100_000).collect()
    check(rows, docs.collect(), 2)


def test_pack_is_nearly_equal(spark):
    r = random.Random(3)
    rows = [(i, "x" * r.choice([5, 5, 5, 40, 300, r.randint(1, 900)]) + str(i)) for i in range(2000)]
    docs = spark.createDataFrame(rows + [(5000 + i, "copy") for i in range(300)], "doc_id bigint, text string")
    out = S.pack(docs, shards=8).collect()
    check(out, docs.collect(), 8)
    load = [sum(r.size for r in out if r.shard == b) for b in range(8)]
    assert max(load) - min(load) <= 10


def test_every_group_meets_one_run(spark):
    """Long runs are met by whole blocks of ranks, their ends and short runs by the rank."""
    runs, at = [], 0
    for k, count in enumerate([1, 1, 1, 3, 40, 1, 2, 100, 7]):
        runs.append((10, at, count, k))
        at += count
    runs.append((20, 0, 5, 99))
    table = spark.createDataFrame(runs, "total bigint, first bigint, count bigint, shard bigint")
    groups = spark.createDataFrame([(10, i) for i in range(at)] + [(20, i) for i in range(5)], "total bigint, rank bigint")
    want = sorted((t, r, s) for t, first, n, s in runs for r in range(first, first + n))
    for block in (1, 8, 4096):
        assert sorted((r.total, r.rank, r.shard) for r in S.in_runs(groups, table, block).collect()) == want


def test_capacity_with_many_equal_groups(spark):
    docs = spark.createDataFrame([(i, f"text {i:04d}") for i in range(400)], "doc_id bigint, text string")
    rows = S.pack(docs, capacity=35).collect()         # three groups of ten bytes each
    load = {}
    for r in rows:
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert len(rows) == 400 and max(load.values()) <= 35 and len(load) == 134
