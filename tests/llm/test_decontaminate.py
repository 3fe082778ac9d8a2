import math
import random
import re

from pyspark.sql import functions as F

from tickyard.llm import decontaminate as D

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=5):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(docs, items, percent=80):
    out = set()
    for d, text in docs:
        for i, item in items:
            width = min(5, len(WORD.findall(item or "")))       # short items are one shingle
            want = shingles(item, width) if width else set()
            n = len(want & shingles(text, width)) if want else 0
            if want and 100 * n >= percent * len(want):
                out.add((d, i, len(want), n))
    return out


def corpus(seed):
    r = random.Random(seed)
    say = lambda n: [f"w{r.randrange(400)}" for _ in range(n)]
    items = [(i, " ".join(say(r.choice([3, 5, 6, 14, 30, 60])))) for i in range(40)]
    docs = []
    for d in range(150):
        w = say(r.choice([0, 4, 20, 300, 6000]))
        for _ in range(r.randint(0, 2)):
            item = r.choice(items)[1].split()
            if r.random() < 0.4:
                item[r.randrange(len(item))] = "changed"
            at = r.randint(0, len(w))
            half = len(item) // 2 if r.random() < 0.3 else 0
            w[at:at] = item[half:]
            if half:
                w[0:0] = item[:half]
        docs.append((d, r.choice([" ", "\n", " \t"]).join(w).title()))
    return docs, items


def test_items_of_one_to_four_words(spark):
    items = [(1, "Zeta"), (2, "alpha beta"), (3, "one two\tthree four"), (4, ""), (5, None), (6, " \n"), (None, "null id"),
             (7, "a b c"), (7, "x y"), (8, "one two three four five six")]
    docs = [(1, "the zeta of alpha  BETA"), (2, "beta alpha"), (3, "zero one\ntwo three FOUR five six"), (4, None),
            (5, "a b x y"), (6, "alpha"), (None, "a null id zetas"), (8, "alpha beta " * 3000 + "zeta")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("value", F.lit(1)).withColumn("width", F.lit(2))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("value", F.lit(1))
    got = sorted((tuple(r) for r in D.leaks(df, bench).collect()), key=str)
    assert got == sorted(brute(docs, items), key=str) and len(got) == 8
    assert {r.doc_id for r in D.clean(df, bench).collect()} == {2, 4, 6}
    assert D.leaks(df.filter("false"), bench).collect() == [] and D.leaks(df, bench.filter("false")).collect() == []


def test_against_all_pairs(spark):
    for seed in (1, 2):
        docs, items = corpus(seed)
        df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("hashes", F.lit("x"))
        bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("n", F.lit(1))
        got = {tuple(r) for r in D.leaks(df, bench).collect()}
        assert got == brute(docs, items) and got
        clean = D.clean(df, bench)
        assert clean.columns == df.columns
        assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {g[0] for g in got}


def test_items_of_one_shingle_are_always_found(spark):
    """Five words each, in documents that nearly fill their size class."""
    r = random.Random(6)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(5))) for i in range(40)] + [(40, "one one one one one one one")]
    items.append((41, " ".join(f"long{k}" for k in range(30))))
    docs = []
    for d in range(100):
        parts = [t for _, t in items] + [f"d{d}x{k}" for k in range(200)]
        r.shuffle(parts)
        docs.append((d, " ".join(parts)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(x) for x in D.leaks(df, bench).collect()}
    assert got == brute(docs, items) and len(got) == 100 * len(items)


def test_bins_allow_for_the_unshared_shingles_of_the_item():
    for n in range(2, 400):
        both = 2.0 ** -D.extra_bits(n) * 100 / D.CONTAINMENT
        shared = -(-D.CONTAINMENT * n // 100)
        assert (1 - (1 - math.exp(-both)) / both) ** shared <= D.MISS


def test_odd_rows_and_empty_tables(spark, docs, no_docs):
    items = [(1, "the quick brown fox jumps over the lazy dog"), (None, "runs away from every other animal"), (2, None), (3, "too few")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in D.leaks(docs, bench).collect()}
    assert got == brute({(r.doc_id, r.text) for r in docs.collect()}, items)
    assert (None, None, 2, 2) in got
    assert D.leaks(no_docs, bench).collect() == [] and D.leaks(docs, bench.limit(0)).collect() == []
    assert D.clean(docs, bench.limit(0)).count() == docs.count()


def test_main_path_is_native(spark, docs):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over")], "item_id bigint, text string")
    for df in (D.candidates(docs, D.item_sets(bench)), D.leaks(docs, bench), D.clean(docs, bench)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_bins_follow_the_smallest_item():
    assert D.extra_bits(5) >= D.extra_bits(10) >= D.extra_bits(50) >= D.extra_bits(500)
