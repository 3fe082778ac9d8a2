import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tickyard.llm import quality_classifier as C, quality_rules as R
from tickyard.llm.common import column_of, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """Counts by positions, from their definitions."""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), dup, len(covered))


def test_counts():
    r = random.Random(2)
    for _ in range(300):
        text = "".join(r.choice(["a ", "b ", "a b c ", "é\n", "x\n", "\x0b", "#|", "\xa0", "日 ", "\x1c"]) for _ in range(30))
        assert R.counts_of(text.encode()) == brute(text), text


def test_sketch_buckets(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 123456]
    got = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", R.bucket_of(F.col("v")).alias("b")).collect()
    for row in got:
        assert row.b <= row.v and row.v - row.b <= max(row.b, 1) / 32
        assert row.v >= 64 or row.b == row.v


def good_text(r, n=80):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(3, 7))) for _ in range(n))


def corpus(spark, r):
    rows = [(i, good_text(r), "en", f"s{i % 2}") for i in range(200)]
    rows += [(1000 + i, " ".join(w + "###" for w in good_text(r).split()), "en", f"s{i % 2}") for i in range(40)]
    rows += [(2000 + i, good_text(r), "fr", f"rare{i}") for i in range(3)]
    rows += [(3000, None, None, None), (3001, "", "en", "s0"), (3002, "few words", "xx", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("kept", F.lit(7))


def test_rules_adapt_and_keep_clean_documents(spark):
    docs = corpus(spark, random.Random(3))
    got = {r.doc_id: r for r in R.rules(docs).collect()}
    assert len(got) == 246
    assert all(got[i].kept for i in range(200)) and all(got[2000 + i].kept for i in range(3))
    assert not any(got[1000 + i].kept for i in range(40))
    assert all(got[i].base_failed and not got[i].kept for i in (3000, 3001, 3002))
    kept = R.accepted(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert kept.filter("kept <> 7").isEmpty()


def test_two_sources_with_levels_of_their_own(spark):
    """Half a dozen symbols per word are ordinary in one source and junk in the other, whose
    ordinary words are longer than the first one's junk: no single cutoff keeps both and drops both."""
    r = random.Random(8)
    marked = lambda k: " ".join(w + "#" * r.randint(k, k + 2) for w in good_text(r).split())
    long = lambda k: " ".join("".join(r.choices("abcdefgh", k=r.randint(k, k + 4))) for _ in range(80))
    rows = [(i, marked(2), "en", "code") for i in range(300)] + [(1000 + i, marked(9), "en", "code") for i in range(15)]
    rows += [(2000 + i, long(14), "en", "terms") for i in range(300)] + [(3000 + i, marked(2), "en", "terms") for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {x.doc_id for x in R.rules(docs).filter("kept").collect()}
    assert {i for i, *_ in rows if i % 2000 < 1000} == kept


def test_a_tail_is_judged_by_its_word_lengths(spark):
    """Repeated lines in ordinary documents are an ordinary tail, symbols in documents of odd words a junk one."""
    r = random.Random(5)
    line = lambda: good_text(r, 20)
    rows = [(i, "\n".join(line() for _ in range(5)), "en", "s") for i in range(300)]
    for i in range(30):
        same = line()
        rows.append((1000 + i, "\n".join([same, same, *(line() for _ in range(3 + i % 4))]), "en", "s"))
    rows += [(2000 + i, " ".join(w * 4 + "#" for w in good_text(r).split()), "en", "s") for i in range(30)]
    rows += [(3000 + i, " ".join(w + "#" for w in good_text(r).split()), "en", "s") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {x.doc_id for x in R.rules(docs).filter("kept").collect()}
    assert kept == {i for i, *_ in rows if i < 2000}


def test_a_small_group_leans_on_its_language(spark):
    """Three documents follow their language, three hundred their own level; in between it is a mean."""
    q = lambda docs, n: F.struct(*[F.lit(docs).alias(k) for k in R.QUARTERS], F.lit(n).cast("long").alias("rows"))
    got = [spark.range(1).select(R._lean(q(1000, n), q(5000, 999), *R.QUARTERS).alias("q")).first().q.q2 for n in (1, 50, 10_000)]
    assert got == [(1000 + 50 * 5000) // 51, 3000, (10_000 * 1000 + 50 * 5000) // 10_050]


def test_a_row_goes_to_python_once(spark, docs, monkeypatch):
    """Its text inside it; what comes back are rows as they were."""
    moved, kind = [], type(docs)
    real = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **k: moved.append(self.columns) or real(self, *a, **k))
    weights = np.zeros((1 << C.BITS) + 1, np.float32)
    rows = {repr(r) for r in docs.collect()}
    for kept in (R.accepted(docs), C.accepted(docs, weights)):
        assert moved[-1] == ["k0"]
        assert {repr(r) for r in kept.collect()} <= rows
    assert {repr(r) for r in C.accepted(docs, weights).collect()} == rows


def test_fields_of_kept_rows(spark):
    batch = pa.RecordBatch.from_arrays([pa.array([{"text": "aa", "x": 1}, {"text": None, "x": 2}, {"text": "b", "x": 3}])], ["k0"])
    assert column_of(batch.slice(1), "k0.text").to_pylist() == [None, "b"]
    assert [s.num_rows for s in slices(batch, "k0.text", 2)] == [2, 1]


def test_sketches_merge(spark):
    docs = corpus(spark, random.Random(4))
    m = R.measure(docs, "lang", "source").cache()
    whole = R.sketch(m)
    halves = R.sketch(m.filter("n_words % 2 = 0")).union(R.sketch(m.filter("n_words % 2 = 1")))
    merged = halves.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
    assert whole.exceptAll(merged).isEmpty() and merged.exceptAll(whole).isEmpty()


def test_rules_on_odd_rows_and_empty_tables(docs, no_docs):
    got = R.rules(docs).collect()
    assert len(got) == docs.count()
    assert sorted(brute(r.text or "")[0] for r in docs.collect()) == sorted(r.n_words for r in got)
    assert R.rules(no_docs).collect() == [] and R.accepted(no_docs).collect() == []
    assert R.accepted(docs).columns == docs.columns


def labelled(spark, n=600):
    r = random.Random(5)
    rows = []
    for i in range(n):
        bad = r.random() < 0.3
        t = good_text(r, r.randint(10, 60))
        rows.append((i, " ".join(w + "!!" for w in t.split()) if bad else t, int(not bad)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    return df.select("doc_id", "text"), df.select("doc_id", "quality", F.lit(0).alias("toxic"))


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in C.training_rows(docs, labels).collect())
    assert C.training_rows(docs, labels, limit=50).count() == 50
    scores = C.scores(docs, C.train(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in scores if r.held_out]
    assert len(held) > 100 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scores)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.5) for r in scores)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = labelled(spark, 200)
    flipped = labels.withColumn("quality", F.when(C.fold_of(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(C.train(docs, labels), C.train(docs, flipped))


def test_one_bounded_row_per_sampled_id(spark):
    docs = spark.createDataFrame([(3, f"text {i % 7}") for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(3, 1), (3, 0), (3, None)], "doc_id bigint, quality int")
    fold = docs.select(C.fold_of(F.lit(3))).first()[0]
    rows = C.training_rows(docs, labels, limit=1).collect()
    assert len(rows) == (fold != C.HELD_OUT_FOLD)
    at, x = np.arange(C.MAX_FEATURES + 9), np.r_[np.zeros(9), np.ones(C.MAX_FEATURES)]
    kept, values = C.strongest(at, x)
    assert len(kept) == C.MAX_FEATURES and kept[0] == 9 and (values == 1).all()


def test_training_rows_are_widened_one_at_a_time():
    r = np.random.default_rng(1)
    rows = [(np.sort(r.choice(4096, 2_000, replace=False)).astype("<u4"), r.random(2_000, np.float32), i % 2)
            for i in range(200)]
    tracemalloc.start()
    narrow = C.fit(rows, bits=12)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(a.nbytes + x.nbytes for a, x, _ in rows) / 2
    wide = [(a.astype(np.int64), x.astype(np.float64), y) for a, x, y in rows]
    assert np.array_equal(narrow, C.fit(wide, bits=12))


def test_score_is_the_sparse_dot_product():
    f, w = C.Features(), np.random.default_rng(0).normal(size=(1 << C.BITS) + 1).astype(np.float32)
    for text in ["", "a b a b a b", "One ONE one!! é 日本", "x" * 5000]:
        at, x = f.of(text)
        want = C.sigmoid(float(np.dot(w[at].astype(float), x)) + float(w[-1]))
        assert abs(C.score_texts([text], w, f)[0] - want) < 1e-5


def test_classifier_on_odd_rows_and_empty_tables(spark, docs, no_docs):
    _, labels = labelled(spark, 30)
    weights = C.train(docs, labels.limit(0))
    assert not weights.any()
    got = C.scores(docs, weights).collect()
    assert len(got) == docs.count() and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert C.scores(no_docs, weights).collect() == []
    assert C.accepted(docs, weights).columns == docs.columns and C.accepted(docs, weights).count() == docs.count()
