"""Outliers judged by stored moments: equal to a judgement from the raw rows."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tickyard.session import fresh_dir
from tickyard.streaming import outliers as O

SCHEMA = "id int, symbol string, event_time timestamp, price double"
T0 = dt.datetime(2024, 1, 1)


def trades(n=300, days=6, seed=5, base=1e6):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        t = T0 + dt.timedelta(days=days * i / n)
        price = base + r.gauss(0, 1) * (20 if r.random() < 0.03 else 1)
        rows.append((i, r.choice(["A", "A", "B", None]), t, None if i % 50 == 7 else float("nan") if i % 50 == 9 else price))
    return rows


def brute(rows, k=3.0, lookback=None):
    out = {}
    for i, symbol, t, price in rows:
        past = [p for _, s, u, p in rows if s == symbol and u.date() < t.date() and p is not None and p == p
                and (lookback is None or (t.date() - u.date()).days <= lookback)]
        if len(past) < 2 or price is None:
            out[i] = False
        else:
            m, sd = statistics.fmean(past), statistics.stdev(past)
            out[i] = not (m - k * sd <= price <= m + k * sd)
    return out


@pytest.mark.parametrize("lookback", [None, 2])
def test_moments_judge_as_the_raw_rows_do(spark, lookback):
    rows = trades()
    df = spark.createDataFrame(rows, SCHEMA)
    moments = O.daily_moments(df.filter("id % 3 = 0"))
    for part in (1, 2):      # merged from parts, in any cut
        moments = O.merge_moments(moments, O.daily_moments(df.filter(F.col("id") % 3 == part)))
    got = {r.id: r.is_outlier for r in O.judged(df, moments, 3.0, lookback_days=lookback).collect()}
    want = brute(rows, 3.0, lookback)
    assert got == want and any(want.values())


def test_merged_moments_are_those_of_all_rows(spark):
    df = spark.createDataFrame(trades(base=1e9), SCHEMA)
    merged = O.merge_moments(O.daily_moments(df.filter("id % 2 = 0")), O.daily_moments(df.filter("id % 2 = 1")))
    whole = {(r.symbol, r.day): r for r in O.daily_moments(df).collect()}
    for r in merged.collect():
        w = whole[r.symbol, r.day]
        assert r.n == w.n and r["mean"] == pytest.approx(w["mean"], rel=1e-12)
        assert r.m2 == pytest.approx(w.m2, rel=1e-6, abs=1e-6)


def test_stream_goes_on_after_a_restart(spark):
    rows = trades(120)
    src, out, kept, ck = (fresh_dir(spark, f"test-{k}") for k in ("src", "out", "moments", "ck"))
    df = spark.createDataFrame(rows, SCHEMA)
    for lo, hi in ((0, 50), (50, 90), (90, 120)):      # a new run of the job for each part
        df.filter(F.col("id").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(src)
        q = O.start_outliers(spark.readStream.schema(SCHEMA).parquet(src), out, kept, ck, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    got = {r.id: r.is_outlier for r in spark.read.parquet(out).collect()}
    assert got == brute(rows)


def test_empty_input_and_first_day(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert O.judged(none, O.daily_moments(none)).count() == 0
    one = spark.createDataFrame([(1, "A", T0, 1.0), (2, "A", None, 9.0), (3, "A", T0, None)], SCHEMA)
    assert [r.is_outlier for r in O.judged(one, O.daily_moments(one)).collect()] == [False] * 3
