import datetime as dt
import random


from tickyard.operators import metrics as M


def _brute_gaps(times, t_ms, as_of_ms):
    out = []
    ts = sorted(times)
    for a, b in zip(ts, ts[1:] + [as_of_ms]):
        if b - a > t_ms:
            out.append((a, b))
    return out


def test_silence_gaps_match_brute_force(spark):
    rnd = random.Random(7)
    base = 1_704_067_200_000
    times = {"A": [], "B": []}
    for s in times:
        t = base
        for _ in range(400):
            t += rnd.choice([1_000, 30_000, 60_000, 600_001, 599_999, 3_600_000])
            times[s].append(t)
    rows = [(s, dt.datetime.fromtimestamp(t / 1000, tz=dt.timezone.utc).replace(tzinfo=None))
            for s, ts in times.items() for t in ts]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp")
    as_of = "2024-03-01 00:00:00"
    as_of_ms = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    got = sorted((r.symbol, r.gap_start_ms, r.gap_end_ms)
                 for r in M.silence_gaps(df, "10 minutes", as_of=as_of).collect())
    want = sorted((s, a, b) for s, ts in times.items() for a, b in _brute_gaps(ts, 600_000, as_of_ms))
    assert got == want


def test_histogram_quantile_interpolates(spark):
    # 100 samples: 50 at 0.003 s, 50 at 0.2 s -> p95 in (0.1, 0.25] bucket
    rows = [("A", 0, 3)] * 50 + [("A", 0, 200)] * 50
    df = spark.createDataFrame(rows, "symbol string, timestamp bigint, processed_at bigint")
    h = M.latency_histogram(df)
    q = M.histogram_quantile(h, 0.95).first().quantile
    assert abs(q - (0.1 + 0.15 * (95 - 50) / 50)) < 1e-12
    q50 = M.histogram_quantile(h, 0.5).first().quantile
    assert abs(q50 - 0.005) < 1e-12 or 0.001 <= q50 <= 0.005


def test_gap_fill_carries_close(spark):
    t0 = dt.datetime(2024, 1, 1, 0)
    bars = spark.createDataFrame(
        [("A", t0, 1.0, 2.0, 0.5, 1.5, 10.0, 3), ("A", t0 + dt.timedelta(hours=3), 2.0, 2.0, 2.0, 2.0, 1.0, 1)],
        "symbol string, window_start timestamp, open_price double, high_price double, low_price double, "
        "close_price double, total_volume double, trade_count bigint")
    g = M.gap_fill(bars, "1 hour").orderBy("window_start").collect()
    assert [r.close_price for r in g] == [1.5, 1.5, 1.5, 2.0]
    assert [r.is_filled for r in g] == [False, True, True, False]
    assert [r.total_volume for r in g] == [10.0, 0.0, 0.0, 1.0]


def test_threshold_alert_needs_consecutive_slots(spark):
    t0 = dt.datetime(2024, 1, 1, 0)
    rows = []
    for h, n in [(0, 20), (1, 20), (2, 5), (3, 20), (4, 20), (5, 20)]:
        rows += [(t0 + dt.timedelta(hours=h, seconds=i),) for i in range(n)]
    df = spark.createDataFrame(rows, "event_time timestamp")
    a = M.threshold_alerts(M.slot_counts(df, "1 hour"), 10, 3).collect()
    assert [(r.n_slots, r.n_events) for r in a] == [(3, 60)]


def test_gap_fill_carries_across_empty_blocks(spark):
    t0 = dt.datetime(2024, 1, 1, 22)
    bars = spark.createDataFrame(
        [("A", t0, 1.0, 1.0, 1.0, 1.0, 1.0, 1), ("A", t0 + dt.timedelta(hours=30), 3.0, 3.0, 3.0, 3.0, 1.0, 1)],
        "symbol string, window_start timestamp, open_price double, high_price double, low_price double, "
        "close_price double, total_volume double, trade_count bigint")
    g = M.gap_fill(bars, "1 hour").orderBy("window_start").collect()
    assert len(g) == 31
    assert all(r.close_price == 1.0 for r in g[:-1]) and g[-1].close_price == 3.0
    assert sum(r.is_filled for r in g) == 29


def test_threshold_alert_chains_across_blocks(spark):
    t0 = dt.datetime(2024, 1, 1, 0)
    rows = []
    for h, n in [(0, 20), (1, 20), (2, 20), (3, 20), (4, 20), (5, 5), (6, 20), (7, 20)]:
        rows += [(t0 + dt.timedelta(hours=h, seconds=i),) for i in range(n)]
    df = spark.createDataFrame(rows, "event_time timestamp")
    counts = M.slot_counts(df, "1 hour")
    small = sorted((r.n_slots, r.n_events) for r in M.threshold_alerts(counts, 10, 2, block_slots=2).collect())
    big = sorted((r.n_slots, r.n_events) for r in M.threshold_alerts(counts, 10, 2).collect())
    assert small == big == [(2, 40), (5, 100)]


def test_sliding_rate_alert_matches_brute_force(spark):
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    secs = sorted(rnd.randrange(0, 6 * 3600) for _ in range(3000))
    secs += [7200 + i for i in range(0, 1200, 2)]  # a burst
    df = spark.createDataFrame([(t0 + dt.timedelta(seconds=x),) for x in secs], "event_time timestamp")
    got = sorted((int(r.first_slot.timestamp()), r.n_slots) for r in
                 M.rate_alerts(df, 0.5, "5 minutes", 300, 5, slide="1 minute").collect())
    # brute force: windows [m, m+5min) for every minute m, count > 150, runs of >= 5 minutes
    base = int(t0.replace(tzinfo=dt.timezone.utc).timestamp())
    counts = {}
    for x in secs:
        m = x // 60
        for start in range(m - 4, m + 1):
            counts[start] = counts.get(start, 0) + 1
    hot = sorted(m for m, c in counts.items() if c > 150)
    runs, cur = [], []
    for m in hot:
        if cur and m == cur[-1] + 1:
            cur.append(m)
        else:
            if cur:
                runs.append(cur)
            cur = [m]
    if cur:
        runs.append(cur)
    want = sorted((base + r[0] * 60, len(r)) for r in runs if len(r) >= 5)
    assert got == want and want


def test_quantile_in_inf_bucket_returns_largest_finite_bound(spark):
    rows = [("A", 0, 5000)] * 10  # 5 s latency: beyond the last finite bound (1.0 s)
    df = spark.createDataFrame(rows, "symbol string, timestamp bigint, processed_at bigint")
    q = M.histogram_quantile(M.latency_histogram(df), 0.95).first().quantile
    assert q == 1.0


def test_message_counts_by_window(spark):
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [(t0, True), (t0 + dt.timedelta(seconds=30), False), (t0 + dt.timedelta(minutes=1), True)]
    df = spark.createDataFrame(rows, "received_at timestamp, is_valid boolean")
    got = sorted((r.window_start, r.n_received, r.n_sent, r.n_rejected)
                 for r in M.message_counts(df, "1 minute").collect())
    assert got == [(t0, 2, 1, 1), (t0 + dt.timedelta(minutes=1), 1, 1, 0)]
