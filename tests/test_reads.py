"""Read queries on hand-written rows: boundaries, ties and limits."""

import datetime as dt

from pyspark.sql import functions as F

from tickyard.operators import reads as R

T0 = dt.datetime(2024, 1, 30, 23, 0)
SCHEMA = "event_id string, symbol string, price double, volume double, timestamp bigint, event_time timestamp"


def _trades(spark, rows):
    out = []
    for i, (sym, minutes, price) in enumerate(rows):
        t = T0 + dt.timedelta(minutes=minutes)
        ms = int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        out.append((str(i), sym, price, 1.0, ms, t))
    return spark.createDataFrame(out, SCHEMA)


def test_last_hour_bounds(spark):
    t = _trades(spark, [("A", 0, 1.0), ("A", 1, 2.0), ("A", 60, 3.0), ("A", 61, 4.0)])
    got = sorted(r.price for r in R.last_hour(t, "2024-01-31 00:00:00").collect())
    assert got == [2.0, 3.0]  # (as_of - 1h, as_of]


def test_recent_trades_order_and_limit(spark):
    t = _trades(spark, [("A", m, float(m)) for m in range(10)] + [("B", 5, 99.0)])
    got = [r.price for r in R.recent_trades(t, "A", "2024-01-30", 0, 3).collect()]
    assert got == [9.0, 8.0, 7.0]


def test_latest_price_one_row_per_symbol_and_filter(spark):
    t = _trades(spark, [("A", 1, 1.0), ("A", 5, 5.0), ("B", 3, 3.0), ("C", 9, 9.0)])
    got = {r.symbol: r.price for r in R.latest_price(t, ["A", "B"]).collect()}
    assert got == {"A": 5.0, "B": 3.0}


def test_top_n_latest_across_symbols(spark):
    t = _trades(spark, [("A", 1, 1.0), ("B", 2, 2.0), ("A", 3, 3.0), ("C", 4, 4.0)])
    got = [r.price for r in R.top_n_latest(t, ["A", "B"], 2).collect()]
    assert got == [3.0, 2.0]


def test_bar_reads(spark):
    bars = spark.createDataFrame(
        [("A", T0 + dt.timedelta(hours=h), 10.0 * h, float(h), 1) for h in range(-3, 1)] +
        [("B", T0, 100.0, 7.0, 1)],
        "symbol string, window_start timestamp, total_volume double, avg_price double, trade_count bigint")
    rng = R.bars_range(bars, "A", T0 - dt.timedelta(hours=2), T0)
    assert [r.avg_price for r in rng.collect()] == [0.0, -1.0, -2.0]
    top = R.top_volume(bars, "2024-01-31 00:00:00", hours=2, n=1).collect()
    assert [(r.symbol, r.total_volume) for r in top] == [("B", 100.0)]
    trend = R.price_trend(bars, ["A"], n=2, since=T0 - dt.timedelta(hours=10)).collect()
    assert [r.avg_price for r in trend] == [0.0, -1.0]
    assert R.row_total(bars).first().n_rows == 5
    assert R.preview(bars, 2).count() == 2
