import datetime as dt

from pyspark.sql import functions as F

from conftest import MEDIUM
from tickyard.operators import bars as B
from tickyard.sources.adapters import trades_from_events, trades_from_lineitem
from tickyard.sources.tables import table


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_repartition_does_not_change_bars(spark):
    t = trades_from_lineitem(table(spark, MEDIUM, "lineitem"))
    cols = ["symbol", "window_start", "open_price", "close_price", "high_price", "low_price", "trade_count"]
    a = B.ohlcv_bars(t, "1 day").select(*cols)
    b = B.ohlcv_bars(t.repartition(17, "price").sortWithinPartitions(F.rand(1)), "1 day").select(*cols)
    assert _rows(a) == _rows(b)


def test_open_close_by_time_then_id(spark):
    ts = dt.datetime(2024, 1, 1, 10, 0)
    rows = [("2", "A", 5.0, 1.0, ts), ("1", "A", 7.0, 1.0, ts),
            ("3", "A", 6.0, 1.0, ts + dt.timedelta(minutes=1))]
    df = spark.createDataFrame(rows, "event_id string, symbol string, price double, volume double, "
                                     "event_time timestamp")
    r = B.ohlcv_bars(df, "1 hour", tie_break="arrival").first()
    assert (r.open_price, r.close_price, r.trade_count) == (7.0, 6.0, 3)
    h = B.ohlcv_bars(df, "1 hour", tie_break="hash").first()  # hash tie-break: close is still the later trade
    assert h.close_price == 6.0 and h.open_price in (5.0, 7.0)


def test_hash_order_plans_hash_aggregate(spark):
    t = trades_from_lineitem(table(spark, MEDIUM, "lineitem"))
    plan = B.ohlcv_bars(t, "1 day", tie_break="hash")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_single_trade_volatility_null_and_zero_volume_vwap(spark):
    ts = dt.datetime(2024, 1, 1, 10, 0)
    df = spark.createDataFrame([("1", "A", 5.0, 0.0, ts)],
                               "event_id string, symbol string, price double, volume double, event_time timestamp")
    r = B.ohlcv_bars(df, "1 minute").first()
    assert r.price_volatility is None and r.vwap is None


def test_rollup_equals_direct(spark):
    t = trades_from_events(table(spark, MEDIUM, "events"))
    direct = B.ohlcv_bars(t, "1 day")
    rolled = B.rollup_bars(B.ohlcv_bars(t, "1 hour"), "1 day")
    key = ["symbol", "window_start"]
    j = direct.alias("d").join(rolled.alias("r"), key)
    assert j.count() == direct.count() == rolled.count()
    for c in ["open_price", "close_price", "high_price", "low_price", "trade_count", "total_volume"]:
        assert j.filter(F.col(f"d.{c}") != F.col(f"r.{c}")).count() == 0, c
    for c in ["avg_price", "price_volatility", "vwap"]:
        assert j.filter(F.abs(F.col(f"d.{c}") - F.col(f"r.{c}")) > 1e-9).count() == 0, c


def test_observe_counts_without_extra_job(spark):
    df, obs = B.row_count(spark.range(123))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 123


def test_rollup_variance_is_stable_at_large_prices(spark):
    import random
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(str(i), "BTC", 1_000_000.0 + rnd.random() * 1e-3, 1.0, base + dt.timedelta(minutes=7 * i))
            for i in range(400)]
    df = spark.createDataFrame(rows, "event_id string, symbol string, price double, volume double, "
                                     "event_time timestamp")
    direct = {r.window_start: r.price_volatility for r in B.ohlcv_bars(df, "1 day").collect()}
    rolled = {r.window_start: r.price_volatility for r in B.rollup_bars(B.ohlcv_bars(df, "1 hour"), "1 day").collect()}
    assert direct.keys() == rolled.keys()
    for k in direct:
        assert abs(direct[k] - rolled[k]) <= 1e-9 * max(direct[k], 1e-12) * 1e3
