"""Registered bar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import notional, with_trade_time
from ..operators import bars as B
from .catalog import (ORDER_SQL, SQL_EV_TRADES, SQL_LI_TRADES, bars_out, ev_trades,
                      li_trades, ms, r6, register, sql_bars, sql_ms, sql_r6)


@register("ohlcv_1h", sql_bars(SQL_EV_TRADES, "hour", ORDER_SQL))
def ohlcv_1h(spark, sf_dir):
    """Flagship: hourly OHLCV + volatility + VWAP bars over events."""
    return bars_out(B.ohlcv_bars(ev_trades(spark, sf_dir), "1 hour"))


@register("ohlcv_daily_lineitem", sql_bars(SQL_LI_TRADES, "day", ORDER_SQL))
def ohlcv_daily_lineitem(spark, sf_dir):
    """Daily bars over lineitem trades: time and arrival tie, the id decides."""
    return bars_out(B.ohlcv_bars(li_trades(spark, sf_dir), "1 day"))


@register("bars_trade_time", f"""
SELECT symbol, window_start, window_start AS trade_time, trade_count
FROM ({sql_bars(SQL_EV_TRADES, "hour", ORDER_SQL)})""")
def bars_trade_time(spark, sf_dir):
    """Bars for the sink, ``trade_time`` beside the window's start."""
    bars = with_trade_time(B.ohlcv_bars(ev_trades(spark, sf_dir), "1 hour"))
    return bars.select("symbol", ms("window_start").alias("window_start"), ms("trade_time").alias("trade_time"),
                       "trade_count")


_TIED = f"SELECT * REPLACE (date_trunc('hour', event_time) AS event_time) FROM ({SQL_EV_TRADES})"


@register("ohlcv_tied_1d", sql_bars(_TIED, "day", ORDER_SQL))
def ohlcv_tied_1d(spark, sf_dir):
    """B2, default order: all trades of an hour share one time, arrival decides."""
    tied = ev_trades(spark, sf_dir).withColumn("event_time", F.date_trunc("hour", "event_time"))
    return bars_out(B.ohlcv_bars(tied, "1 day"))


@register("basic_bar_1h", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT {sql_ms("date_trunc('hour', event_time)")} AS window_start,
       {sql_ms("date_trunc('hour', event_time) + INTERVAL 1 hour")} AS window_end,
       symbol, {sql_r6('avg(price)')} AS avg_price, max(price) AS max_price,
       min(price) AS min_price, sum(volume) AS total_volume, count(*) AS trade_count
FROM t GROUP BY ALL""")
def basic_bar_1h(spark, sf_dir):
    """B1: G1-style basic bar."""
    b = B.basic_bars(ev_trades(spark, sf_dir), "1 hour")
    return b.select(ms("window_start").alias("window_start"), ms("window_end").alias("window_end"),
                    "symbol", r6("avg_price").alias("avg_price"), "max_price", "min_price",
                    "total_volume", "trade_count")


@register("vwap_1h", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT symbol, {sql_ms("date_trunc('hour', event_time)")} AS window_start,
       {sql_r6('sum(price * volume) / nullif(sum(volume), 0)')} AS vwap,
       {sql_r6('sum(price * volume)')} AS notional
FROM t GROUP BY ALL""")
def vwap_1h(spark, sf_dir):
    """B4 + P11: hourly VWAP and notional (sum of price*volume)."""
    t = ev_trades(spark, sf_dir)
    t = t.withColumn("n", notional())
    return (t.groupBy(F.window("event_time", "1 hour").alias("w"), "symbol")
            .agg(F.try_divide(F.sum("n"), F.sum("volume")).alias("vwap"), F.sum("n").alias("notional"))
            .select("symbol", ms("w.start").alias("window_start"), r6("vwap").alias("vwap"),
                    r6("notional").alias("notional")))


@register("bar_rollup_1d", sql_bars(SQL_EV_TRADES, "day", ORDER_SQL))
def bar_rollup_1d(spark, sf_dir):
    """Q8: hourly bars rolled up to daily bars equal daily bars from raw rows."""
    hourly = B.ohlcv_bars(ev_trades(spark, sf_dir), "1 hour")
    return bars_out(B.rollup_bars(hourly, "1 day"))


@register("global_stats", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT {sql_r6('avg(price)')} AS mean_price, {sql_r6('stddev_samp(price)')} AS stddev_price FROM t""")
def global_stats(spark, sf_dir):
    """Global mean and sample stddev of the price."""
    s = B.global_price_stats(ev_trades(spark, sf_dir))
    return s.select(r6("mean_price").alias("mean_price"), r6("stddev_price").alias("stddev_price"))
