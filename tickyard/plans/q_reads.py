"""Registered read and metric queries (Q1-Q8, M1-M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import quality as Q
from ..operators import bars as B
from ..operators import metrics as M
from ..operators import reads as R
from ..operators.tables import write_layout
from ..session import fresh_dir
from ..sources.adapters import dirty_from_events, wide_trades_from_events
from ..sources.tables import table
from .catalog import (ORDER_SQL, SQL_EV_TRADES, bars_out, ev_trades, ms, r6, register, sql_bars,
                      sql_ms, sql_r6)
from .q_quality import _DIRTY, AS_OF

_EV = f"WITH t AS ({SQL_EV_TRADES})"
_OUT = ["event_id", "symbol", "price", "volume", "timestamp"]
_SQL_WIDE = SQL_EV_TRADES.replace("event_type AS symbol", "'U' || CAST(user_id AS VARCHAR) AS symbol")


def _dated(spark, sf_dir):
    return ev_trades(spark, sf_dir).withColumn("trade_date", F.to_date("event_time"))


def _hourly(spark, sf_dir, wide=False):
    t = wide_trades_from_events(table(spark, sf_dir, "events")) if wide else ev_trades(spark, sf_dir)
    return B.ohlcv_bars(t, "1 hour")


def _stored_bars(spark, sf_dir, wide=False):
    """The bar table that the reads run on: written once by day, then only read."""
    path = fresh_dir(spark, "bars")
    bars = _hourly(spark, sf_dir, wide).withColumn("trade_date", F.to_date("window_start"))
    write_layout(bars, "trade_date", cluster=["symbol", "window_start"]).write.partitionBy("trade_date").parquet(path)
    return spark.read.schema(bars.schema).parquet(path)


@register("recent_trades", f"""{_EV}
SELECT event_id, symbol, price, volume, "timestamp" FROM t
WHERE symbol = 'click' AND CAST(event_time AS DATE) = DATE '2024-01-15' AND "timestamp" > 0
ORDER BY "timestamp" DESC, event_id DESC LIMIT 20""")
def recent_trades(spark, sf_dir):
    """Q1: newest 20 trades of one symbol-day."""
    return R.recent_trades(_dated(spark, sf_dir), "click", "2024-01-15", 0, 20).select(*_OUT)


_BARS_SQL = sql_bars(SQL_EV_TRADES, "hour", ORDER_SQL)


@register("bars_range", f"""
SELECT * FROM ({_BARS_SQL}) b
WHERE symbol = 'view' AND window_start BETWEEN {sql_ms("TIMESTAMP '2024-01-10 00:00:00'")}
  AND {sql_ms("TIMESTAMP '2024-01-12 23:00:00'")}
ORDER BY window_start DESC LIMIT 24""")
def bars_range(spark, sf_dir):
    """Q2: one symbol's hourly bars in a range, newest 24."""
    b = R.bars_range(_stored_bars(spark, sf_dir), "view", "2024-01-10 00:00:00", "2024-01-12 23:00:00", 24)
    return bars_out(b)


@register("latest_price", f"""
WITH t AS ({_SQL_WIDE})
SELECT symbol, arg_max(price, row(event_time, event_id)) AS price,
       arg_max("timestamp", row(event_time, event_id)) AS "timestamp",
       arg_max(event_id, row(event_time, event_id)) AS event_id
FROM t GROUP BY symbol""")
def latest_price(spark, sf_dir):
    """Q3: last price of every symbol (one symbol per user: many symbols)."""
    return R.latest_price(wide_trades_from_events(table(spark, sf_dir, "events")))


@register("top_n_latest", f"""{_EV}
SELECT event_id, symbol, price, volume, "timestamp" FROM t WHERE symbol IN ('click', 'view')
ORDER BY event_time DESC, event_id DESC LIMIT 3""")
def top_n_latest(spark, sf_dir):
    """Q3, literal dashboard form: newest 3 trades of the listed symbols."""
    return R.top_n_latest(ev_trades(spark, sf_dir), ["click", "view"], 3).select(*_OUT)


@register("price_trend", f"""
SELECT window_start, avg_price, symbol FROM ({_BARS_SQL}) b WHERE symbol IN ('click', 'view')
ORDER BY window_start DESC, symbol LIMIT 100""")
def price_trend(spark, sf_dir):
    """Q4: newest 100 (window_start, avg_price, symbol) bars of two symbols."""
    p = R.price_trend(_stored_bars(spark, sf_dir), ["click", "view"], 100)
    return p.select(ms("window_start").alias("window_start"), r6("avg_price").alias("avg_price"), "symbol")


@register("top_volume", f"""
WITH t AS ({_SQL_WIDE})
SELECT symbol, sum(volume) AS total_volume, count(*) AS trade_count FROM t
WHERE date_trunc('hour', event_time) > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
  AND date_trunc('hour', event_time) <= TIMESTAMP '{AS_OF}'
GROUP BY symbol ORDER BY total_volume DESC, symbol LIMIT 10""")
def top_volume(spark, sf_dir):
    """Q5: top 10 symbols by volume over the last 24 hourly bars before as_of."""
    return R.top_volume(_stored_bars(spark, sf_dir, wide=True), AS_OF, hours=24, n=10)


@register("last_hour", f"""{_EV}
SELECT event_id, symbol, price, volume, "timestamp" FROM t
WHERE event_time > TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND event_time <= TIMESTAMP '{AS_OF}'""")
def last_hour(spark, sf_dir):
    """Q6: trades of the last hour before as_of."""
    return R.last_hour(_dated(spark, sf_dir), AS_OF).select(*_OUT)


@register("preview_count", f"""{_EV} SELECT count(*) AS n_rows FROM t""")
def preview_count(spark, sf_dir):
    """Q7: COUNT(*) of the trade table."""
    return R.row_total(ev_trades(spark, sf_dir))


@register("message_rate", f"""{_EV}
SELECT {sql_ms("date_trunc('minute', event_time)")} AS window_start, symbol, count(*) AS n_messages,
       {sql_r6('count(*) / 60.0')} AS rate_per_s
FROM t GROUP BY ALL""")
def message_rate(spark, sf_dir):
    """M1: messages per second per symbol in 1-minute windows."""
    m = M.message_rate(ev_trades(spark, sf_dir))
    return m.select(ms("window_start").alias("window_start"), "symbol", "n_messages",
                    r6("rate_per_s").alias("rate_per_s"))


_BOUNDS = ", ".join(repr(b) for b in M.LATENCY_BUCKETS)
_HIST_SQL = f"""{_EV},
l AS (SELECT symbol, (processed_at - "timestamp") / 1000.0 AS lat FROM t),
b AS (SELECT unnest([{_BOUNDS}, 'inf'::DOUBLE]) AS le),
h AS (SELECT l.symbol, b.le, count(*) FILTER (WHERE l.lat <= b.le) AS cum_count FROM l, b GROUP BY ALL),
s AS (SELECT symbol, count(*) AS n, sum(lat) AS latency_sum FROM l GROUP BY symbol)"""


@register("latency_hist", _HIST_SQL + f"""
SELECT h.symbol, h.le, h.cum_count, s.n, {sql_r6('s.latency_sum')} AS latency_sum
FROM h JOIN s USING (symbol)""")
def latency_hist(spark, sf_dir):
    """M2: cumulative latency histogram per symbol (fixed bounds + Inf)."""
    h = M.latency_histogram(ev_trades(spark, sf_dir))
    return h.select("symbol", "le", "cum_count", "n", r6("latency_sum").alias("latency_sum"))


@register("latency_p95", _HIST_SQL + f""",
hh AS (SELECT h.symbol, h.le, h.cum_count, s.n, 0.95 * s.n AS rnk,
         coalesce(lag(h.le) OVER (PARTITION BY h.symbol ORDER BY h.le), 0.0) AS prev_le,
         coalesce(lag(h.cum_count) OVER (PARTITION BY h.symbol ORDER BY h.le), 0) AS prev_cum
       FROM h JOIN s USING (symbol)),
f AS (SELECT symbol, arg_min(struct_pack(le, prev_le, cum_count, prev_cum, rnk), le) AS x
      FROM hh WHERE cum_count >= rnk AND n > 0 GROUP BY symbol)
SELECT symbol, {sql_r6('''CASE WHEN isinf(x.le) THEN x.prev_le WHEN x.cum_count = x.prev_cum THEN x.le
  ELSE x.prev_le + (x.le - x.prev_le) * (x.rnk - x.prev_cum) / (x.cum_count - x.prev_cum) END''')}
  AS quantile FROM f""")
def latency_p95(spark, sf_dir):
    """M3: p95 latency per symbol interpolated inside the histogram bucket."""
    h = M.latency_histogram(ev_trades(spark, sf_dir))
    return M.histogram_quantile(h, 0.95).select("symbol", r6("quantile").alias("quantile"))


@register("latency_p95_approx", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT symbol, quantile_disc((processed_at - "timestamp") / 1000.0::DOUBLE, 0.95) AS quantile_approx
FROM t GROUP BY symbol""")
def latency_p95_approx(spark, sf_dir):
    """M3, second output: sketch quantile of the raw latencies (its accuracy of
    1/10000 is exact for the few distinct latencies of a symbol here)."""
    return M.latency_quantile_approx(ev_trades(spark, sf_dir), 0.95)


@register("error_rate_alert", _DIRTY + f""",
c AS (SELECT date_trunc('hour', ev.ts) AS slot_start, count(*) AS n,
             CAST(epoch(date_trunc('hour', ev.ts)) AS BIGINT) // 3600 AS slot
      FROM v JOIN events ev USING (event_id) WHERE v.errors <> '' GROUP BY ALL),
br AS (SELECT *, slot - row_number() OVER (ORDER BY slot) AS island FROM c WHERE n > 10)
SELECT {sql_ms('min(slot_start)')} AS first_slot, {sql_ms('max(slot_start)')} AS last_slot,
       count(*) AS n_slots, CAST(sum(n) AS BIGINT) AS n_events
FROM br GROUP BY island HAVING count(*) >= 3""")
def error_rate_alert(spark, sf_dir):
    """M4: rejected messages above 10 per hour for at least 3 hours running."""
    raw = dirty_from_events(table(spark, sf_dir, "events"), AS_OF)
    bad = Q.invalid_rows(Q.validate(raw, as_of=AS_OF))
    a = M.rate_alerts(bad, 10 / 3600, "1 hour", 3600, 3, time_col="received_at")
    return a.select(ms("first_slot").alias("first_slot"), ms("last_slot").alias("last_slot"),
                    "n_slots", "n_events")


@register("error_rate_sliding", _DIRTY + f""",
bad AS (SELECT CAST(epoch(ev.ts) AS BIGINT) // 3600 AS hslot
        FROM v JOIN events ev USING (event_id) WHERE v.errors <> ''),
st AS (SELECT DISTINCT hslot - k AS s FROM bad, range(0, 3) r(k)),
c AS (SELECT st.s, count(*) AS n FROM st JOIN bad ON bad.hslot BETWEEN st.s AND st.s + 2 GROUP BY st.s),
br AS (SELECT *, s - row_number() OVER (ORDER BY s) AS island FROM c WHERE n > 30)
SELECT min(s) * 3600000 AS first_slot, max(s) * 3600000 AS last_slot, count(*) AS n_slots,
       CAST(sum(n) AS BIGINT) AS n_events
FROM br GROUP BY island HAVING count(*) >= 3""")
def error_rate_sliding(spark, sf_dir):
    """M4 with a range rate: rejected messages over 3-hour windows evaluated
    every hour, above 30 for at least 3 consecutive evaluations."""
    raw = dirty_from_events(table(spark, sf_dir, "events"), AS_OF)
    bad = Q.invalid_rows(Q.validate(raw, as_of=AS_OF))
    counts = M.slot_counts(bad, "3 hours", time_col="received_at", slide="1 hour")
    a = M.threshold_alerts(counts, 30, 3)
    return a.select(ms("first_slot").alias("first_slot"), ms("last_slot").alias("last_slot"),
                    "n_slots", "n_events")


@register("silence_gaps", f"""{_EV},
g AS (SELECT symbol, "timestamp" AS gap_start_ms,
        coalesce(lead("timestamp") OVER (PARTITION BY symbol ORDER BY "timestamp"),
                 {sql_ms(f"TIMESTAMP '{AS_OF}'")}) AS gap_end_ms FROM t)
SELECT symbol, gap_start_ms, gap_end_ms, gap_end_ms - gap_start_ms AS gap_ms FROM g
WHERE gap_end_ms - gap_start_ms > 7200000""")
def silence_gaps(spark, sf_dir):
    """M5: silences over 2 hours per symbol, including the open one at as_of."""
    return M.silence_gaps(ev_trades(spark, sf_dir), "2 hours", as_of=AS_OF)


@register("gap_fill", f"""
WITH b AS ({_BARS_SQL}),
sp AS (SELECT symbol, min(window_start) AS lo, max(window_start) AS hi FROM b GROUP BY symbol),
g AS (SELECT symbol, unnest(range(lo, hi + 1, 3600000)) AS window_start FROM sp),
j AS (SELECT g.symbol, g.window_start, b.open_price, b.high_price, b.low_price, b.close_price,
             b.total_volume, b.trade_count,
             last_value(b.close_price IGNORE NULLS) OVER (PARTITION BY g.symbol ORDER BY g.window_start
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried
      FROM g LEFT JOIN b ON g.symbol = b.symbol AND g.window_start = b.window_start)
SELECT symbol, window_start, coalesce(open_price, carried) AS open_price,
       coalesce(high_price, carried) AS high_price, coalesce(low_price, carried) AS low_price,
       coalesce(close_price, carried) AS close_price, coalesce(total_volume, 0.0) AS total_volume,
       CAST(coalesce(trade_count, 0) AS BIGINT) AS trade_count, trade_count IS NULL AS is_filled
FROM j""")
def gap_fill(spark, sf_dir):
    """M6: hourly bar series completed per symbol, close carried forward."""
    g = M.gap_fill(_hourly(spark, sf_dir), "1 hour")
    return g.withColumn("window_start", ms("window_start"))


@register("frame_profile", f"""{_EV} SELECT count(*) AS n_rows, CAST(8 AS INTEGER) AS n_columns FROM t""")
def frame_profile(spark, sf_dir):
    """M7 + B5: rows and columns of the trade frame."""
    return M.frame_profile(ev_trades(spark, sf_dir))


@register("frame_partitions", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT 'rows in partitions' AS fact, CAST(count(*) AS VARCHAR) AS value FROM t
UNION ALL SELECT 'column event_id', 'string' UNION ALL SELECT 'column symbol', 'string'
UNION ALL SELECT 'column price', 'double' UNION ALL SELECT 'column volume', 'double'
UNION ALL SELECT 'column timestamp', 'bigint' UNION ALL SELECT 'column event_time', 'timestamp'
UNION ALL SELECT 'column conditions', 'array<string>' UNION ALL SELECT 'column processed_at', 'bigint'""")
def frame_partitions(spark, sf_dir):
    """M7: the trade frame's schema and its rows, added up over physical
    partitions (how they are split depends on the scan)."""
    t = ev_trades(spark, sf_dir)
    rows = M.partition_sizes(t).agg(F.sum("n_rows").cast("string").alias("value")).select(
        F.lit("rows in partitions").alias("fact"), "value")
    schema = spark.createDataFrame([(f"column {n}", k) for n, k in t.dtypes], "fact string, value string")
    return rows.unionByName(schema)
