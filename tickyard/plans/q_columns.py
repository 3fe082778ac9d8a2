"""Registered projection and parsing queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import parse as P
from ..functions import quality as Q
from ..sources.adapters import envelopes, message_rows
from .catalog import SQL_EV_TRADES, ev_trades, ms, register

_EV = f"WITH t AS ({SQL_EV_TRADES})"


@register("date_buckets", f"""{_EV}
SELECT CAST(event_id AS BIGINT) AS event_id, strftime(event_time, '%Y%m%d') AS bucket_daily,
       strftime(event_time, '%Y%m%d%H') AS bucket_hourly, strftime(event_time, '%Y%m') AS bucket_monthly
FROM t""")
def date_buckets(spark, sf_dir):
    """Daily / hourly / monthly string buckets."""
    t = ev_trades(spark, sf_dir)
    return t.select(F.col("event_id").cast("bigint").alias("event_id"),
                    C.date_bucket("event_time", "daily").alias("bucket_daily"),
                    C.date_bucket("event_time", "hourly").alias("bucket_hourly"),
                    C.date_bucket("event_time", "monthly").alias("bucket_monthly"))


@register("partition_cols", f"""{_EV}
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(year(event_time) AS INTEGER) AS trade_year,
       CAST(month(event_time) AS INTEGER) AS trade_month, CAST(day(event_time) AS INTEGER) AS trade_day,
       CAST(hour(event_time) AS INTEGER) AS trade_hour, strftime(event_time, '%Y-%m-%d') AS trade_date
FROM t""")
def partition_cols(spark, sf_dir):
    """P8 + P9: year/month/day/hour bucket columns and the trade date."""
    t = C.add_partitioning_columns(ev_trades(spark, sf_dir))
    t = C.add_trade_date_hour(t)
    return t.select(F.col("event_id").cast("bigint").alias("event_id"), "trade_year", "trade_month",
                    "trade_day", "trade_hour",
                    F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"))


@register("volume_class", f"""{_EV}
SELECT CAST(event_id AS BIGINT) AS event_id,
       CASE WHEN volume > 50 THEN 'high_volume' ELSE 'normal_volume' END AS price_change_indicator
FROM t""")
def volume_class(spark, sf_dir):
    """Volume class at threshold 50 (volumes here are 0..99)."""
    t = ev_trades(spark, sf_dir)
    return t.select(F.col("event_id").cast("bigint").alias("event_id"),
                    C.volume_class("volume", 50).alias("price_change_indicator"))


_NY = "timezone('America/New_York', event_time AT TIME ZONE 'UTC')"


@register("market_hours", f"""{_EV}
SELECT CAST(event_id AS BIGINT) AS event_id,
       (hour({_NY}) * 60 + minute({_NY})) BETWEEN 570 AND 959 AS is_market_hours,
       (hour({_NY}) * 60 + minute({_NY})) BETWEEN 570 AND 959
         AND dayofweek({_NY}) NOT IN (0, 6) AS is_market_session,
       hour(event_time) >= 9 AND hour(event_time) < 16 AS is_market_hour_utc
FROM t""")
def market_hours(spark, sf_dir):
    """P10: market-hours flags (New York minutes, with weekdays, hour-only)."""
    t = ev_trades(spark, sf_dir)
    return t.select(F.col("event_id").cast("bigint").alias("event_id"),
                    C.market_hours("event_time").alias("is_market_hours"),
                    C.market_hours("event_time", weekdays_only=True).alias("is_market_session"),
                    C.market_hours("event_time", mode="hour").alias("is_market_hour_utc"))


@register("epoch_ms_to_ts", f"""{_EV}
SELECT CAST(event_id AS BIGINT) AS event_id, "timestamp" AS ts_ms,
       strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts_text,
       CAST(epoch_us(make_timestamp("timestamp" * 1000)) // 1000 AS BIGINT) AS ts_roundtrip
FROM t""")
def epoch_ms_to_ts(spark, sf_dir):
    """Epoch ms -> TIMESTAMP, rendered and converted back."""
    t = ev_trades(spark, sf_dir)
    ts = C.epoch_ms_to_ts("timestamp")
    return t.select(F.col("event_id").cast("bigint").alias("event_id"), F.col("timestamp").alias("ts_ms"),
                    F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS").alias("ts_text"),
                    ms(ts).alias("ts_roundtrip"))


@register("parse_messages", f"""{_EV}
SELECT event_id, symbol, price, "timestamp", volume, processed_at, '' AS conditions,
       true AS parse_ok, {"CAST(epoch_us(make_timestamp(\"timestamp\" * 1000)) // 1000 AS BIGINT)"} AS event_time_ms,
       CAST(epoch_us(event_time) // 1000 AS BIGINT) AS broker_time_ms
FROM t""")
def parse_messages(spark, sf_dir):
    """S1 row shape + P1 + P2: broker rows -> typed trades (JSON round trip)."""
    rows = message_rows(ev_trades(spark, sf_dir))
    p = P.parse_messages(rows)
    return p.select("event_id", "symbol", "price", "timestamp", "volume", "processed_at",
                    F.array_join("conditions", ";").alias("conditions"),
                    F.col("_parse_ok").alias("parse_ok"), ms("event_time").alias("event_time_ms"),
                    ms("kafka_timestamp").alias("broker_time_ms"))


@register("flatten_envelope", f"""{_EV}
SELECT symbol, price, "timestamp", volume, '' AS conditions FROM t""")
def flatten_envelope(spark, sf_dir):
    """Feed envelopes (JSON text) -> one row per tick."""
    env = envelopes(ev_trades(spark, sf_dir)).select(F.to_json(F.struct("type", "data")).alias("value"))
    flat = P.flatten_envelopes(env)
    return flat.select("symbol", "price", "timestamp", "volume",
                       F.array_join("conditions", ";").alias("conditions"))


@register("fill_event_id", f"""{_EV}
SELECT sha256(concat_ws(':', symbol, CAST("timestamp" AS VARCHAR), CAST(price AS VARCHAR),
                        CAST(volume AS VARCHAR), '[]', CAST(processed_at AS VARCHAR))) AS event_id,
       CAST(event_id AS BIGINT) AS source_id
FROM t""")
def fill_event_id(spark, sf_dir):
    """Messages without an id get a content hash (stable under replay)."""
    t = ev_trades(spark, sf_dir).withColumn("source_id", F.col("event_id").cast("bigint"))
    t = P.fill_event_id(t.withColumn("event_id", F.lit(None).cast("string")))
    return t.select("event_id", "source_id")


_SENT = ("conditions", "processed_at", "extra")


@register("missing_ids_by_content", f"""{_EV}
SELECT symbol, {len(_SENT) + 1} * count(DISTINCT row("timestamp", price, volume, processed_at)) AS n_trades,
       {len(_SENT) + 1} * count(DISTINCT row("timestamp", price, volume, processed_at)) AS n_ids
FROM t GROUP BY symbol""")
def missing_ids_by_content(spark, sf_dir):
    """P3 on the ingest path: of every trade four messages without an id, which differ in
    one sent field each, stay four trades; a message delivered twice stays one."""
    t = ev_trades(spark, sf_dir)
    base = ["symbol", "price", "volume", "timestamp"]
    stamp = F.col("processed_at")
    sent = [F.to_json(F.struct(*base, stamp.alias("processed_at"))),
            F.to_json(F.struct(*base, stamp.alias("processed_at"), F.array(F.lit("odd lot")).alias("conditions"))),
            F.to_json(F.struct(*base, (stamp + F.lit(1 << 40)).alias("processed_at"))),
            F.to_json(F.struct(*base, stamp.alias("processed_at"), F.lit("ny").alias("venue")))]
    messages = t.select(F.explode(F.array(*sent, sent[0])).alias("value"))
    trades = Q.valid_trades(Q.validate(messages, mode="types"))
    content = F.to_json(F.struct("timestamp", "price", "volume", "processed_at", "conditions",
                                 F.map_entries("extra").alias("extra")))
    return trades.groupBy("symbol").agg(F.countDistinct(content).alias("n_trades"),
                                        F.countDistinct("event_id").alias("n_ids"))


@register("conform_v2", f"""{_EV}
SELECT CAST(event_id AS BIGINT) AS event_id, symbol, CAST(NULL AS VARCHAR) AS exchange,
       CAST(NULL AS VARCHAR) AS trade_id, CAST(NULL AS DOUBLE) AS bid_price,
       CAST(NULL AS DOUBLE) AS ask_price, false AS is_market_hours, CAST(0 AS INTEGER) AS n_metadata
FROM t""")
def conform_v2(spark, sf_dir):
    """v1 rows upgraded to the v2 shape with defaults."""
    t = ev_trades(spark, sf_dir).select("event_id", "symbol", "price", "timestamp", "volume",
                                        "conditions", "processed_at")
    v2 = C.conform_v2(t)
    return v2.select(F.col("event_id").cast("bigint").alias("event_id"), "symbol", "exchange", "trade_id",
                     "bid_price", "ask_price", "is_market_hours",
                     F.size("metadata").alias("n_metadata"))


@register("ingest_stamped", f"""{_EV}
SELECT CAST(event_id AS BIGINT) AS event_id, true AS after_start, true AS one_stamp FROM t""")
def ingest_stamped(spark, sf_dir):
    """P5: the ingest stamp of every trade: not before the query was built, one for all."""
    start = F.lit(_dt.datetime.now(_dt.timezone.utc)).cast("timestamp")
    t = ev_trades(spark, sf_dir).withColumn("spark_processed_at", C.ingest_stamp())
    one = t.agg((F.count_distinct("spark_processed_at") <= 1).alias("one")).scalar()
    return t.select(F.col("event_id").cast("bigint").alias("event_id"),
                    (F.col("spark_processed_at") >= start).alias("after_start"), one.alias("one_stamp"))
