"""Registered streaming queries: bounded replays of the events table.

Each query writes the trades as time-ordered message files (every message
delivered three times: the original, an immediate redelivery and one three
days late), runs the streaming job with ``availableNow`` and one file per
micro-batch, and returns a batch read of what the sink holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import quality as Q
from ..operators.tables import read_table
from ..session import fresh_dir
from ..sources.adapters import dirty_from_events, message_rows
from ..sources.tables import table
from ..streaming import jobs as J
from ..streaming.sources import file_stream
from .catalog import ORDER_SQL, SQL_EV_TRADES, bars_out, ev_trades, register, sql_bars
from .q_quality import _DIRTY, AS_OF, SQL_FIELDS, fields_out
from .replay import write_message_files

SLICES = 8
DELAY = "5 minutes"

# Stream event time is the message's epoch-ms timestamp (ms grain).
_SQL_STREAM_TRADES = SQL_EV_TRADES.replace(
    "ts AS event_time", "make_timestamp((epoch_us(ts) // 1000) * 1000) AS event_time")


def replay_files(spark: SparkSession, sf_dir: str) -> str:
    rows = message_rows(ev_trades(spark, sf_dir))
    again = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))
    late = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 3 DAYS"))
    path = fresh_dir(spark, "replay")
    write_message_files(rows.unionByName(again).unionByName(late), path, SLICES)
    return path


def replay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_stream(spark, replay_files(spark, sf_dir), max_files_per_trigger=1)


def _run(q) -> None:
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


@register("stream_dedupe", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT event_id, symbol, price, volume, "timestamp" FROM t""")
def stream_dedupe(spark, sf_dir):
    """S1 + P2 + U1/W7: at-least-once delivery replayed, each trade kept once."""
    src = replay_stream(spark, sf_dir)
    out, ck = fresh_dir(spark, "sink"), fresh_dir(spark, "checkpoints")
    t = J.trades_stream(src, DELAY).select("event_id", "symbol", "price", "volume", "timestamp",
                                           "trade_date")
    _run(J.start_append(t, out, ck, available_now=True))
    return spark.read.parquet(out).select("event_id", "symbol", "price", "volume", "timestamp")


@register("stream_bars_append", f"""
WITH b AS ({sql_bars(_SQL_STREAM_TRADES, "hour", ORDER_SQL)})
SELECT * FROM b
WHERE window_end <= (SELECT CAST(max(epoch_us(ts) // 1000) AS BIGINT) - 300000 FROM events)""")
def stream_bars_append(spark, sf_dir):
    """Hourly bars in append mode; windows the final watermark has
    not closed are not emitted, late redeliveries are dropped."""
    src = replay_stream(spark, sf_dir)
    out, ck = fresh_dir(spark, "sink"), fresh_dir(spark, "checkpoints")
    bars = J.bars_stream(J.trades_stream(src, DELAY), "1 hour")
    _run(J.start_append(bars, out, ck, partition_col="trade_date", available_now=True))
    return bars_out(spark.read.parquet(out))


@register("stream_bars_update", sql_bars(_SQL_STREAM_TRADES, "hour", ORDER_SQL))
def stream_bars_update(spark, sf_dir):
    """W4 + K1/K2 in foreachBatch: update-mode bars upserted by key; the table
    ends equal to the batch bars, open windows included."""
    src = replay_stream(spark, sf_dir)
    tbl, ck = fresh_dir(spark, "tables"), fresh_dir(spark, "checkpoints")
    bars = J.bars_stream(J.trades_stream(src, DELAY), "1 hour")
    _run(J.start_upsert(bars, tbl, ("trade_date", "symbol", "window_start"), "trade_date", ck,
                        output_mode="update", available_now=True))
    return bars_out(read_table(spark, tbl))


@register("publish_messages", _DIRTY + """
SELECT sym AS "key", CASE m WHEN 16 THEN 'derived 64' ELSE CAST(event_id AS VARCHAR) END AS event_id,
       sym AS symbol, price, volume,
       ts_ms AS "timestamp"
FROM v WHERE errors = ''""")
def publish_messages(spark, sf_dir):
    """D9 + K3: valid messages published keyed by symbol, read back."""
    raw = dirty_from_events(table(spark, sf_dir, "events"), AS_OF)
    good = Q.valid_trades(Q.validate(raw, as_of=AS_OF))
    path = fresh_dir(spark, "topic")
    J.publish(good.drop("event_time"), path=path)
    msgs = spark.read.schema("key STRING, value STRING").json(path)
    body = F.from_json("value", "event_id STRING, symbol STRING, price DOUBLE, volume DOUBLE, "
                                "timestamp BIGINT")
    derived = F.concat(F.lit("derived "), F.length("event_id").cast("string"))
    return msgs.select("key", body.alias("m")).select("key", "m.*").withColumn(
        "event_id", F.when(F.length("event_id") == 64, derived).otherwise(F.col("event_id")))


@register("stream_trades_table", f"""
WITH t AS ({_SQL_STREAM_TRADES})
SELECT event_id, symbol, price, volume, "timestamp", strftime(event_time, '%Y-%m-%d') AS trade_date,
       CAST(hour(event_time) AS INTEGER) AS trade_hour, strftime(event_time, '%Y%m%d') AS date_bucket,
       CASE WHEN volume > 1000 THEN 'high_volume' ELSE 'normal_volume' END AS price_change_indicator
FROM t""")
def stream_trades_table(spark, sf_dir):
    """W6 + K1 in foreachBatch: the ingest job's two queries over one replayed
    source; the raw trade table ends with every trade once."""
    src = replay_stream(spark, sf_dir)
    tbl, bars_path, dlq, ck = (fresh_dir(spark, k) for k in ("tables", "sink", "dlq", "checkpoints"))
    for q in J.start_ingest(src, tbl, bars_path, dlq, ck, every="1 hour", delay=DELAY, available_now=True,
                            buckets=4):
        _run(q)
    t = read_table(spark, tbl)
    return t.select("event_id", "symbol", "price", "volume", "timestamp",
                    F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"), "trade_hour",
                    "date_bucket", "price_change_indicator")


@register("stream_routed", _DIRTY + f"""
SELECT {SQL_FIELDS} FROM v WHERE errors = ''""")
def stream_routed(spark, sf_dir):
    """D1-D11 as a streaming job: raw messages replayed from files, each
    micro-batch validated once and routed to the main and dead-letter sinks;
    returns the main sink (the valid, normalized trades)."""
    raw = dirty_from_events(table(spark, sf_dir, "events"), AS_OF)
    rows = raw.select(F.col("event_id").cast("string").cast("binary").alias("key"),
                      F.col("value").cast("binary").alias("value"),
                      F.col("received_at").alias("timestamp"))
    path = fresh_dir(spark, "replay")
    write_message_files(rows, path, SLICES)
    src = file_stream(spark, path, max_files_per_trigger=1) \
        .select(F.col("value").cast("string").alias("value"))
    main, dlq, ck = fresh_dir(spark, "sink"), fresh_dir(spark, "dlq"), fresh_dir(spark, "checkpoints")
    _run(J.start_validated_routing(src, main, dlq, ck, as_of=AS_OF, available_now=True))
    return fields_out(spark.read.parquet(main))


_INGEST = f"""
WITH t AS (SELECT *, CAST(event_id AS BIGINT) % 10 AS m FROM ({_SQL_STREAM_TRADES})),
good AS (SELECT * FROM t WHERE m NOT IN (1, 2)),
b AS ({sql_bars("SELECT * FROM good", "hour", ORDER_SQL).replace("WITH t AS", "WITH t2 AS").replace("FROM t GROUP", "FROM t2 GROUP")})
SELECT 'trade' AS kind, event_id, symbol, price, volume, "timestamp", '' AS errors, '' AS error_type FROM good
UNION ALL
SELECT 'bar', '', symbol, close_price, total_volume, window_start, '', '' FROM b
WHERE window_end <= (SELECT max("timestamp") FROM good) - 300000
UNION ALL
SELECT 'dead', event_id, symbol, price, volume, 0,
       CASE m WHEN 1 THEN 'message_not_json' ELSE 'missing_timestamp' END,
       CASE m WHEN 1 THEN 'PARSING_ERROR' ELSE 'VALIDATION_ERROR' END FROM t WHERE m IN (1, 2)"""


@register("stream_ingest_job", _INGEST)
def stream_ingest_job(spark, sf_dir):
    """W6 + D9 + D11: the whole ingest job over a replay in which of ten messages
    one is cut off, one has no timestamp and one sends its price as text; every
    message ends as a trade or as a dead letter, and bars hold the trades."""
    t = ev_trades(spark, sf_dir)
    m = F.pmod(F.col("event_id").cast("bigint"), F.lit(10))
    names = ["event_id", "symbol", "price", "volume", "timestamp", "conditions", "processed_at"]
    body = F.to_json(F.struct(*names))
    value = (F.when(m == 1, F.concat(F.lit("{"), F.concat_ws("|", "event_id", "symbol", F.col("price").cast("string"),
                                                             F.col("volume").cast("string"))))
             .when(m == 2, F.to_json(F.struct(*[n for n in names if n != "timestamp"])))
             .when(m == 3, F.to_json(F.struct(*[F.col("price").cast("string").alias("price") if n == "price"
                                                else F.col(n) for n in names])))
             .otherwise(body))
    rows = t.select(F.col("symbol").cast("binary").alias("key"), value.cast("binary").alias("value"),
                    F.col("event_time").alias("timestamp"))
    path = fresh_dir(spark, "replay")
    write_message_files(rows, path, SLICES)
    tbl, bars_path, dlq, ck = (fresh_dir(spark, k) for k in ("tables", "sink", "dlq", "checkpoints"))
    for q in J.start_ingest(file_stream(spark, path, max_files_per_trigger=2), tbl, bars_path, dlq, ck,
                            every="1 hour", delay=DELAY, available_now=True):
        _run(q)
    none = F.lit("")
    trades = read_table(spark, tbl).select(F.lit("trade").alias("kind"), "event_id", "symbol", "price", "volume",
                                           "timestamp", none.alias("errors"), none.alias("error_type"))
    bars = spark.read.parquet(bars_path).select(
        F.lit("bar"), none, "symbol", "close_price", "total_volume", F.unix_millis("window_start"), none, none)
    cut = F.split(F.substring("original", 2, 1000), "\\|")
    sent = F.from_json("original", "event_id STRING, symbol STRING, price DOUBLE, volume DOUBLE")
    broken = F.col("error_type") == "PARSING_ERROR"
    dead = spark.read.parquet(dlq).select(
        F.lit("dead"), F.when(broken, cut[0]).otherwise(sent["event_id"]),
        F.when(broken, cut[1]).otherwise(sent["symbol"]),
        F.when(broken, cut[2].try_cast("double")).otherwise(sent["price"]),
        F.when(broken, cut[3].try_cast("double")).otherwise(sent["volume"]),
        F.lit(0).cast("bigint"), "error_reasons", "error_type")
    return trades.union(bars).union(dead)
