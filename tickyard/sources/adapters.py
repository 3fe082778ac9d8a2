"""Adapters from the driver's tables to the trade frame.

The trade frame has the columns of ``schemas.TRADE_COLUMNS``:
``event_id STRING, symbol STRING, price DOUBLE, volume DOUBLE,
timestamp BIGINT (epoch ms), event_time TIMESTAMP, conditions ARRAY<STRING>,
processed_at BIGINT``.  All adapters are pure projections: no shuffle, and
column pruning reaches the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _event_time(ts: Column) -> Column:
    # events.ts is TIMESTAMP_NTZ; the session is UTC (session.use_utc), so the
    # cast keeps the wall-clock value and gives the TIMESTAMP that watermarks need.
    return ts.cast("timestamp")


def trades_from_events(events: DataFrame, symbol_col: str = "event_type") -> DataFrame:
    """events -> trades: symbol = event_type, price = value, volume = props.k.

    ``processed_at`` is ``timestamp + k`` so the ingest latency in ms equals k.
    """
    k = F.get_json_object("props", "$.k").cast("double")
    et = _event_time(F.col("ts"))
    ms = F.unix_millis(et)
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col(symbol_col).cast("string").alias("symbol"),
        F.col("value").alias("price"),
        k.alias("volume"),
        ms.alias("timestamp"),
        et.alias("event_time"),
        F.array().cast("array<string>").alias("conditions"),
        (ms + k.cast("bigint")).alias("processed_at"),
    )


def wide_trades_from_events(events: DataFrame) -> DataFrame:
    """Same as ``trades_from_events`` but one symbol per user (many symbols)."""
    return trades_from_events(
        events.withColumn("event_type", F.concat(F.lit("U"), F.col("user_id").cast("string"))))


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem -> trades with real duplicate ids and day-grain time ties."""
    et = _event_time(F.col("l_shipdate"))
    ms = F.unix_millis(et)
    return lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("event_id"),
        F.col("l_returnflag").alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("volume"),
        ms.alias("timestamp"),
        et.alias("event_time"),
        F.array().cast("array<string>").alias("conditions"),
        ms.alias("processed_at"),
    )


def message_rows(trades: DataFrame) -> DataFrame:
    """Trade frame -> broker-shaped rows (key BINARY, value BINARY, timestamp)."""
    payload = F.struct(*[c for c in ["event_id", "symbol", "price", "timestamp", "volume",
                                     "conditions", "processed_at"]])
    return trades.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.col("event_time").alias("timestamp"),
    )


def envelopes(trades: DataFrame, every: str = "1 second", fanout: int = 8) -> DataFrame:
    """Group ticks into feed envelopes {type, data[]} as a feed would send them.

    One envelope per (symbol, ``every`` window, hash bucket of event_id): its
    size is bounded by one symbol's feed rate per window divided by ``fanout``,
    never by the table size, even for a hot symbol.
    """
    tick = F.struct(
        F.col("symbol").alias("s"), F.col("price").alias("p"),
        F.col("timestamp").alias("t"), F.col("volume").alias("v"),
        F.col("conditions").alias("c"))
    return (trades
            .groupBy(F.window("event_time", every).alias("w"), "symbol",
                     F.pmod(F.xxhash64("event_id"), F.lit(fanout)).alias("part"))
            .agg(F.collect_list(tick).alias("data"))
            .select(F.lit("trade").alias("type"), "data"))


# Mutation applied by dirty_from_events, chosen by event_id % 24 (fixed list):
#  0 valid, JSON numbers             12 volume "1_000" (valid, 1000.0)
#  1 valid, numbers as text          13 timestamp "x"
#  2 valid, ISO-8601 timestamp       14 timestamp as_of - 25 hours
#  3 no symbol key, price null       15 event_id blank
#  4 symbol blank                    16 no event_id (valid, derived)
#  5 symbol lower case               17 no volume
#  6 symbol with trailing newline    18 no timestamp
#  7 symbol of 33 characters         19 volume "many"
#  8 price "<p>d" (not a number)     20 timestamp [1]
#  9 price "NaN"                     21 cut-off message
# 10 price negative                  22 volume "NaN"
# 11 volume negative                 23 timestamp "03:40" (no date)
DIRTY_KINDS = 24


def dirty_from_events(events: DataFrame, as_of: str = "2024-01-31 00:00:00") -> DataFrame:
    """events -> raw JSON trade messages, one rule exercised per row.

    Valid timestamps are placed inside the last day before ``as_of`` (whole
    seconds, derived from the event id) so the range rule only fires where the
    mutation asks for it.  Output: event_id BIGINT, value STRING and the
    broker receive time ``received_at`` (the event's own time).
    """
    m = F.pmod(F.col("event_id"), F.lit(DIRTY_KINDS))
    as_of_ms = F.unix_millis(F.lit(as_of).cast("timestamp"))
    base_ms = as_of_ms - F.pmod(F.col("event_id") * 7919, F.lit(86000)) * 1000
    sym = F.upper(F.col("event_type"))
    k = F.get_json_object("props", "$.k")
    p = F.col("value").cast("string")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    iso = F.date_format(F.timestamp_millis(base_ms), "yyyy-MM-dd'T'HH:mm:ssXXX")
    f_id = (F.when(m == 15, F.lit('"event_id":"  ",')).when(m == 16, F.lit(""))
            .otherwise(F.concat(F.lit('"event_id":'), q(F.col("event_id").cast("string")), F.lit(","))))
    f_sym = (F.when(m == 4, F.lit('"  "'))
              .when(m == 5, q(F.lower(sym)))
              .when(m == 6, F.concat(F.lit('"'), sym, F.lit('\\n"')))
              .when(m == 7, q(F.rpad(sym, 33, "X")))
              .otherwise(q(sym)))
    f_price = (F.when(m == 1, q(p))
                .when(m == 3, F.lit("null"))
                .when(m == 8, q(F.concat(p, F.lit("d"))))
                .when(m == 9, F.lit('"NaN"'))
                .when(m == 10, F.concat(F.lit("-"), p))
                .otherwise(p))
    f_vol = (F.when(m == 1, q(k))
              .when(m == 11, F.concat(F.lit("-"), (k.cast("int") + 1).cast("string")))
              .when(m == 12, F.lit('"1_000"'))
              .when(m == 19, F.lit('"many"'))
              .when(m == 22, F.lit('"NaN"'))
              .otherwise(k))
    f_ts = (F.when(m == 1, q(base_ms.cast("string")))
             .when(m == 2, q(iso))
             .when(m == 13, F.lit('"x"'))
             .when(m == 20, F.lit("[1]"))
             .when(m == 23, F.lit('"03:40"'))
             .when(m == 14, (as_of_ms - 25 * 3600 * 1000).cast("string"))
             .otherwise(base_ms.cast("string")))
    sym_part = F.when(m == 3, F.lit("")).otherwise(F.concat(F.lit('"symbol":'), f_sym, F.lit(",")))
    vol_part = F.when(m == 17, F.lit("")).otherwise(F.concat(F.lit(',"volume":'), f_vol))
    ts_part = F.when(m == 18, F.lit("")).otherwise(F.concat(F.lit(',"timestamp":'), f_ts))
    # fields beside the validated ones: conditions, arrival and one the library does not know
    more = F.concat(F.lit(',"conditions":["c'), m.cast("string"), F.lit('"],"processed_at":'),
                    (base_ms + k.cast("int")).cast("string"), F.lit(',"venue":{"id":'),
                    F.col("event_id").cast("string"), F.lit("}"))
    value = F.concat(F.lit("{"), f_id, sym_part, F.lit('"price":'), f_price, vol_part, ts_part, more,
                     F.when(m == 21, F.lit("")).otherwise(F.lit("}")))
    return events.select("event_id", value.alias("value"),
                         _event_time(F.col("ts")).alias("received_at"))
