"""Message and table schemas."""

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

# Trade message, version 1 (symbol, price, epoch-ms timestamp, volume, ...).
TRADE_V1 = T.StructType([
    T.StructField("symbol", _S),
    T.StructField("price", _D),
    T.StructField("timestamp", _L),
    T.StructField("volume", _D),
    T.StructField("conditions", T.ArrayType(_S)),
    T.StructField("processed_at", _L),
])

# Same message with the producer-side event id in front.
TRADE_V1_ID = T.StructType([T.StructField("event_id", _S)] + TRADE_V1.fields)

# Version 2 adds six optional fields; their defaults live in functions.columns.conform_v2.
TRADE_V2_EXTRA = [
    T.StructField("exchange", _S),
    T.StructField("trade_id", _S),
    T.StructField("bid_price", _D),
    T.StructField("ask_price", _D),
    T.StructField("is_market_hours", T.BooleanType()),
    T.StructField("metadata", T.MapType(_S, _S)),
]
TRADE_V2 = T.StructType(TRADE_V1.fields + TRADE_V2_EXTRA)

# Raw feed tick and envelope: {"type": "trade", "data": [{s, p, t, v, c}, ...]}.
RAW_TICK = T.StructType([
    T.StructField("s", _S),
    T.StructField("p", _D),
    T.StructField("t", _L),
    T.StructField("v", _D),
    T.StructField("c", T.ArrayType(_S)),
])
ENVELOPE = T.StructType([
    T.StructField("type", _S),
    T.StructField("data", T.ArrayType(RAW_TICK)),
])

# Canonical trade frame used by every operator downstream of parsing.
TRADE_COLUMNS = ["event_id", "symbol", "price", "volume", "timestamp",
                 "event_time", "conditions", "processed_at"]

# Error types of a dead-letter record (fixed values).
DLQ_ERROR_TYPES = ["VALIDATION_ERROR", "PARSING_ERROR", "CASSANDRA_WRITE_ERROR",
                   "TRANSFORMATION_ERROR", "UNKNOWN_ERROR"]
