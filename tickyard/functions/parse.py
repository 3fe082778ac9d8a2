"""Message parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import ENVELOPE, TRADE_V1_ID
from .columns import epoch_ms_to_ts


_CORRUPT = "_corrupt_record"


def parse_messages(rows: DataFrame, schema: StructType = TRADE_V1_ID,
                   keep_broker_time: bool = True) -> DataFrame:
    """Broker rows (key, value, timestamp) -> typed trade columns.

    ``from_json`` is PERMISSIVE: a malformed message becomes a row of NULLs,
    so ``_parse_ok`` tells a real message from such a row (route the rest to
    the dead-letter table).  The flag comes from the parser's own corrupt-record
    column (set for malformed text and for fields of the wrong type), so each
    message is parsed once.  ``event_time`` comes from the epoch-ms field.
    """
    text = F.col("value").cast("string")
    with_bad = StructType(schema.fields + [StructField(_CORRUPT, StringType())])
    parsed = F.from_json(text, with_bad, {"columnNameOfCorruptRecord": _CORRUPT})
    # The parsed struct is produced by a one-to-one ``inline`` so that a later
    # filter on ``_parse_ok`` is not pushed below it with the parser inlined
    # (which would parse every message again inside the filter).
    rows = rows.select(*rows.columns, F.inline(F.array(F.struct(parsed.alias("_m")))))
    msg = F.col("_m")
    ok = msg.isNotNull() & msg.getField(_CORRUPT).isNull()
    cols = [msg.getField(f.name).alias(f.name) for f in schema.fields]
    if keep_broker_time and "timestamp" in rows.columns:
        cols.append(F.col("timestamp").alias("kafka_timestamp"))
    out = rows.select(*cols, ok.alias("_parse_ok"))
    if "timestamp" in schema.fieldNames():
        out = out.withColumn("event_time", epoch_ms_to_ts("timestamp"))
    return out


def content_id(columns=(), symbol="symbol", timestamp="timestamp", price="price", volume="volume") -> Column:
    """Deterministic id from all that the trade's message said (same input, same
    id): the four fields and those of ``conditions``, ``processed_at`` and
    ``extra`` that are among ``columns``, a map by its sorted entries.  Broker
    positions are no part of it: a message delivered again keeps its id."""
    sent = {"conditions": lambda c: F.to_json(c), "processed_at": lambda c: c.cast("string"),
            "extra": lambda c: F.to_json(F.sort_array(F.map_entries(c)))}
    more = [F.coalesce(text(F.col(name)), F.lit("")) for name, text in sent.items() if name in columns]
    return F.sha2(F.concat_ws(":", F.col(symbol).cast("string"), F.col(timestamp).cast("string"),
                              F.col(price).cast("string"), F.col(volume).cast("string"), *more), 256)


def fill_event_id(df: DataFrame, col: str = "event_id") -> DataFrame:
    """Keep the producer's id, else derive one from the content.

    A content hash instead of a random UUID: replays and plan rebuilds give
    the same id, so dedupe and keyed upserts stay idempotent.  Trades that
    differ in any field that was sent are different trades.
    """
    return df.withColumn(col, F.coalesce(F.col(col), content_id(df.columns)))


def flatten_envelopes(env: DataFrame, value_col: str = "value",
                      processed_at: Column | None = None) -> DataFrame:
    """Feed envelopes (JSON text or struct) -> one trade row per tick.

    Only envelopes of type 'trade' are kept; s,p,t,v,c become
    symbol, price, timestamp, volume, conditions (missing c -> []).
    """
    if value_col in env.columns and dict(env.dtypes)[value_col] in ("string", "binary"):
        e = F.from_json(F.col(value_col).cast("string"), ENVELOPE)
    else:
        e = F.struct(F.col("type"), F.col("data"))
    stamp = F.unix_millis(F.current_timestamp()) if processed_at is None else processed_at
    return (env.select(e.alias("e"))
            .filter(F.col("e.type") == "trade")
            .select(F.explode("e.data").alias("d"))
            .select(F.col("d.s").alias("symbol"), F.col("d.p").alias("price"),
                    F.col("d.t").alias("timestamp"), F.col("d.v").alias("volume"),
                    F.coalesce(F.col("d.c"), F.array().cast("array<string>")).alias("conditions"),
                    stamp.alias("processed_at")))


# Feed tick field -> message field (fixed values).
TICK_FIELDS = {"s": "symbol", "p": "price", "v": "volume", "t": "timestamp", "c": "conditions"}


def envelope_messages(env: DataFrame, value_col: str = "value",
                      processed_at: Column | None = None) -> DataFrame:
    """S4 for the validator: feed envelopes (JSON text) -> one raw JSON trade
    message per tick, with the tick values exactly as sent (a price sent as
    "150.5" stays text, a null stays null, an absent field stays absent), so
    ``quality.validate`` judges what the feed sent.  ``conditions`` defaults
    to [] and ``processed_at`` (epoch ms, default: now) is stamped.

    Output: ``key`` (the tick's symbol as text) and ``value`` (the message).
    """
    v = F.try_parse_json(F.col(value_col).cast("string"))
    ticks = (env.select(v.alias("_e"))
             .filter(F.try_variant_get("_e", "$.type", "string") == "trade")
             .select(F.explode(F.try_variant_get("_e", "$.data", "array<variant>")).alias("_d")))
    stamp = F.unix_millis(F.current_timestamp()) if processed_at is None else processed_at
    fields = []
    for src, dst in TICK_FIELDS.items():
        f = F.try_variant_get("_d", f"$.{src}", "variant")
        if dst == "conditions":
            f = F.coalesce(f, F.parse_json(F.lit("[]")))
        fields.append(f.alias(dst))
    return ticks.select(F.try_variant_get("_d", "$.s", "string").alias("key"),
                        F.to_json(F.struct(*fields, stamp.alias("processed_at"))).alias("value"))
