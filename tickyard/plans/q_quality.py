"""Registered data-quality queries (D1-D13) over the dirty-message fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import quality as Q
from ..operators import redrive as RD
from ..session import fresh_dir
from ..sources.adapters import dirty_from_events
from ..sources.tables import table
from .catalog import SQL_EV_TRADES, ev_trades, register

AS_OF = "2024-01-31 00:00:00"
EARLIER = "2024-01-30 22:00:00"

# Expected outcome of each mutation, written as SQL over the source rows.
_DIRTY = f"""
WITH e AS (
  SELECT event_id, event_id % 24 AS m, upper(event_type) AS sym, value AS p,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CAST(epoch_ms(TIMESTAMP '{AS_OF}') AS BIGINT) - ((event_id * 7919) % 86000) * 1000 AS base_ms
  FROM events),
r AS (
  SELECT *,
    CASE m WHEN 8 THEN NULL WHEN 9 THEN CAST('NaN' AS DOUBLE) WHEN 10 THEN -p ELSE p END AS price,
    CASE m WHEN 11 THEN -(CAST(k AS INTEGER) + 1) WHEN 12 THEN 1000.0 WHEN 17 THEN NULL WHEN 19 THEN NULL
           WHEN 22 THEN CAST('NaN' AS DOUBLE) ELSE k END AS volume,
    CASE m WHEN 13 THEN NULL WHEN 18 THEN NULL WHEN 20 THEN NULL WHEN 23 THEN NULL WHEN 14 THEN CAST(epoch_ms(TIMESTAMP '{AS_OF}') AS BIGINT) - 90000000
           ELSE base_ms END AS ts_ms
  FROM e),
v AS (
  SELECT *,
    CASE WHEN m = 21 THEN 'message_not_json'
         WHEN m = 3 THEN 'missing_symbol;missing_price'
         WHEN m = 17 THEN 'missing_volume'
         WHEN m = 18 THEN 'missing_timestamp'
         WHEN m = 4 THEN 'missing_symbol'
         ELSE concat_ws(';',
           CASE WHEN m IN (5, 6, 7) THEN 'symbol_invalid' END,
           CASE WHEN m = 8 THEN 'price_not_number_or_invalid'
                WHEN isnan(price) OR NOT price > 0 THEN 'price_not_positive' END,
           CASE WHEN m = 19 THEN 'volume_not_number_or_invalid' WHEN isnan(volume) THEN 'volume_nan'
                WHEN volume < 0 THEN 'volume_negative' END,
           CASE WHEN m IN (13, 23) THEN 'timestamp_parse_failed'
                WHEN m = 20 THEN 'timestamp_invalid_type'
                WHEN m = 14 THEN 'timestamp_out_of_range' END,
           CASE WHEN m = 15 THEN 'event_id_empty' END)
    END AS errors
  FROM r)"""


def _validated(spark, sf_dir, mode="lenient"):
    raw = dirty_from_events(table(spark, sf_dir, "events"), AS_OF)
    return Q.validate(raw, as_of=AS_OF, mode=mode)


@register("validate_errors", _DIRTY + """
SELECT event_id, errors, errors = '' AS is_valid FROM v""")
def validate_errors(spark, sf_dir):
    """Error codes of every message (';'-joined, rule order)."""
    v = _validated(spark, sf_dir)
    return v.select("event_id", F.array_join("errors", ";").alias("errors"), "is_valid")


# All fields of a valid message; an absent id is derived from the content, whose
# number texts SQL spells otherwise, so that id is compared by its length.
SQL_FIELDS = """CASE m WHEN 16 THEN 'derived 64' ELSE CAST(event_id AS VARCHAR) END AS event_id, sym AS symbol, price,
       volume, ts_ms AS "timestamp", 'c' || m AS conditions, base_ms + CAST(k AS INTEGER) AS processed_at,
       'venue={"id":' || event_id || '}' AS extra, ts_ms AS event_time"""


def fields_out(trades):
    derived = F.concat(F.lit("derived "), F.length("event_id").cast("string"))
    extra = F.array_join(F.transform(F.map_entries("extra"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return trades.select(
        F.when(F.length("event_id") == 64, derived).otherwise(F.col("event_id")).alias("event_id"), "symbol",
        "price", "volume", "timestamp", F.array_join("conditions", ",").alias("conditions"), "processed_at",
        extra.alias("extra"), F.unix_millis("event_time").alias("event_time"))


@register("validate_valid", _DIRTY + f"""
SELECT {SQL_FIELDS} FROM v WHERE errors = ''""")
def validate_valid(spark, sf_dir):
    """D8 + D9 main path + P3: all fields of the valid messages."""
    return fields_out(Q.valid_trades(_validated(spark, sf_dir)))


@register("latency_valid_p95", _DIRTY + """
SELECT CAST(quantile_disc(CAST(k AS INTEGER), 0.95) AS BIGINT) AS p95_ms, count(*) AS n FROM v
WHERE errors = '' AND m NOT IN (14)""")
def latency_valid_p95(spark, sf_dir):
    """M3 on validated trades: their arrival time is still there."""
    t = Q.valid_trades(_validated(spark, sf_dir))
    lat = t.select((F.col("processed_at") - F.col("timestamp")).alias("lat"))
    return lat.agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY lat)").cast("bigint").alias("p95_ms"),
                   F.count("*").alias("n"))


_STRICT = _DIRTY.replace("v AS (", "v0 AS (") + """,
v AS (SELECT *, CASE WHEN m = 21 THEN 'message_not_json'
  WHEN m = 3 THEN 'missing_symbol' WHEN m = 17 THEN 'missing_volume' WHEN m = 18 THEN 'missing_timestamp'
  ELSE concat_ws(';',
    CASE WHEN m = 8 THEN 'price_not_number_or_invalid' WHEN isnan(price) OR NOT price > 0 THEN 'price_not_positive' END,
    CASE WHEN m = 19 THEN 'volume_not_number_or_invalid'
         WHEN isnan(volume) OR NOT volume > 0 THEN 'volume_not_positive' END,
    CASE WHEN m IN (2, 13, 23) THEN 'timestamp_parse_failed' WHEN m = 20 THEN 'timestamp_invalid_type' END) END AS strict
  FROM v0)"""


@register("validate_strict", _STRICT + """
SELECT event_id, strict AS errors, CASE WHEN strict <> '' THEN '' WHEN m = 4 THEN '  ' WHEN m = 5 THEN lower(sym)
  WHEN m = 6 THEN sym || chr(10) WHEN m = 7 THEN rpad(sym, 33, 'X') ELSE sym END AS symbol FROM v""")
def validate_strict(spark, sf_dir):
    """The second validator's own rules; symbols, ids and time range are not judged."""
    v = _validated(spark, sf_dir, mode="strict")
    return v.select("event_id", F.array_join("errors", ";").alias("errors"),
                    F.when(F.col("is_valid"), F.col("norm.symbol")).otherwise("").alias("symbol"))


_STAMP = 1706659200000   # failed_at, given


@register("dlq_records", _DIRTY + f"""
SELECT event_id, errors, errors AS error_reasons, errors AS error_message,
       CASE WHEN m = 21 THEN 'PARSING_ERROR' ELSE 'VALIDATION_ERROR' END AS error_type,
       CAST(NULL AS VARCHAR) AS error_stacktrace, CAST({_STAMP} AS BIGINT) AS dlq_timestamp,
       CAST({_STAMP} AS BIGINT) AS failed_at, CAST(0 AS INTEGER) AS retry_count, 'market' AS source_topic,
       'ticks' AS original_topic, CAST(event_id % 7 AS INTEGER) AS original_partition,
       CAST(event_id * 3 AS BIGINT) AS original_offset, sym AS original_key, 'tickyard' AS processor_id, true AS kept
FROM v WHERE errors <> ''""")
def dlq_records(spark, sf_dir):
    """D9 dead-letter path + D11: all fields, with the message's broker position."""
    raw = dirty_from_events(table(spark, sf_dir, "events"), AS_OF).join(
        table(spark, sf_dir, "events").select("event_id", F.upper("event_type").alias("key")), "event_id")
    raw = raw.withColumns({"topic": F.lit("ticks"), "partition": (F.col("event_id") % 7).cast("int"),
                           "offset": F.col("event_id") * 3})
    bad = Q.invalid_rows(Q.validate(raw, as_of=AS_OF))
    d = Q.dlq_records(bad, source_topic="market", carry=["event_id", "value"],
                      failed_at=F.lit(_STAMP).cast("bigint"))
    return d.select("event_id", F.array_join("errors", ";").alias("errors"), "error_reasons", "error_message",
                    "error_type", "error_stacktrace", "dlq_timestamp", "failed_at", "retry_count", "source_topic",
                    "original_topic", "original_partition", "original_offset", "original_key", "processor_id",
                    ((F.col("original") == F.col("value")) & (F.col("original_value") == F.col("value"))).alias("kept"))


@register("rejections_by_reason", _DIRTY + """
SELECT reason, count(*) AS n_errors
FROM (SELECT unnest(string_split(errors, ';')) AS reason FROM v WHERE errors <> '')
GROUP BY reason""")
def rejections_by_reason(spark, sf_dir):
    """Error counter by reason (a message with two errors counts twice)."""
    return Q.rejection_counts(_validated(spark, sf_dir))


@register("outliers_3s", f"""
WITH t AS ({SQL_EV_TRADES}),
s AS (SELECT avg(price) AS m, stddev_samp(price) AS sd FROM t)
SELECT CAST(t.event_id AS BIGINT) AS event_id, t.symbol, t.price
FROM t, s WHERE s.sd IS NULL OR t.price BETWEEN s.m - 3 * s.sd AND s.m + 3 * s.sd""")
def outliers_3s(spark, sf_dir):
    """D13 + B3: keep rows within 3 global sample stddevs of the mean."""
    kept = Q.filter_outliers(ev_trades(spark, sf_dir), "price", 3.0)
    return kept.select(F.col("event_id").cast("bigint").alias("event_id"), "symbol", "price")


@register("rejection_totals", _DIRTY + """
SELECT count(*) AS n_messages, count(*) FILTER (WHERE errors <> '') AS n_rejected,
       CAST(sum(CASE WHEN errors = '' THEN 0
                     ELSE length(errors) - length(replace(errors, ';', '')) + 1 END) AS BIGINT) AS n_errors
FROM v""")
def rejection_totals(spark, sf_dir):
    """Message, dead-letter and error counters."""
    return Q.rejection_totals(_validated(spark, sf_dir))


@register("message_counts", _DIRTY + """
SELECT CAST(epoch_us(date_trunc('hour', ev.ts)) // 1000 AS BIGINT) AS window_start,
       count(*) AS n_received, count(*) FILTER (WHERE v.errors = '') AS n_sent,
       count(*) FILTER (WHERE v.errors <> '') AS n_rejected
FROM v JOIN events ev USING (event_id) GROUP BY ALL""")
def message_counts(spark, sf_dir):
    """M1: received / sent / rejected messages per hour of arrival."""
    from ..operators.metrics import message_counts as mc
    c = mc(_validated(spark, sf_dir), "1 hour")
    return c.select(F.unix_millis("window_start").alias("window_start"), "n_received", "n_sent",
                    "n_rejected")


@register("route_envelopes", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT upper(symbol) AS "key", "timestamp",
       concat_ws(';',
         CASE WHEN isnan(price) OR NOT price > 0 THEN 'price_not_positive' END,
         CASE WHEN volume < 0 THEN 'volume_negative' END,
         CASE WHEN "timestamp" < CAST(epoch_ms(TIMESTAMP '{AS_OF}') AS BIGINT) - 86400000
                OR "timestamp" > CAST(epoch_ms(TIMESTAMP '{AS_OF}') AS BIGINT) + 300000
              THEN 'timestamp_out_of_range' END) AS errors
FROM t""")
def route_envelopes(spark, sf_dir):
    """S4 + D1-D9 as the feed handler runs them: envelopes -> per-tick raw
    messages -> rule pass (only the last day before as_of is in range)."""
    from ..functions.parse import envelope_messages
    from ..sources.adapters import envelopes, trades_from_events
    t = trades_from_events(table(spark, sf_dir, "events")).withColumn("symbol", F.upper("symbol"))
    env = envelopes(t).select(F.to_json(F.struct("type", "data")).alias("value"))
    msgs = envelope_messages(env, processed_at=F.lit(0).cast("bigint"))
    v = Q.validate(msgs, as_of=AS_OF)
    return v.select("key", F.col("norm.timestamp").alias("timestamp"),
                    F.array_join("errors", ";").alias("errors"))


@register("dlq_redrive", _DIRTY + """,
l AS (SELECT *, p > 0 AND m IN (8, 14, 21) AS found FROM v WHERE errors <> '')
SELECT event_id, CASE WHEN found THEN 'recovered' ELSE 'parked' END AS place,
       CAST(CASE WHEN NOT found THEN 2 WHEN m = 14 THEN 0 ELSE 1 END AS INTEGER) AS retry_count,
       CASE WHEN found THEN p END AS price, CASE WHEN found THEN coalesce(ts_ms, base_ms) END AS "timestamp"
FROM l
UNION ALL SELECT event_id, 'main', 0, price, ts_ms FROM v WHERE errors = ''""")
def dlq_redrive(spark, sf_dir):
    """The dead letters of a routed batch driven twice: first judged as of two
    hours earlier (a late message is in range then), then with their text mended (cut-off
    objects closed, a unit after the price taken off); what fails both is parked.
    Returns where every message of the batch is."""
    raw = dirty_from_events(table(spark, sf_dir, "events"), AS_OF).withColumns({
        "topic": F.lit("ticks"), "partition": (F.col("event_id") % 7).cast("int"), "offset": F.col("event_id")})
    main, dlq = fresh_dir(spark, "sink"), fresh_dir(spark, "dlq")
    Q.write_routed(Q.validate(raw, as_of=AS_OF), main, dlq, batch_id=0, job="feed")
    RD.redrive(spark, main, dlq, as_of=EARLIER, max_retries=2, run=1)

    def mend(text):
        closed = F.when(text.endswith("}}"), text).otherwise(F.concat(text, F.lit("}")))
        return F.regexp_replace(closed, r'"price":"([^"]+)d"', r'"price":"$1"')
    RD.redrive(spark, main, dlq, as_of=AS_OF, max_retries=2, repair=mend, run=2)
    trades = spark.read.parquet(main).select(F.col("offset").alias("event_id"), "price", "timestamp", "job")
    letters = RD.letter_places(spark, main, dlq, 2).select(F.col("original_offset").alias("event_id"), "place", "retry_count")
    fed = trades.filter("job = 'feed'").select("event_id", F.lit("main").alias("place"),
                                               F.lit(0).alias("retry_count"), "price", "timestamp")
    moved = trades.filter(F.col("job") == RD.JOB).drop("job")
    return fed.unionByName(letters.join(moved, "event_id", "left"))
