"""Registered queries: health on live streams and quantiles from stored sketches."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Window, functions as F

from ..functions import quality as Q
from ..operators import metrics as M
from ..session import fresh_dir
from ..sources.adapters import dirty_from_events, message_rows
from ..sources.tables import table
from ..streaming import health as H, job_metrics as JM, jobs as J, late as L, outliers as O
from ..streaming.sources import file_stream
from .catalog import SQL_EV_TRADES, ev_trades, ms, register
from .q_quality import _DIRTY, AS_OF
from .q_stream import DELAY, SLICES, _run, replay_stream
from .replay import write_message_files

DELAY_MS = 300_000
SILENCE = _dt.timedelta(hours=1)
HOUR_MS = 3_600_000
_TRADES = f'WITH t AS ({SQL_EV_TRADES}), final AS (SELECT max("timestamp") - {DELAY_MS} AS w FROM t)'


@register("stream_silences", f"""{_TRADES},
n AS (SELECT symbol, "timestamp" AS since, lead("timestamp") OVER (PARTITION BY symbol ORDER BY "timestamp") AS following FROM t)
SELECT symbol, since AS silent_since, since + {HOUR_MS} AS silent_at
FROM n, final WHERE (following IS NULL OR following - since > {HOUR_MS}) AND since + {HOUR_MS} + 1 <= w""")
def stream_silences(spark, sf_dir):
    """M5 on a live stream: every silence that the final watermark has closed."""
    out, ck = fresh_dir(spark, "sink"), fresh_dir(spark, "checkpoints")
    found = H.silences(J.trades_stream(replay_stream(spark, sf_dir), DELAY), SILENCE)
    _run(J.start_append(found, out, ck, available_now=True))
    return spark.read.parquet(out).select("symbol", ms("silent_since").alias("silent_since"),
                                          ms("silent_at").alias("silent_at"))


@register("stream_rate_alerts", f"""{_TRADES},
level AS (SELECT count(*) // 720 AS most FROM t),
slots AS (SELECT "timestamp" // {HOUR_MS} AS slot, count(*) AS n FROM t GROUP BY 1),
runs AS (SELECT slot, n, slot - row_number() OVER (ORDER BY slot) AS run FROM slots, level WHERE n > most),
found AS (SELECT min(slot) * {HOUR_MS} AS first_slot, max(slot) * {HOUR_MS} AS last_slot,
                 count(*) AS n_slots, CAST(sum(n) AS BIGINT) AS n_events FROM runs GROUP BY run HAVING count(*) >= 2)
SELECT first_slot, last_slot, n_slots, n_events FROM found, final WHERE last_slot + {2 * HOUR_MS} <= w""")
def stream_rate_alerts(spark, sf_dir):
    """M4 on a live stream: two hours in a row or more above the month's mean rate."""
    most = table(spark, sf_dir, "events").count() // 720
    out, ck = fresh_dir(spark, "sink"), fresh_dir(spark, "checkpoints")
    found = H.rate_episodes(J.trades_stream(replay_stream(spark, sf_dir), DELAY), most, 2, _dt.timedelta(hours=1))
    _run(J.start_append(found, out, ck, available_now=True))
    return spark.read.parquet(out).select(ms("first_slot").alias("first_slot"), ms("last_slot").alias("last_slot"),
                                          "n_slots", "n_events")


@register("latency_p95_sketch", f"""{_TRADES}
SELECT symbol, count(*) AS n, TRUE AS within_bound FROM t GROUP BY symbol""")
def latency_p95_sketch(spark, sf_dir):
    """M3 from stored sketches: hourly sketches written once and merged over the whole time;
    the rank of the merged p95 among the raw latencies is within the stated bound."""
    trades = ev_trades(spark, sf_dir)
    path = fresh_dir(spark, "tables")
    M.latency_sketches(trades).write.parquet(path)
    merged = M.sketch_quantile(spark.read.parquet(path), 0.95)
    lat = M.latency_seconds(trades)
    ranks = (trades.join(merged.select("symbol", "quantile"), "symbol").groupBy("symbol")
             .agg((F.count_if(lat < F.col("quantile")) / F.count(F.lit(1))).alias("below"),
                  (F.count_if(lat <= F.col("quantile")) / F.count(F.lit(1))).alias("upto")))
    near = (F.col("below") <= 0.95 + M.SKETCH_ERROR) & (F.col("upto") >= 0.95 - M.SKETCH_ERROR)
    return merged.join(ranks, "symbol").select("symbol", "n", near.alias("within_bound"))


@register("stream_late_rows", f"""WITH t AS ({SQL_EV_TRADES})
SELECT event_id, symbol, price, volume, "timestamp", CAST(3 AS BIGINT) AS n_copies, TRUE AS in_time_once, TRUE AS placed_right
FROM t""")
def stream_late_rows(spark, sf_dir):
    """The replay split into rows in time and late rows.  Of each message all three
    deliveries are there, at least one of them in time, and each on the side that the greatest time
    of the batches before its own says."""
    main, late, marks, ck = (fresh_dir(spark, k) for k in ("sink", "late", "marks", "checkpoints"))
    trades = Q.valid_trades(J.checked_stream(replay_stream(spark, sf_dir)))
    _run(L.start_split(trades, main, late, marks, ck, DELAY, available_now=True))
    rows = (spark.read.parquet(main).withColumn("late", F.lit(False))
            .unionByName(spark.read.parquet(late).withColumn("late", F.lit(True))))
    tops = rows.groupBy("batch_id").agg(F.max(F.unix_millis("event_time")).alias("top"))      # one row per batch
    before = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("mark", F.max("top").over(before)).drop("top")
    right = F.col("late") == L.is_late(F.col("mark"), DELAY)
    return (rows.join(tops, "batch_id").groupBy("event_id", "symbol", "price", "volume", "timestamp")
            .agg(F.count(F.lit(1)).alias("n_copies"), (F.count_if(~F.col("late")) > 0).alias("in_time_once"),
                 F.bool_and(right).alias("placed_right")))


@register("stream_outliers", f"""
WITH t AS (SELECT *, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS day FROM ({SQL_EV_TRADES})),
days AS (SELECT DISTINCT symbol, day FROM t),
past AS (SELECT d.symbol, d.day, avg(t.price) AS m, stddev_samp(t.price) AS sd
         FROM days d JOIN t ON t.symbol = d.symbol AND t.day < d.day GROUP BY d.symbol, d.day)
SELECT t.event_id, t.symbol, t.price,
       coalesce(NOT t.price BETWEEN p.m - 1.5 * p.sd AND p.m + 1.5 * p.sd, false) AS is_outlier
FROM t LEFT JOIN past p ON t.symbol = p.symbol AND t.day = p.day""")
def stream_outliers(spark, sf_dir):
    """D13 on a stream: every trade judged by stored moments of the days before its own
    (1.5 deviations, since these prices have no value beyond three)."""
    out, kept, ck = (fresh_dir(spark, k) for k in ("sink", "moments", "checkpoints"))
    path = fresh_dir(spark, "replay")
    write_message_files(message_rows(ev_trades(spark, sf_dir)), path, SLICES)
    trades = J.valid_trades(J.checked_stream(file_stream(spark, path, max_files_per_trigger=1)))
    _run(O.start_outliers(trades, out, kept, ck, std_dev=1.5, available_now=True))
    return spark.read.parquet(out).select("event_id", "symbol", "price", "is_outlier")


@register("stream_job_metrics", _DIRTY + """
SELECT count(*) AS n_received, count(*) FILTER (WHERE errors = '') AS n_sent,
       count(*) FILTER (WHERE errors <> '') AS n_rejected FROM v""")
def stream_job_metrics(spark, sf_dir):
    """W6 + M1: the counters that the listener of a running job wrote, summed over its
    batches, are those of a batch pass over all messages."""
    raw = dirty_from_events(table(spark, sf_dir, "events"), AS_OF)
    rows = raw.select(F.col("event_id").cast("string").alias("key"), "value", F.col("received_at").alias("timestamp"))
    path, out, ck, kept = (fresh_dir(spark, k) for k in ("replay", "sink", "checkpoints", "metrics"))
    write_message_files(rows, path, SLICES)
    checked = JM.counted(J.checked_stream(file_stream(spark, path, max_files_per_trigger=1), "lenient", AS_OF))
    watch = JM.JobMetrics(spark, kept)
    spark.streams.addListener(watch)
    try:
        q = J.start_append(J.valid_trades(checked), out, ck, available_now=True)
        _run(q)
        watch.wait(q)
    finally:
        spark.streams.removeListener(watch)
    return JM.read_metrics(spark, kept).agg(*[F.sum(c).alias(c) for c in ("n_received", "n_sent", "n_rejected")])
