"""Pipeline-health metrics as windowed aggregates over rows (M1-M7).

Counters and histograms become aggregates over the trade and dead-letter
tables.  Every window function here runs over *aggregated* rows (one per
series and time slot), so its partition is bounded by the time span divided
by the slot width - never by the number of trades - and a hot symbol cannot
make one task hold its raw rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Latency histogram bucket bounds in seconds (fixed values).
LATENCY_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]


SKETCH_K = 400           # size parameter of the latency sketches
SKETCH_ERROR = 0.02      # rank error that a merged sketch stays below (single-sided, over 99 percent sure)


def _dur_ms(every: str) -> Column:
    return F.expr(f"CAST(unix_millis(TIMESTAMP '1970-01-01 00:00:00' + INTERVAL {every}) AS BIGINT)")


def message_rate(trades: DataFrame, every: str = "1 minute", seconds: int = 60,
                 key: str = "symbol") -> DataFrame:
    """M1: messages per second per key in tumbling windows."""
    return (trades.groupBy(F.window("event_time", every).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n_messages"))
            .select(F.col("w.start").alias("window_start"), key, "n_messages",
                    (F.col("n_messages") / F.lit(float(seconds))).alias("rate_per_s")))


def message_counts(validated: DataFrame, every: str = "1 minute", time_col: str = "received_at",
                   key: Column | str | None = None) -> DataFrame:
    """M1: received / sent (valid) / rejected messages per window (and key)."""
    keys = [F.window(time_col, every).alias("w")] + ([key] if key is not None else [])
    return (validated.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_received"), F.count_if("is_valid").alias("n_sent"),
                 F.count_if(~F.col("is_valid")).alias("n_rejected"))
            .withColumn("window_start", F.col("w.start")).drop("w"))


def latency_seconds(trades: DataFrame) -> Column:
    return (F.col("processed_at") - F.col("timestamp")) / F.lit(1000.0)


def latency_histogram(trades: DataFrame, keys: Sequence[str] = ("symbol",),
                      buckets: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """M2: cumulative latency histogram per key: one row per (key, le) with the
    count of samples <= le, plus le = +Inf, and the sum and count of samples.

    One aggregate with one conditional count per bound (partial aggregation),
    then the buckets are unpivoted with ``inline`` - no join, no second pass.
    """
    lat = latency_seconds(trades)
    aggs = [F.count_if(lat <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(buckets)]
    agg = trades.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("n"), F.sum(lat).alias("latency_sum"))
    pairs = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("cum_count"))
             for i, b in enumerate(buckets)]
    pairs.append(F.struct(F.lit(float("inf")).alias("le"), F.col("n").alias("cum_count")))
    return agg.select(*keys, "n", "latency_sum", F.inline(F.array(*pairs)))


def histogram_quantile(hist: DataFrame, q: float = 0.95, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """M3: quantile estimate from a cumulative histogram, as a metrics server
    computes it: find the first bucket whose cumulative count reaches q*n and
    interpolate linearly between its lower and upper bound (the lower bound of
    the first bucket is 0; a rank in the +Inf bucket returns the largest
    finite bound).  The window spans the ~10 bucket rows of one key."""
    w = Window.partitionBy(*keys).orderBy("le")
    h = (hist.withColumn("prev_le", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
             .withColumn("prev_cum", F.coalesce(F.lag("cum_count").over(w), F.lit(0)))
             .withColumn("rank", F.lit(q) * F.col("n")))
    hit = h.filter((F.col("cum_count") >= F.col("rank")) & (F.col("n") > 0))
    first = hit.groupBy(*keys).agg(F.min_by(F.struct("le", "prev_le", "cum_count", "prev_cum", "rank"),
                                            "le").alias("b"))
    b = F.col("b")
    est = (F.when(F.isnan(b.le) | (b.le == float("inf")), b.prev_le)
           .when(b.cum_count == b.prev_cum, b.le)
           .otherwise(b.prev_le + (b.le - b.prev_le) * (b["rank"] - b.prev_cum) / (b.cum_count - b.prev_cum)))
    return first.select(*keys, est.alias("quantile"))


def latency_quantile_approx(trades: DataFrame, q: float = 0.95, keys: Sequence[str] = ("symbol",),
                            accuracy: int = 10000) -> DataFrame:
    """M3, second output: sketch-based quantile of the raw latencies (bounded
    memory per key, unlike an exact percentile that would hold every sample)."""
    return trades.groupBy(*keys).agg(
        F.percentile_approx(latency_seconds(trades), q, accuracy).alias("quantile_approx"))


def latency_sketches(trades: DataFrame, every: str = "1 hour", keys: Sequence[str] = ("symbol",),
                     k: int = SKETCH_K) -> DataFrame:
    """M3: a stored, mergeable sketch of the latencies per (key, slot): columns
    ``slot_start``, ``sketch`` (KLL, a few kilobytes whatever the slot holds) and ``n``.

    Raw rows are read once; dashboards merge sketches instead.  Rows without a
    latency are not counted; slots without rows have none."""
    lat = latency_seconds(trades)
    return (trades.filter(lat.isNotNull()).groupBy(*keys, F.window("event_time", every).alias("w"))
            .agg(F.kll_sketch_agg_double(lat, k).alias("sketch"), F.count(F.lit(1)).alias("n"))
            .select(*keys, F.col("w.start").alias("slot_start"), "sketch", "n"))


def sketch_quantile(sketches: DataFrame, q: float = 0.95, keys: Sequence[str] = ("symbol",),
                    span: str | None = None) -> DataFrame:
    """M3: the quantile over any span from ``latency_sketches``, by merging: the
    whole time of each key, or its windows of width ``span`` (a multiple of the
    slots).  The rank of the result is off by at most SKETCH_ERROR of ``n``."""
    by = [*keys, *([F.window("slot_start", span).alias("w")] if span else [])]
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))
    at = [F.col("w.start").alias("window_start")] if span else []
    return merged.select(*keys, *at, "n", F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("quantile"))


def slot_counts(df: DataFrame, every: str, keys: Sequence[str] = (), time_col: str = "event_time",
                slide: str | None = None) -> DataFrame:
    """Rows per (key, slot) with the slot index.  Tumbling slots of width
    ``every``; with ``slide``, windows of width ``every`` starting every
    ``slide`` (a range rate evaluated at each step), indexed by start / slide.
    Each row then counts in every/slide windows; the count is still a
    map-side-combined aggregate."""
    w = F.window(time_col, every, slide) if slide else F.window(time_col, every)
    step = _dur_ms(slide or every)
    return (df.groupBy(*keys, w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(*keys, F.col("w.start").alias("slot_start"), "n",
                    F.floor(F.unix_millis(F.col("w.start")) / step).cast("bigint").alias("slot")))


def threshold_alerts(counts: DataFrame, max_count: int, hold: int, keys: Sequence[str] = (),
                     block_slots: int = 1024) -> DataFrame:
    """M4: alert episodes where the count per slot stays above ``max_count``
    for at least ``hold`` consecutive slots ("rate > x for N minutes" with
    max_count = x * slot seconds; see ``rate_alerts``).  Slots without rows
    have rate 0 and break a run.  Output: one row per firing episode.

    Gaps and islands in two levels, so no window holds a whole series:
    inside blocks of ``block_slots`` slots (slot - row_number is constant
    along a run), then the per-block fragments are chained where one starts
    right after the previous one ends.  The second window sees one row per
    fragment (runs plus block cuts), not one per slot.
    """
    breach = (counts.filter(F.col("n") > F.lit(max_count))
              .withColumn("_blk", F.floor(F.col("slot") / F.lit(block_slots))))
    w1 = Window.partitionBy(*keys, "_blk").orderBy("slot")
    frag = (breach.withColumn("_isl", F.col("slot") - F.row_number().over(w1))
            .groupBy(*keys, "_blk", "_isl")
            .agg(F.min("slot").alias("_s0"), F.max("slot").alias("_s1"),
                 F.min("slot_start").alias("first_slot"), F.max("slot_start").alias("last_slot"),
                 F.count(F.lit(1)).alias("n_slots"), F.sum("n").alias("n_events")))
    w2 = Window.partitionBy(*keys).orderBy("_s0")
    starts = F.when(F.col("_s0") == F.lag("_s1").over(w2) + 1, F.lit(0)).otherwise(F.lit(1))
    chained = frag.withColumn("_chain", F.sum(starts).over(w2.rowsBetween(Window.unboundedPreceding, 0)))
    return (chained.groupBy(*keys, "_chain")
            .agg(F.min("first_slot").alias("first_slot"), F.max("last_slot").alias("last_slot"),
                 F.sum("n_slots").alias("n_slots"), F.sum("n_events").alias("n_events"))
            .filter(F.col("n_slots") >= hold)
            .drop("_chain"))


def rate_alerts(df: DataFrame, rate_per_s: float, every: str, every_seconds: int, hold: int,
                keys: Sequence[str] = (), time_col: str = "event_time", slide: str | None = None
                ) -> DataFrame:
    """M4 as written in alert rules: rate over ``every`` > ``rate_per_s`` for
    ``hold`` consecutive slots.  ``slide`` evaluates the range rate at every
    step ("rate(x[5m]) > r for 5m" = every="5 minutes", slide="1 minute",
    hold=5)."""
    # n / seconds > rate  <=>  n > floor(rate * seconds) for whole counts; the
    # epsilon keeps a product like 10/3600 * 3600 = 9.999... from losing one
    max_count = math.floor(rate_per_s * every_seconds + 1e-9)
    return threshold_alerts(slot_counts(df, every, keys, time_col, slide), max_count, hold, keys)


def silence_gaps(trades: DataFrame, threshold: str = "10 minutes", as_of=None,
                 key: str = "symbol") -> DataFrame:
    """M5: periods longer than ``threshold`` without a trade, per key.

    Exact and skew-proof: time is cut into chunks of the threshold width T.
    Inside one chunk two trades are less than T apart, so every gap > T lies
    between the last trade of a non-empty chunk and the first trade of the
    next non-empty chunk.  The window therefore runs over per-chunk min/max
    rows (span / T per key), never over the raw trades.  With ``as_of`` an
    open gap from the last trade to ``as_of`` is reported too.
    """
    t_ms = _dur_ms(threshold)
    ms = F.unix_millis("event_time")
    chunks = (trades.groupBy(key, F.floor(ms / t_ms).alias("chunk"))
              .agg(F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms")))
    w = Window.partitionBy(key).orderBy("chunk")
    nxt = F.lead("first_ms").over(w)
    if as_of is not None:
        as_of_ms = F.unix_millis(F.lit(str(as_of)).cast("timestamp"))
        nxt = F.coalesce(nxt, as_of_ms)
    gaps = chunks.select(key, F.col("last_ms").alias("gap_start_ms"), nxt.alias("gap_end_ms"))
    return (gaps.withColumn("gap_ms", F.col("gap_end_ms") - F.col("gap_start_ms"))
            .filter(F.col("gap_ms") > t_ms))


FILL_BLOCK = 1024     # slots that one row is spread to at a time


def gap_fill(bars: DataFrame, every: str = "1 hour", key: str = "symbol") -> DataFrame:
    """M6: complete each key's bar series between its first and last bar.

    Missing slots get volume 0, count 0 and the previous close carried forward
    (open = high = low = close).  One pass over the bars: a window over a key's
    bars gives each its successor, and a bar is then spread to its own slot and
    the empty ones up to the next bar, in blocks, so a long silence is never one
    array.  There is no grid and no join.
    """
    step = F.lit(_dur_ms(every))
    start = F.unix_millis("window_start")
    after = F.lead(start).over(Window.partitionBy(key).orderBy("window_start"))
    slots = F.coalesce(F.floor((after - start) / step), F.lit(1))
    blocks = bars.withColumn("_slots", slots).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_slots") - 1) / FILL_BLOCK))))
    first = F.col("_block") * FILL_BLOCK
    spread = blocks.withColumn("_slot", F.explode(F.sequence(
        first, F.least(first + FILL_BLOCK, F.col("_slots")) - 1)))
    filled = F.col("_slot") > 0
    carried = lambda c: F.when(filled, F.col("close_price")).otherwise(F.col(c)).alias(c)
    return spread.select(
        key, F.timestamp_millis(start + F.col("_slot") * step).alias("window_start"),
        carried("open_price"), carried("high_price"), carried("low_price"), "close_price",
        F.when(filled, F.lit(0.0)).otherwise(F.col("total_volume")).alias("total_volume"),
        F.when(filled, F.lit(0)).otherwise(F.col("trade_count")).cast("bigint").alias("trade_count"),
        filled.alias("is_filled"))


def frame_profile(df: DataFrame) -> DataFrame:
    """M7: rows and columns of a frame as one row (one job)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def partition_sizes(df: DataFrame) -> DataFrame:
    """M7: rows per physical partition (layout check, not a stable result)."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n_rows"))
