"""Pipeline health on live streams: silences (M5) and rate alerts (M4).

Both are session windows in append mode: a row is written once, when the
watermark has passed what could still change it.  They take a stream with a
watermark on ``event_time`` (``jobs.trades_stream``) or a batch frame alike.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Less than any distance of event times, which are whole milliseconds.  A session takes in a row at
#: its very end but closes when the watermark is there; with a tick more neither meets the other.
TICK = _dt.timedelta(microseconds=1)


def _text(span: _dt.timedelta) -> str:
    return f"{span // TICK} microseconds"


def silences(trades: DataFrame, threshold: _dt.timedelta = _dt.timedelta(minutes=10),
             keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """M5: (keys, silent_since, silent_at, n_before): one row for each time that a
    key had no trade for longer than ``threshold``.

    A session of a key ends when no trade follows within the threshold; its last
    trade is where the silence starts.  Unlike the batch form there is no need
    of a next trade: the row comes as soon as the watermark has passed
    ``silent_at``, the last trade plus the threshold, while the key is still
    silent.  A gap of exactly the threshold is none.  State is one row per open session of a key; a key of
    very many trades is combined before the shuffle.  Rows without a key are a
    key of their own; rows without a time have no place and are left out."""
    session = F.session_window("event_time", _text(threshold + TICK)).alias("w")
    return (trades.filter(F.col("event_time").isNotNull()).groupBy(*keys, session)
            .agg(F.max("event_time").alias("silent_since"), F.count(F.lit(1)).alias("n_before"))
            .select(*keys, "silent_since",
                    (F.col("silent_since") + F.expr(f"INTERVAL {_text(threshold)}")).alias("silent_at"), "n_before"))


def rate_episodes(trades: DataFrame, max_count: int, hold: int,
                  every: _dt.timedelta = _dt.timedelta(minutes=1), keys: Sequence[str] = ()) -> DataFrame:
    """M4: (keys, first_slot, last_slot, n_slots, n_events): episodes in which
    ``hold`` slots in a row or more have over ``max_count`` rows.

    Two chained aggregations in one append query: rows per slot, and sessions
    over the slots that breach, which join where one follows the other.  An
    episode is written when the watermark has reached the end of the slot after
    its last one.  A slot without rows has no row and so ends a run.  The second state
    holds one row per open episode, and sees one row per breaching slot."""
    slots = (trades.groupBy(*keys, F.window("event_time", _text(every)).alias("slot"))
             .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_count)
             .withColumn("at", F.window_time("slot")).withColumn("slot_start", F.col("slot.start")).drop("slot"))
    series = keys or [(F.col("n") > max_count).alias("_all")]     # one series: streams want a key beside the session
    runs = slots.groupBy(*series, F.session_window("at", _text(every + TICK)).alias("w")).agg(
        F.min("slot_start").alias("first_slot"), F.max("slot_start").alias("last_slot"),
        F.count(F.lit(1)).alias("n_slots"), F.sum("n").alias("n_events"))
    return runs.filter(F.col("n_slots") >= hold).select(*keys, "first_slot", "last_slot", "n_slots", "n_events")
