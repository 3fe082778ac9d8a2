"""Read queries over trade and bar tables (Q1-Q7).

Reads take the table as a DataFrame.  When the frame carries the date
partition column, time predicates are also stated on it, because Catalyst
cannot derive a partition predicate from a predicate on the raw time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("timestamp")


def _with_day(df: DataFrame, day_col: str, lo: Column | None, hi: Column | None) -> DataFrame:
    if day_col not in df.columns:
        return df
    if lo is not None:
        df = df.filter(F.col(day_col) >= lo.cast("date"))
    if hi is not None:
        df = df.filter(F.col(day_col) <= hi.cast("date"))
    return df


def recent_trades(trades: DataFrame, symbol: str, day, after_ms: int = 0, n: int = 100,
                  day_col: str = "trade_date") -> DataFrame:
    """Q1: newest ``n`` trades of one symbol on one day after a time (ms)."""
    d = F.lit(str(day)).cast("date")
    t = trades.filter((F.col("symbol") == symbol) & (F.to_date("event_time") == d)
                      & (F.col("timestamp") > after_ms))
    if day_col in trades.columns:
        t = t.filter(F.col(day_col) == d)
    return t.orderBy(F.col("timestamp").desc(), F.col("event_id").desc()).limit(n)


def bars_range(bars: DataFrame, symbol: str, start, end, n: int | None = None,
               day_col: str = "trade_date") -> DataFrame:
    """Q2: bars of one symbol with window_start in [start, end], newest first."""
    lo, hi = _ts(start), _ts(end)
    b = _with_day(bars.filter((F.col("symbol") == symbol) & F.col("window_start").between(lo, hi)),
                  day_col, lo, hi)
    b = b.orderBy(F.col("window_start").desc())
    return b.limit(n) if n else b


def latest_price(trades: DataFrame, symbols: Sequence[str] | None = None, since=None,
                 day_col: str = "trade_date", exact: bool = True) -> DataFrame:
    """Q3: the last trade of each symbol (one row per symbol).

    ``max_by`` over (event_time, event_id) is a partial aggregate: a hot symbol
    is reduced in every input task before the shuffle.  ``since`` limits the
    scan to recent partitions when every symbol is known to have traded since.
    ``exact=False`` returns (symbol, price, timestamp) through a hash aggregate
    (fixed-width order key: microseconds, then a hash of the id for trades in
    the same microsecond) instead of the sort-based struct path.
    """
    t = trades if not symbols else trades.filter(F.col("symbol").isin(list(symbols)))
    if since is not None:
        lo = _ts(since)
        t = _with_day(t.filter(F.col("event_time") >= lo), day_col, lo, None)
    if not exact:
        from .bars import trade_order_key
        key = trade_order_key("event_time", ("event_id",))
        return t.groupBy("symbol").agg(F.max_by("price", key).alias("price"),
                                       F.max_by("timestamp", key).alias("timestamp"))
    last = F.max_by(F.struct("price", "timestamp", "event_id"), F.struct("event_time", "event_id"))
    return (t.groupBy("symbol").agg(last.alias("l"))
             .select("symbol", F.col("l.price").alias("price"), F.col("l.timestamp").alias("timestamp"),
                     F.col("l.event_id").alias("event_id")))


def top_n_latest(trades: DataFrame, symbols: Sequence[str], n: int = 3) -> DataFrame:
    """Q3, literal form: the newest ``n`` trades among the given symbols."""
    return (trades.filter(F.col("symbol").isin(list(symbols)))
            .orderBy(F.col("event_time").desc(), F.col("event_id").desc()).limit(n))


def price_trend(bars: DataFrame, symbols: Sequence[str], n: int = 100, since=None,
                day_col: str = "trade_date") -> DataFrame:
    """Q4: newest ``n`` (window_start, avg_price, symbol) bars of the symbols.

    ``since`` bounds the scan (and, on a date-partitioned table, the
    partitions read) when the dashboard only shows a recent range."""
    b = bars.filter(F.col("symbol").isin(list(symbols)))
    if since is not None:
        lo = _ts(since)
        b = _with_day(b.filter(F.col("window_start") >= lo), day_col, lo, None)
    return (b.select("window_start", "avg_price", "symbol")
            .orderBy(F.col("window_start").desc(), F.col("symbol")).limit(n))


def top_volume(bars: DataFrame, as_of, hours: int = 1, n: int = 10, day_col: str = "trade_date"
               ) -> DataFrame:
    """Q5: symbols with the largest traded volume in the last ``hours`` before
    ``as_of`` (partial aggregate, then a top-n of the small result)."""
    hi = _ts(as_of)
    lo = hi - F.make_interval(hours=F.lit(hours))
    b = _with_day(bars.filter((F.col("window_start") > lo) & (F.col("window_start") <= hi)),
                  day_col, lo, hi)
    return (b.groupBy("symbol").agg(F.sum("total_volume").alias("total_volume"),
                                    F.sum("trade_count").alias("trade_count"))
            .orderBy(F.col("total_volume").desc(), F.col("symbol")).limit(n))


def last_hour(trades: DataFrame, as_of, hours: int = 1, day_col: str = "trade_date") -> DataFrame:
    """Q6: trades newer than ``as_of - hours`` (and not after ``as_of``)."""
    hi = _ts(as_of)
    lo = hi - F.make_interval(hours=F.lit(hours))
    t = trades.filter((F.col("event_time") > lo) & (F.col("event_time") <= hi))
    return _with_day(t, day_col, lo, hi)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Q7: plain preview of ``n`` rows."""
    return df.limit(n)


def row_total(df: DataFrame) -> DataFrame:
    """Q7: COUNT(*) as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
