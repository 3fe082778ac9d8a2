"""Column functions on the trade frame.

All are projections made of built-in expressions: no UDF, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import TRADE_V2_EXTRA

# Date bucket formats (fixed values): granularity -> Spark datetime pattern.
BUCKET_FORMATS = {"daily": "yyyyMMdd", "hourly": "yyyyMMddHH", "monthly": "yyyyMM"}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP on the exact integer path."""
    return F.timestamp_millis(_c(ms))


def ingest_stamp() -> Column:
    """P5: processing time of the micro-batch (``spark_processed_at``)."""
    return F.current_timestamp()


def date_bucket(ts: Column | str, granularity: str = "daily") -> Column:
    """String date bucket, e.g. 20250924 / 2025092413 / 202501 (UTC)."""
    if granularity not in BUCKET_FORMATS:
        raise ValueError(f"unknown granularity {granularity!r}; use one of {sorted(BUCKET_FORMATS)}")
    return F.date_format(_c(ts), BUCKET_FORMATS[granularity])


def volume_class(volume: Column | str = "volume", threshold: float = 1000.0) -> Column:
    """P7: 'high_volume' above the threshold, else (also for NULL) 'normal_volume'."""
    return F.when(_c(volume) > threshold, F.lit("high_volume")).otherwise(F.lit("normal_volume"))


def add_trade_date_hour(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """trade_date DATE and trade_hour INT."""
    return df.withColumns({"trade_date": F.to_date(ts), "trade_hour": F.hour(ts)})


def add_partitioning_columns(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """trade_year, trade_month, trade_day, trade_hour."""
    c = F.col(ts)
    return df.withColumns({"trade_year": F.year(c), "trade_month": F.month(c),
                           "trade_day": F.dayofmonth(c), "trade_hour": F.hour(c)})


# Regular session of the exchange, New York local time (fixed values).
MARKET_TZ = "America/New_York"
MARKET_OPEN_MIN = 9 * 60 + 30
MARKET_CLOSE_MIN = 16 * 60


def market_hours(ts: Column | str = "event_time", mode: str = "minutes",
                 weekdays_only: bool = False) -> Column:
    """P10: is the trade inside regular market hours?

    ``mode="minutes"``: 09:30 <= New York local time < 16:00.
    ``mode="hour"``: UTC hour in [9, 16), the simpler hour-only rule.
    """
    t = _c(ts)
    if mode == "hour":
        h = F.hour(t)
        flag = (h >= 9) & (h < 16)
    elif mode == "minutes":
        local = F.from_utc_timestamp(t, MARKET_TZ)
        m = F.hour(local) * 60 + F.minute(local)
        flag = (m >= MARKET_OPEN_MIN) & (m < MARKET_CLOSE_MIN)
        if weekdays_only:
            flag = flag & ~F.dayofweek(local).isin(1, 7)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return flag


def notional(price: str = "price", volume: str = "volume") -> Column:
    """Price * volume (the numerator of VWAP)."""
    return F.col(price) * F.col(volume)


def with_trade_time(bars: DataFrame) -> DataFrame:
    """Add ``trade_time`` = window_start for the sink, keeping window_start."""
    return bars.withColumn("trade_time", F.col("window_start"))


# Defaults of the fields added in message version 2 (fixed values).
V2_DEFAULTS = {
    "exchange": None,
    "trade_id": None,
    "bid_price": None,
    "ask_price": None,
    "is_market_hours": False,
    "metadata": {},
}


def conform_v2(df: DataFrame) -> DataFrame:
    """Upgrade v1 trade rows to the v2 shape with the declared defaults.

    Missing fields are added typed; present ones keep their values, and NULL
    flag/map values take the default (as an Avro reader would for v1 data).
    """
    have = set(df.columns)
    cols = {}
    for f in TRADE_V2_EXTRA:
        default = V2_DEFAULTS[f.name]
        if f.name == "metadata":
            dflt = F.create_map().cast(f.dataType)
        elif default is None:
            dflt = F.lit(None).cast(f.dataType)
        else:
            dflt = F.lit(default).cast(f.dataType)
        cols[f.name] = F.coalesce(F.col(f.name), dflt) if f.name in have else dflt
    return df.withColumns(cols)


# Column order of the two trade-table shapes (fixed values).
TRADE_TABLE_V1 = ["symbol", "date_bucket", "event_time", "event_id", "price", "volume", "conditions",
                  "processed_at", "kafka_timestamp", "spark_processed_at", "price_change_indicator",
                  "trade_date", "trade_hour"]
TRADE_TABLE_V2 = ["symbol", "trade_year", "trade_month", "trade_day", "timestamp", "price", "volume",
                  "trade_time", "trade_hour", "conditions", "processed_at"]


def to_trade_table(df: DataFrame, shape: str = "v2", ts: str = "event_time") -> DataFrame:
    """Project a trade frame onto a trade-table shape, deriving what is missing:
    ``v2`` = year/month/day buckets + trade_time; ``v1`` = daily date bucket,
    volume class, trade date/hour (broker and ingest times NULL when absent)."""
    if shape == "v2":
        out = add_partitioning_columns(df, ts).withColumn("trade_time", F.col(ts))
        cols = TRADE_TABLE_V2
    elif shape == "v1":
        out = add_trade_date_hour(df, ts)
        extra = {"date_bucket": date_bucket(ts, "daily"),
                 "price_change_indicator": volume_class("volume")}
        for c in ("kafka_timestamp", "spark_processed_at"):
            if c not in df.columns:
                extra[c] = F.lit(None).cast("timestamp")
        out = out.withColumns({k: v for k, v in extra.items() if k not in df.columns})
        cols = TRADE_TABLE_V1
    else:
        raise ValueError("shape must be 'v1' or 'v2'")
    return out.select(*cols)
