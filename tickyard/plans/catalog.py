"""Registered queries: one Spark plan per operator plus its DuckDB oracle.

Conventions for comparability with the SQL oracle: times leave as epoch-ms
BIGINT, derived doubles as ``round(x + 1e-9, 6)`` on both sides, integer
outputs are cast to a fixed width on both sides, and every column is aliased
to the same name in the Spark plan and in the SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import use_utc
from ..sources.adapters import trades_from_events, trades_from_lineitem
from ..sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def ms(c: Column | str) -> Column:
    return F.unix_millis(F.col(c) if isinstance(c, str) else c)


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 6)


def ev_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(table(spark, sf_dir, "events"))


def li_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_lineitem(table(spark, sf_dir, "lineitem"))


# ---- SQL building blocks (DuckDB) -------------------------------------------
# DuckDB's epoch_ms rounds sub-millisecond time; Spark's unix_millis truncates.
SQL_EV_TRADES = """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS symbol, value AS price,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
       CAST(epoch_us(ts) // 1000 AS BIGINT) AS "timestamp", ts AS event_time,
       CAST(epoch_us(ts) // 1000 AS BIGINT)
         + CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS BIGINT) AS processed_at
FROM events"""

SQL_LI_TRADES = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS event_id,
       l_returnflag AS symbol, l_extendedprice / l_quantity AS price, l_quantity AS volume,
       CAST(epoch_us(l_shipdate) // 1000 AS BIGINT) AS "timestamp", l_shipdate AS event_time,
       CAST(epoch_us(l_shipdate) // 1000 AS BIGINT) AS processed_at
FROM lineitem"""


def sql_ms(expr: str) -> str:
    return f"CAST(epoch_us({expr}) // 1000 AS BIGINT)"


def sql_r6(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 6)"


def sql_bars(trades_sql: str, unit: str, order: str) -> str:
    """OHLCV bars in SQL for a date_trunc unit ('hour', 'day')."""
    return f"""
WITH t AS ({trades_sql})
SELECT symbol,
       {sql_ms(f"date_trunc('{unit}', event_time)")} AS window_start,
       {sql_ms(f"date_trunc('{unit}', event_time) + INTERVAL 1 {unit}")} AS window_end,
       sum(volume) AS total_volume,
       {sql_r6('avg(price)')} AS avg_price,
       max(price) AS high_price,
       min(price) AS low_price,
       arg_min(price, {order}) AS open_price,
       arg_max(price, {order}) AS close_price,
       count(*) AS trade_count,
       {sql_r6('stddev_samp(price)')} AS price_volatility,
       {sql_r6('sum(price * volume) / nullif(sum(volume), 0)')} AS vwap
FROM t GROUP BY ALL"""


ORDER_SQL = "row(event_time, processed_at, event_id, price, volume)"


def bars_out(df: DataFrame) -> DataFrame:
    """Comparable projection of a bar frame."""
    return df.select(
        "symbol", ms("window_start").alias("window_start"), ms("window_end").alias("window_end"),
        "total_volume", r6("avg_price").alias("avg_price"), "high_price", "low_price",
        "open_price", "close_price", "trade_count",
        r6("price_volatility").alias("price_volatility"), r6("vwap").alias("vwap"))
