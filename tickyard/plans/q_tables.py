"""Registered dedupe and table queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from ..operators import dedupe as U
from ..operators import tables as K
from ..session import fresh_dir
from .catalog import SQL_EV_TRADES, SQL_LI_TRADES, ev_trades, li_trades, register

_OUT = ["event_id", "symbol", "price", "volume", "timestamp"]


@register("dedupe_keys", f"""
WITH t AS ({SQL_LI_TRADES})
SELECT event_id, symbol, price, volume, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, event_id
                               ORDER BY event_time, event_id, price, volume) AS rn FROM t)
WHERE rn = 1""")
def dedupe_keys(spark, sf_dir):
    """One trade per (symbol, event_id), earliest survives (lineitem ids repeat)."""
    return U.deduplicate_trades(li_trades(spark, sf_dir)).select(*_OUT)


@register("dedupe_symbol_ts", f"""
WITH t AS ({SQL_LI_TRADES})
SELECT event_id, symbol, price, volume, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, "timestamp"
                               ORDER BY event_time, event_id, price, volume) AS rn FROM t)
WHERE rn = 1""")
def dedupe_symbol_ts(spark, sf_dir):
    """U2, legacy key (symbol, timestamp): few keys, each very large (hot keys)."""
    return U.deduplicate_trades(li_trades(spark, sf_dir), legacy_key=True).select(*_OUT)


@register("distinct_buckets", f"""
WITH t AS ({SQL_LI_TRADES})
SELECT DISTINCT CAST(year(event_time) AS INTEGER) AS trade_year,
       CAST(month(event_time) AS INTEGER) AS trade_month, CAST(day(event_time) AS INTEGER) AS trade_day
FROM t""")
def distinct_buckets(spark, sf_dir):
    """Distinct (year, month, day) buckets."""
    from ..functions.columns import add_partitioning_columns
    return U.distinct_buckets(add_partitioning_columns(li_trades(spark, sf_dir)))


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("trade_date", F.to_date("event_time"))


def _between(lo: str, hi: str):
    return F.col("trade_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))


def _table_out(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(F.col("event_id").cast("bigint").alias("event_id"), "symbol", "price", "volume",
                     "timestamp", "version", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
                     *extra)


_SQL_DATED = f"""WITH t AS (SELECT *, CAST(event_time AS DATE) AS trade_date FROM ({SQL_EV_TRADES}))"""
_SQL_TABLE_OUT = """CAST(event_id AS BIGINT) AS event_id, symbol, price, volume, "timestamp", version,
       strftime(trade_date, '%Y-%m-%d') AS trade_date"""
_KEYS = ("trade_date", "symbol", "event_id")


@register("upsert_result", _SQL_DATED + f""",
a AS (SELECT *, 1 AS version FROM t WHERE CAST(event_id AS BIGINT) % 4 <> 3),
b AS (SELECT * REPLACE (price + 1 AS price), 2 AS version FROM t WHERE CAST(event_id AS BIGINT) % 4 >= 2),
c AS (SELECT * FROM a WHERE trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
SELECT {_SQL_TABLE_OUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY trade_date, symbol, event_id ORDER BY version DESC) AS rn FROM u)
WHERE rn = 1""")
def upsert_result(spark, sf_dir):
    """K1 (+K2, K4, K5): overlapping batches that together hold the whole table,
    then a replay of older data; the highest version of every key stays."""
    t = _dated(ev_trades(spark, sf_dir)).withColumn("version", F.lit(1))
    part = F.pmod(F.col("event_id").cast("bigint"), F.lit(4))
    a = t.filter(part != 3)
    b = (t.filter(part >= 2)
         .withColumn("price", F.col("price") + 1).withColumn("version", F.lit(2)))
    c = a.filter(_between("2024-01-05", "2024-01-12"))
    path = fresh_dir(spark, "tables")
    for batch in (a, b, c, c.limit(0)):
        K.upsert(batch, path, _KEYS, "version", "trade_date",
                 cluster=[F.col("symbol"), F.col("event_time").desc()])
    return _table_out(K.read_table(spark, path))


@register("upsert_null_day", f"""
WITH t AS (SELECT *, CASE WHEN CAST(event_id AS BIGINT) % 5 = 0 THEN NULL ELSE CAST(event_time AS DATE) END AS trade_date,
           CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN NULL ELSE event_id END AS id FROM ({SQL_EV_TRADES}))
SELECT CASE WHEN id IS NULL THEN -1 ELSE CAST(id AS BIGINT) END AS event_id, symbol,
       CASE WHEN CAST(event_id AS BIGINT) % 2 = 0 AND id IS NOT NULL THEN price + 1 ELSE price END AS price,
       coalesce(strftime(trade_date, '%Y-%m-%d'), 'none') AS trade_date FROM t""")
def upsert_null_day(spark, sf_dir):
    """K1: rows without a day and rows without an id, in three batches, the first
    one replayed and half of the table updated; nothing is lost or doubled."""
    n = F.col("event_id").cast("bigint")
    t = _dated(ev_trades(spark, sf_dir)).withColumns({
        "n": n, "trade_date": F.when(n % 5 != 0, F.col("trade_date")),
        "event_id": F.when(n % 3 != 0, F.col("event_id")), "version": F.lit(1)})
    first, second = t.filter("n % 2 = 1"), t.filter("n % 2 = 0")
    update = (second.filter("event_id is not null")
              .withColumn("price", F.col("price") + 1).withColumn("version", F.lit(2)))
    path = fresh_dir(spark, "tables")
    for batch in (first, second, update, first):
        K.upsert(batch, path, _KEYS, "version", "trade_date", buckets=2)
    return K.read_table(spark, path).select(
        F.coalesce(F.col("event_id").cast("bigint"), F.lit(-1)).alias("event_id"), "symbol", "price",
        F.coalesce(F.date_format("trade_date", "yyyy-MM-dd"), F.lit("none")).alias("trade_date"))


@register("upsert_schema_evolution", _SQL_DATED + """
SELECT CAST(event_id AS BIGINT) AS event_id, price,
       CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN volume END AS volume,
       CASE WHEN CAST(event_id AS BIGINT) % 3 = 1 THEN symbol END AS note FROM t""")
def upsert_schema_evolution(spark, sf_dir):
    """K1: batches with different columns; each row keeps the columns it came with."""
    t = _dated(ev_trades(spark, sf_dir)).withColumn("version", F.lit(1))
    part = F.pmod(F.col("event_id").cast("bigint"), F.lit(3))
    base = ["trade_date", "symbol", "event_id", "price", "version"]
    path = fresh_dir(spark, "tables")
    for batch in (t.filter(part == 0).select(*base, "volume"),
                  t.filter(part == 1).select(*base, F.col("symbol").alias("note")),
                  t.filter(part == 2).select(*base)):
        K.upsert(batch, path, _KEYS, "version", "trade_date")
    return K.read_table(spark, path).select(F.col("event_id").cast("bigint").alias("event_id"), "price", "volume",
                                            "note")


@register("dedupe_missing_ids", f"""
WITH t AS (SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 2 = 0 THEN NULL ELSE event_id END AS event_id)
           FROM ({SQL_EV_TRADES}))
SELECT coalesce(event_id, 'none') AS event_id, symbol, price, volume, "timestamp" FROM t""")
def dedupe_missing_ids(spark, sf_dir):
    """Every trade sent twice, half of them without an id; each stays once."""
    t = ev_trades(spark, sf_dir)
    t = t.withColumn("event_id", F.when(F.col("event_id").cast("bigint") % 2 != 0, F.col("event_id")))
    return U.deduplicate_trades(t.unionByName(t)).select(
        F.coalesce("event_id", F.lit("none")).alias("event_id"), "symbol", "price", "volume", "timestamp")


def _write_dated(spark, df: DataFrame) -> str:
    path = fresh_dir(spark, "tables")
    K.write_layout(df, "trade_date", cluster=["symbol", F.col("event_time").desc()]) \
        .write.partitionBy("trade_date").parquet(path)
    return path


@register("expire_20d", _SQL_DATED + f"""
SELECT {_SQL_TABLE_OUT} FROM (SELECT *, 1 AS version FROM t)
WHERE trade_date >= DATE '2024-01-31' - INTERVAL 20 DAY""")
def expire_20d(spark, sf_dir):
    """K6: drop date partitions older than as_of - 20 days."""
    t = _dated(ev_trades(spark, sf_dir)).withColumn("version", F.lit(1))
    path = _write_dated(spark, t)
    K.expire(spark, path, 20, "2024-01-31 00:00:00", schema=t.schema)
    return _table_out(spark.read.schema(t.schema).parquet(path))


@register("backfill_range", _SQL_DATED + f"""
SELECT {_SQL_TABLE_OUT}, strftime(event_time, '%Y%m%d%H') AS date_bucket
FROM (SELECT *, 1 AS version FROM t)
WHERE trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""")
def backfill_range(spark, sf_dir):
    """S2 + K7: backfill 5 whole days (inclusive) in 2-day slices through the upsert."""
    t = _dated(ev_trades(spark, sf_dir)).withColumn("version", F.lit(1))
    src = _write_dated(spark, t)
    dst = fresh_dir(spark, "tables")
    K.backfill(spark, src, dst, "2024-01-05", "2024-01-09", keys=_KEYS, version="version",
               granularity="hourly", batch_days=2, schema=t.schema)
    return _table_out(K.read_table(spark, dst), "date_bucket")


@register("backfill_difference", _SQL_DATED + f""",
u AS (SELECT *, trade_date IN (DATE '2024-01-06', DATE '2024-01-08') AND CAST(event_id AS BIGINT) % 7 = 0 AS moved FROM t),
c AS (SELECT trade_date AS day FROM u GROUP BY trade_date HAVING bool_or(moved)),
v AS (SELECT * REPLACE (CASE WHEN moved THEN price + 1 ELSE price END AS price),
             CASE WHEN moved THEN 2 ELSE 1 END AS version FROM u)
SELECT {_SQL_TABLE_OUT}, CASE WHEN c.day IS NULL THEN 1 ELSE 2 END AS copies, 0 AS idle_days
FROM v LEFT JOIN c ON v.trade_date = c.day""")
def backfill_difference(spark, sf_dir):
    """K7 by difference: the whole table copied, then again after rows of two days changed
    (only those days are copied), then from the same rows in other files (no day is)."""
    t = _dated(ev_trades(spark, sf_dir)).withColumn("version", F.lit(1))
    moved = F.col("trade_date").isin(_dt.date(2024, 1, 6), _dt.date(2024, 1, 8)) \
        & (F.col("event_id").cast("bigint") % 7 == 0)
    later = t.withColumns({"price": F.when(moved, F.col("price") + 1).otherwise(F.col("price")),
                           "version": F.when(moved, 2).otherwise(1)})
    dst = fresh_dir(spark, "tables")
    runs = [K.backfill_changed(spark, _write_dated(spark, rows), dst, "2020-01-01", "2030-01-01", _KEYS, "version",
                               schema=t.schema)
            for rows in (t, later, later.repartition(3, "price"))]
    day = F.date_format("trade_date", "yyyy-MM-dd")
    copies = sum((F.when(day.isin(days), 1).otherwise(0) for days in runs), F.lit(0))
    return _table_out(K.read_table(spark, dst).withColumns({"copies": copies, "idle_days": F.lit(len(runs[2]))}),
                      "copies", "idle_days")


@register("symbol_partitions", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT CAST(event_id AS BIGINT) AS event_id, symbol, price, true AS in_range, true AS few_per_symbol FROM t""")
def symbol_partitions(spark, sf_dir):
    """K4: every trade after the salted repartition by symbol; a symbol lies in at most
    as many partitions as there are salts."""
    n, salt = 10, 4
    rows = K.repartition_by_symbol(ev_trades(spark, sf_dir), n, salt).withColumn("part", F.spark_partition_id())
    spread = rows.groupBy("symbol").agg(F.count_distinct("part").alias("parts"))
    return rows.join(spread, "symbol").select(
        F.col("event_id").cast("bigint").alias("event_id"), "symbol", "price",
        F.col("part").between(0, n - 1).alias("in_range"), (F.col("parts") <= salt).alias("few_per_symbol"))


@register("load_historical", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT CAST(event_id AS BIGINT) AS event_id, symbol, price, volume, "timestamp" FROM t
WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-13 00:00:00'""")
def load_historical(spark, sf_dir):
    """S3 + K8: file scan by time range, end day included whole."""
    t = ev_trades(spark, sf_dir).withColumnRenamed("event_time", "trade_time")
    path = fresh_dir(spark, "files")
    t.write.parquet(path)
    h = K.load_historical(spark, path, "2024-01-10 00:00:00", "2024-01-12", schema=t.schema)
    return h.select(F.col("event_id").cast("bigint").alias("event_id"), "symbol", "price", "volume",
                    "timestamp")


@register("backfill_files", f"""
WITH t AS ({SQL_EV_TRADES})
SELECT CAST(event_id AS BIGINT) AS event_id, symbol, price, volume, "timestamp",
       CAST(year(event_time) AS INTEGER) AS trade_year, CAST(month(event_time) AS INTEGER) AS trade_month,
       CAST(day(event_time) AS INTEGER) AS trade_day, CAST(hour(event_time) AS INTEGER) AS trade_hour
FROM t WHERE event_time >= TIMESTAMP '2024-01-20 00:00:00' AND event_time < TIMESTAMP '2024-01-26 00:00:00'""")
def backfill_files(spark, sf_dir):
    """K8: backfill [Jan 20, Jan 25] from plain files into a keyed table, twice
    (the replay changes nothing)."""
    t = ev_trades(spark, sf_dir).withColumnRenamed("event_time", "trade_time")
    src, dst = fresh_dir(spark, "files"), fresh_dir(spark, "tables")
    t.write.parquet(src)
    for _ in range(2):
        K.backfill_from_files(spark, src, dst, "2024-01-20 00:00:00", "2024-01-25",
                              keys=("trade_date", "symbol", "event_id"), version="processed_at",
                              schema=t.schema)
    out = K.read_table(spark, dst)
    return out.select(F.col("event_id").cast("bigint").alias("event_id"), "symbol", "price", "volume",
                      "timestamp", "trade_year", "trade_month", "trade_day", "trade_hour")
