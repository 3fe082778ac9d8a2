"""Outliers on a stream (D13): each trade judged by the days before its own.

What is kept of the past is one row per symbol and day: count, mean and sum of
squared deviations.  Such moments merge, so no raw row is read a second time.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.tables import _delete
from .jobs import _trigger, query_id


def daily_moments(trades: DataFrame, key: str = "symbol", price: str = "price",
                  time_col: str = "event_time") -> DataFrame:
    """(key, day, n, mean, m2) of the prices; combined map-side.  Rows without a time or
    a price, NaN included, do not count."""
    trades = trades.filter(F.col(time_col).isNotNull() & F.col(price).isNotNull() & ~F.isnan(price))
    return (trades.groupBy(key, F.to_date(time_col).alias("day"))
            .agg(F.count(price).alias("n"), F.avg(price).alias("mean"), F.var_pop(price).alias("_var"))
            .select(key, "day", "n", "mean", (F.col("_var") * F.col("n")).alias("m2")))


def _pooled(rows: DataFrame, group: list[str]) -> DataFrame:
    """Moments of ``rows`` merged per ``group``, about the group's least mean, so that large
    prices with a small spread do not cancel."""
    rows = rows.withColumn("_ref", F.min("mean").over(Window.partitionBy(*group)))
    shift = F.col("mean") - F.col("_ref")
    sums = rows.groupBy(*group).agg(
        F.min("_ref").alias("_ref"), F.sum("n").alias("n"), F.sum(F.col("n") * shift).alias("_s1"),
        F.sum(F.col("m2") + F.col("n") * shift * shift).alias("_s2"))
    return sums.select(*group, "n", (F.col("_ref") + F.col("_s1") / F.col("n")).alias("mean"),
                       F.greatest(F.lit(0.0), F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("n")).alias("m2"))


def merge_moments(old: DataFrame, new: DataFrame, key: str = "symbol") -> DataFrame:
    """Two tables of daily moments as one."""
    return _pooled(old.unionByName(new), [key, "day"])


def moments_before(moments: DataFrame, key: str = "symbol", lookback_days: int | None = None) -> DataFrame:
    """Per key and day: count, mean and sample deviation of all days before it (of the last
    ``lookback_days`` only, if given).  A window over one row per day of a key."""
    number = F.unix_date("day")
    first = Window.unboundedPreceding if lookback_days is None else -lookback_days
    before = Window.partitionBy(key).orderBy(number).rangeBetween(first, -1)
    shift = F.col("mean") - F.min("mean").over(Window.partitionBy(key))
    rows = moments.withColumns({"_s": shift, "_ref": F.col("mean") - shift})
    rows = rows.withColumns({
        "_n": F.sum("n").over(before), "_s1": F.sum(F.col("n") * F.col("_s")).over(before),
        "_s2": F.sum(F.col("m2") + F.col("n") * F.col("_s") * F.col("_s")).over(before)})
    spread = F.greatest(F.lit(0.0), F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("_n"))
    return rows.select(key, "day", F.coalesce("_n", F.lit(0)).alias("past_n"),
                       (F.col("_ref") + F.col("_s1") / F.col("_n")).alias("past_mean"),
                       F.when(F.col("_n") > 1, F.sqrt(spread / (F.col("_n") - 1))).alias("past_sd"))


def judged(trades: DataFrame, moments: DataFrame, std_dev: float = 3.0, key: str = "symbol", price: str = "price",
           time_col: str = "event_time", lookback_days: int | None = None) -> DataFrame:
    """``trades`` with ``is_outlier``: the price lies outside past mean +- ``std_dev`` past
    deviations.  False where fewer than two trades came before, or without a price."""
    past = (moments_before(moments, key, lookback_days)
            .select(F.col(key).alias("_key"), F.col("day").alias("_day"), "past_mean", "past_sd"))
    rows = trades.join(past, F.col(key).eqNullSafe(F.col("_key")) & (F.to_date(time_col) == F.col("_day")), "left")
    reach = F.lit(std_dev) * F.col("past_sd")
    out = ~F.col(price).between(F.col("past_mean") - reach, F.col("past_mean") + reach)
    return (rows.withColumn("is_outlier", F.coalesce(out, F.lit(False)))
            .drop("_key", "_day", "past_mean", "past_sd"))


def start_outliers(trades: DataFrame, out_path: str, moments_path: str, checkpoint: str, std_dev: float = 3.0,
                   key: str = "symbol", price: str = "price", time_col: str = "event_time",
                   lookback_days: int | None = None, trigger: str | None = None,
                   available_now: bool = False) -> StreamingQuery:
    """Every trade goes to the sink with ``is_outlier``, judged by the moments of the
    days before its own, those of its own batch included.

    The moments after batch n are a folder of their own that batch n + 1 reads, so a
    restart goes on with them, and a retried batch starts from the same ones and
    overwrites what it wrote.  A late trade is judged by what was known when it came."""
    job: list[str] = []
    out_path, moments_path = out_path.rstrip("/"), moments_path.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not job:
            job.append(query_id(spark, checkpoint))
        at = f"job={job[0]}/batch_id="
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            now = daily_moments(batch, key, price, time_col)
            if batch_id > 0:
                old = spark.read.schema(now.schema).parquet(f"{moments_path}/{at}{batch_id - 1}")
                now = merge_moments(old, now, key)
            now.write.mode("overwrite").parquet(f"{moments_path}/{at}{batch_id}")
            known = spark.read.schema(now.schema).parquet(f"{moments_path}/{at}{batch_id}")
            (judged(batch, known, std_dev, key, price, time_col, lookback_days)
             .write.mode("overwrite").parquet(f"{out_path}/{at}{batch_id}"))
        finally:
            batch.unpersist()
        if batch_id >= 2:      # the batch before this one is committed; a retry of this one reads its moments only
            _delete(spark, f"{moments_path}/{at}{batch_id - 2}")

    w = trades.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger, available_now).start()
