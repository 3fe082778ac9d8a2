"""Plan properties that matter at scale, checked on the executed plans."""

import pytest

import __spark_entry__ as E
from tickyard.plans import QUERIES
from conftest import SMALL
from tickyard.operators import bars as B
from tickyard.operators import dedupe as U
from tickyard.operators import reads as R
from tickyard.sources.adapters import trades_from_events, trades_from_lineitem
from tickyard.sources.tables import table

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_registered_queries(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)


def test_bars_and_dedupe_combine_map_side(spark):
    li = trades_from_lineitem(table(spark, SMALL, "lineitem"))
    assert "partial_min_by" in _plan(B.ohlcv_bars(li, "1 day"))
    assert "partial_min_by" in _plan(U.deduplicate_trades(li, legacy_key=True))
    assert "partial_max_by" in _plan(R.latest_price(li))


def test_adapter_prunes_columns(spark):
    plan = _plan(trades_from_events(table(spark, SMALL, "events")).select("symbol", "price"))
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "user_id" not in scan and "props" not in scan and "value" in scan


def test_symbol_day_read_pushes_filters(spark):
    t = trades_from_events(table(spark, SMALL, "events"))
    plan = _plan(R.recent_trades(t, "click", "2024-01-15", 0, 10))
    assert "EqualTo(event_type,click)" in plan and "GreaterThanOrEqual(ts," in plan


def test_bar_reads_prune_date_partitions(spark):
    from pyspark.sql import functions as F
    from tickyard.session import fresh_dir
    bars = B.ohlcv_bars(trades_from_events(table(spark, SMALL, "events")), "1 hour") \
        .withColumn("trade_date", F.to_date("window_start"))
    path = fresh_dir(spark, "test-bars")
    bars.write.partitionBy("trade_date").parquet(path)
    t = spark.read.parquet(path)
    for df in (R.top_volume(t, "2024-01-31 00:00:00", hours=24),
               R.price_trend(t, ["click"], since="2024-01-29 00:00:00"),
               R.bars_range(t, "view", "2024-01-10 00:00:00", "2024-01-12 23:00:00")):
        plan = _plan(df)
        assert "PartitionFilters: [isnotnull(trade_date" in plan and "trade_date#" in plan.split("PartitionFilters")[1][:200]


def test_latest_price_fast_path_is_hash_aggregate_and_agrees(spark):
    from tickyard.sources.adapters import wide_trades_from_events
    t = wide_trades_from_events(table(spark, SMALL, "events"))
    fast = R.latest_price(t, exact=False)
    assert "HashAggregate" in _plan(fast) and "SortAggregate" not in _plan(fast)
    exact = R.latest_price(t).select("symbol", "price", "timestamp")
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, exact.collect()))
