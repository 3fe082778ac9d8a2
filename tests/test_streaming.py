"""Streaming: bounded replays through the file source."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tickyard.operators import bars as B
from tickyard.operators.tables import read_table
from tickyard.session import fresh_dir
from tickyard.sources.adapters import message_rows, trades_from_events
from tickyard.sources.tables import table
from tickyard.streaming import jobs as J
from tickyard.plans.replay import write_message_files
from tickyard.streaming.sources import file_stream


def _dropped(q):
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in q.recentProgress for op in p.get("stateOperators", []))


def test_append_bars_equal_batch_without_open_windows_and_late_rows_dropped(spark):
    trades = trades_from_events(table(spark, SMALL, "events"))
    rows = message_rows(trades)
    late = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 5 DAYS"))
    src_path = fresh_dir(spark, "test-replay")
    write_message_files(rows.unionByName(late), src_path, 6)
    out, ck = fresh_dir(spark, "test-sink"), fresh_dir(spark, "test-ck")
    bars = J.bars_stream(J.trades_stream(file_stream(spark, src_path, 1), "5 minutes"), "1 hour")
    q = J.start_append(bars, out, ck, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert _dropped(q) > 0
    got = spark.read.parquet(out)
    wm = trades.agg(F.max("timestamp")).first()[0] - 300_000
    want = (B.ohlcv_bars(trades.withColumn("event_time", F.timestamp_millis("timestamp")), "1 hour")
            .filter(F.unix_millis("window_end") <= wm))
    cols = ["symbol", "window_start", "open_price", "close_price", "trade_count"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_replay_of_same_files_into_upsert_is_idempotent(spark):
    trades = trades_from_events(table(spark, SMALL, "events"))
    src_path = fresh_dir(spark, "test-replay")
    write_message_files(message_rows(trades), src_path, 3)
    tbl = fresh_dir(spark, "test-table")
    for _ in range(2):  # second run: new checkpoint, same input = a full replay
        ck = fresh_dir(spark, "test-ck")
        bars = J.bars_stream(J.trades_stream(file_stream(spark, src_path, 1), "5 minutes"), "1 hour")
        q = J.start_upsert(bars, tbl, ("trade_date", "symbol", "window_start"), "trade_date", ck,
                           available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    got = read_table(spark, tbl)
    assert got.count() == B.ohlcv_bars(trades, "1 hour").count()
    assert got.groupBy("symbol", "window_start").count().filter("count > 1").count() == 0


def test_await_any_stops_the_others_and_reraises(spark):
    ok = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    bad = spark.readStream.format("rate").option("rowsPerSecond", 1).load() \
        .select(F.raise_error(F.lit("boom")).alias("x"))
    q1 = ok.writeStream.format("noop").option("checkpointLocation", fresh_dir(spark, "test-ck")).start()
    q2 = bad.writeStream.format("noop").option("checkpointLocation", fresh_dir(spark, "test-ck")).start()
    with pytest.raises(RuntimeError):
        J.await_any(spark, [q1, q2], timeout=60)
    assert not q1.isActive and not q2.isActive


def test_publish_round_trip(spark):
    df = spark.createDataFrame([("A", 1.5, 10.0, 5), ("B", 2.5, 1.0, 6)],
                               "symbol string, price double, volume double, timestamp bigint")
    path = fresh_dir(spark, "test-topic")
    J.publish(df, path=path)
    got = sorted((r.key, r.value) for r in spark.read.json(path).collect())
    assert got[0][0] == "A" and '"price":1.5' in got[0][1]


def test_trades_and_bars_from_one_source(spark):
    trades = trades_from_events(table(spark, SMALL, "events"))
    rows = message_rows(trades)
    again = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))
    src_path = fresh_dir(spark, "test-replay")
    write_message_files(rows.unionByName(again), src_path, 4)
    tbl, bars_out_path = fresh_dir(spark, "test-table"), fresh_dir(spark, "test-sink")
    dlq = fresh_dir(spark, "test-dlq")
    qs = J.start_ingest(file_stream(spark, src_path, 1), tbl, bars_out_path, dlq, fresh_dir(spark, "test-ck"),
                        every="1 hour", available_now=True, buckets=2)
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None
    got = read_table(spark, tbl)
    assert got.count() == trades.count()
    assert got.select("event_id").distinct().count() == trades.count()
    assert spark.read.parquet(bars_out_path).count() > 0
    assert spark.read.parquet(dlq).count() == 0


def test_ingest_judges_once_and_loses_no_late_trade(spark):
    """Late first deliveries reach the trade table, redeliveries of any age change nothing,
    and a job started anew over the same messages doubles neither sink's trades."""
    import json
    from tickyard.functions import quality as Q
    day = 24 * 3600 * 1000

    def message(i, at, price=1.0):
        return json.dumps({"event_id": i, "symbol": "A", "price": price, "volume": 1.0, "timestamp": at})
    batches = [[message("a", 40 * day), "{"], [message("b", 50 * day)], [message("late", 41 * day)],
               [message("late", 41 * day), message("a", 40 * day), "[]"]]
    src = fresh_dir(spark, "test-replay")
    for n, batch in enumerate(batches):
        stamp = dt.datetime(2024, 1, 1 + n)
        spark.createDataFrame([("k", m, stamp) for m in batch], "key string, value string, timestamp timestamp") \
            .coalesce(1).write.mode("append").json(src)
    tbl, dlq = fresh_dir(spark, "test-table"), fresh_dir(spark, "test-dlq")
    judged = 0
    for _ in range(2):
        ck = fresh_dir(spark, "test-ck")
        checked = J.checked_stream(file_stream(spark, src, 1))
        q = (checked.writeStream.foreachBatch(J.batch_ingest(tbl, dlq, ck)).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        judged += 1
        got = {r.event_id: r.kafka_timestamp.day for r in read_table(spark, tbl).collect()}
        assert got == {"a": 1, "b": 2, "late": 3}        # the first delivery stays
        assert spark.read.parquet(dlq).count() == 2 * judged
    assert {r.error_type for r in spark.read.parquet(dlq).collect()} == set(Q.DLQ_ERROR_TYPES[:2])


def test_bars_survive_a_new_checkpoint(spark):
    """A job started anew with more data replaces old bars; with less it does not."""
    trades = trades_from_events(table(spark, SMALL, "events"))
    tbl = fresh_dir(spark, "test-table")
    for rows in (trades.filter("event_id % 2 = 0"), trades, trades.filter("event_id % 3 = 0")):
        src = fresh_dir(spark, "test-replay")
        write_message_files(message_rows(rows), src, 2)
        bars = J.bars_stream(J.trades_stream(file_stream(spark, src), "5 minutes"), "1 hour")
        q = J.start_upsert(bars, tbl, ("trade_date", "symbol", "window_start"), "trade_date",
                           fresh_dir(spark, "test-ck"), available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    cols = ["symbol", "window_start", "open_price", "close_price", "trade_count"]
    want = B.ohlcv_bars(trades.withColumn("event_time", F.timestamp_millis("timestamp")), "1 hour")
    assert sorted(map(tuple, read_table(spark, tbl).select(*cols).collect())) == sorted(
        map(tuple, want.select(*cols).collect()))


def test_routing_again_doubles_nothing(spark):
    from tickyard.functions import quality as Q
    raw = spark.createDataFrame([('{"symbol":"A","price":1,"volume":1,"timestamp":1}',), ("{",)], "value string")
    main, dlq = fresh_dir(spark, "test-sink"), fresh_dir(spark, "test-dlq")
    for _ in range(2):
        Q.write_routed(Q.validate(raw, mode="types"), main, dlq, batch_id=3)
    assert spark.read.parquet(main).count() == 1 and spark.read.parquet(dlq).count() == 1


def test_basic_bar_stream_update_mode(spark):
    trades = trades_from_events(table(spark, SMALL, "events"))
    src = fresh_dir(spark, "test-replay")
    write_message_files(message_rows(trades), src, 3)
    tbl = fresh_dir(spark, "test-table")
    bars = J.bars_stream(J.trades_stream(file_stream(spark, src), "5 minutes"), "1 hour", shape="basic")
    q = J.start_upsert(bars, tbl, ("trade_date", "symbol", "window_start"), "trade_date",
                       fresh_dir(spark, "test-ck"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    got = read_table(spark, tbl)
    assert {"avg_price", "max_price", "min_price", "total_volume", "trade_count"} <= set(got.columns)
    assert got.count() == B.basic_bars(trades, "1 hour").count()
