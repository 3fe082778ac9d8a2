"""Counters of a running job: every batch once, late rows as the engine counts them."""

import datetime as dt
import json

import pytest

from tickyard.session import fresh_dir
from tickyard.streaming import job_metrics as JM
from tickyard.streaming import jobs as J
from tickyard.streaming.sources import file_stream

T0 = dt.datetime(2024, 1, 1, 15)


def message(i, minute):
    at = int((T0 + dt.timedelta(minutes=minute)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return json.dumps({"event_id": str(i), "symbol": "A", "price": 1.0, "volume": 2.0, "timestamp": at})


BATCHES = [[message(1, 0), message(2, 1), "{broken"], [message(3, 60)], [message(4, 2), message(5, 61), "{}"], ["[]", message(6, 3)]]


@pytest.fixture()
def replay(spark):
    path = fresh_dir(spark, "test-replay")
    for batch in BATCHES:
        rows = [("k", m, T0) for m in batch]
        spark.createDataFrame(rows, "key string, value string, timestamp timestamp").coalesce(1) \
            .write.mode("append").json(path)
    return path


def run(spark, watch, path, out, ck):
    checked = JM.counted(J.checked_stream(file_stream(spark, path, 1)))
    q = J.start_append(J.trades_stream(None, "5 minutes", checked=checked), out, ck, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    watch.wait(q)
    return q


def test_counts_of_all_batches(spark, replay):
    out, ck, kept = (fresh_dir(spark, f"test-{k}") for k in ("out", "ck", "metrics"))
    watch = JM.JobMetrics(spark, kept)
    spark.streams.addListener(watch)
    try:
        q = run(spark, watch, replay, out, ck)
        rows = JM.read_metrics(spark, kept).collect()
        dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                      for op in json.loads(p.json if hasattr(p, "json") else json.dumps(p)).get("stateOperators", []))
        assert {r.job for r in rows} == {str(q.id)}
        total = [sum(r[c] for r in rows) for c in ("n_received", "n_sent", "n_rejected", "n_late")]
        assert total == [9, 6, 3, dropped] and dropped == 1
        # a second run has nothing new to read: no batch is counted again
        run(spark, watch, replay, out, ck)
        again = JM.read_metrics(spark, kept).collect()
        assert sum(r.n_received for r in again) == 9
        assert spark.read.parquet(out).count() == 6 - dropped
    finally:
        spark.streams.removeListener(watch)


def test_a_repeated_report_overwrites(spark):
    kept = fresh_dir(spark, "test-metrics")
    watch = JM.JobMetrics(spark, kept)
    report = {"id": "q", "name": None, "batchId": 3, "timestamp": "2024-01-01T00:00:00Z",
              "observedMetrics": {JM.COUNTS: {"n_received": 4, "n_sent": 3, "n_rejected": 1}}, "stateOperators": []}
    for _ in range(2):
        watch.record(report)
    watch.record({**report, "batchId": 4, "observedMetrics": {}})
    rows = {r.batch_id: (r.n_received, r.n_sent, r.n_rejected, r.n_late) for r in JM.read_metrics(spark, kept).collect()}
    assert rows == {3: (4, 3, 1, 0), 4: (0, 0, 0, 0)}
