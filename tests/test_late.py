"""Late rows go to a sink of their own: nothing is lost, and the split is that of a watermark."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation, functions as F

from tickyard.session import fresh_dir
from tickyard.streaming import late as L
from tickyard.streaming.sources import file_stream

T0 = dt.datetime(2024, 1, 1)
MINUTES = [[0, 1, None, 10], [5, 4, 12, 20], [15, 14, 16, 3, 15], [100], [95, 94, 96, 0, 95, None]]   # by batch


def files(spark, batches, path=None):
    """One file per batch, one after the other; the key is the row's number, the value its event time."""
    path = path or fresh_dir(spark, "test-replay")
    for b, batch in enumerate(batches):
        rows = [(f"{b}-{i}", None if m is None else str(T0 + dt.timedelta(minutes=m)), T0) for i, m in enumerate(batch)]
        df = spark.createDataFrame(rows, "key string, value string, timestamp timestamp")
        df.coalesce(1).write.mode("append").json(path)
    return path


def stream(spark, path):
    return file_stream(spark, path, 1).select(F.col("key").cast("string").alias("id"),
                                              F.col("value").cast("string").cast("timestamp").alias("event_time"))


def split(spark, path, dirs):
    q = L.start_split(stream(spark, path), *dirs, delay="5 minutes", available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def ids(spark, path):
    return Counter(r.id for r in spark.read.parquet(path).select("id").collect())


def dirs_of(spark):
    return [fresh_dir(spark, f"test-{k}") for k in ("main", "late", "marks", "ck")]


def expected(batches):
    top, late = None, set()
    for b, batch in enumerate(batches):
        late |= {f"{b}-{i}" for i, m in enumerate(batch) if m is not None and top is not None and m <= top - 5}
        top = max([m for m in batch if m is not None] + ([top] if top is not None else []))
    return late


def test_split_is_that_of_a_watermark(spark):
    path, dirs = files(spark, MINUTES), dirs_of(spark)
    split(spark, path, dirs)
    everything = {f"{b}-{i}" for b, batch in enumerate(MINUTES) for i in range(len(batch))}
    late, main = ids(spark, dirs[1]), ids(spark, dirs[0])
    assert late + main == Counter(everything) and set(late) == expected(MINUTES)
    key = "spark.sql.streaming.statefulOperator.allowMultiple"      # off: rows are judged by the newest watermark
    spark.conf.set(key, "false")
    try:
        deduped = stream(spark, path).filter("event_time is not null").withWatermark("event_time", "5 minutes") \
            .dropDuplicatesWithinWatermark(["id"])
        q = deduped.writeStream.format("noop").option("checkpointLocation", fresh_dir(spark, "test-ck")) \
            .trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.unset(key)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == len(late) > 0


def test_restart_goes_on_with_the_mark(spark):
    path, dirs = files(spark, MINUTES[:3]), dirs_of(spark)
    split(spark, path, dirs)
    files(spark, [[1], [30]], path)       # 1 is late by the mark of the first run
    split(spark, path, dirs)
    assert sum(ids(spark, dirs[1]).values()) == len(expected(MINUTES[:3])) + 1
    assert sum(ids(spark, dirs[0]).values()) + sum(ids(spark, dirs[1]).values()) == sum(map(len, MINUTES[:3])) + 2


def test_retry_of_a_batch_changes_nothing(spark, monkeypatch):
    """A crash after the third batch's sinks, before its mark: the batch runs again over its folders."""
    path, dirs = files(spark, MINUTES), dirs_of(spark)
    calls = []

    class Lost(Observation):
        def __init__(self):
            super().__init__()
            calls.append(1)

        @property
        def get(self):
            if len(calls) == 3:
                raise RuntimeError("lost")
            return super().get
    with monkeypatch.context() as m:
        m.setattr(L, "Observation", Lost)
        with pytest.raises(StreamingQueryException, match="lost"):
            split(spark, path, dirs)
    assert len(calls) == 3
    split(spark, path, dirs)
    assert set(ids(spark, dirs[1])) == expected(MINUTES)
    assert sum(ids(spark, dirs[0]).values()) + sum(ids(spark, dirs[1]).values()) == sum(map(len, MINUTES))
