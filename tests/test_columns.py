import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickyard.functions import columns as C
from tickyard.functions import parse as P
from tickyard.schemas import TRADE_V1


EDGES = [(dt.datetime(2023, 12, 31, 23, 59, 59, 999999), ("20231231", "2023123123", "202312")),
         (dt.datetime(2024, 1, 1), ("20240101", "2024010100", "202401")),
         (dt.datetime(2024, 2, 29, 7, 5), ("20240229", "2024022907", "202402")),
         (dt.datetime(2024, 3, 10, 2, 30), ("20240310", "2024031002", "202403")),     # skipped in New York
         (dt.datetime(1969, 12, 31, 5), ("19691231", "1969123105", "196912"))]


def test_buckets_at_calendar_edges(spark):
    df = spark.createDataFrame([(t,) for t, _ in EDGES], "t timestamp")
    got = df.select(*[C.date_bucket("t", g).alias(g) for g in ("daily", "hourly", "monthly")]).collect()
    assert [tuple(r) for r in got] == [want for _, want in EDGES]
    parts = C.add_partitioning_columns(df, "t").collect()
    assert [(r.trade_year, r.trade_month, r.trade_day, r.trade_hour) for r in parts] == [
        (t.year, t.month, t.day, t.hour) for t, _ in EDGES]
    with pytest.raises(ValueError):
        C.date_bucket("t", "weekly")


def test_epoch_ms_exact(spark):
    df = spark.range(1_700_000_000_000, 1_700_000_000_000 + 5000)
    bad = df.filter(F.unix_millis(C.epoch_ms_to_ts("id")) != F.col("id")).count()
    assert bad == 0


def test_market_hours_new_york(spark):
    rows = [(dt.datetime(2024, 1, 5, 14, 29),), (dt.datetime(2024, 1, 5, 14, 30),),
            (dt.datetime(2024, 1, 5, 20, 59),), (dt.datetime(2024, 1, 5, 21, 0),),
            (dt.datetime(2024, 1, 6, 15, 0),)]
    df = spark.createDataFrame(rows, "event_time timestamp")
    got = [r[0] for r in df.select(C.market_hours("event_time", weekdays_only=True)).collect()]
    assert got == [False, True, True, False, False]


def test_volume_class_null_is_normal(spark):
    df = spark.createDataFrame([(None,), (1000.0,), (1000.5,)], "volume double")
    got = [r[0] for r in df.select(C.volume_class("volume")).collect()]
    assert got == ["normal_volume", "normal_volume", "high_volume"]


def test_conform_v2_defaults(spark):
    df = spark.createDataFrame([("A", 1.0, 1, 1.0, [], 1)], TRADE_V1)
    r = C.conform_v2(df).first()
    assert r.is_market_hours is False and r.metadata == {} and r.exchange is None


def test_parse_flags_malformed(spark):
    rows = spark.createDataFrame([(b"k", b'{"symbol":"A","price":1.5,"timestamp":5,"volume":2}'),
                                  (b"k", b"{not json")], "key binary, value binary") \
        .withColumn("timestamp", F.current_timestamp())
    got = P.parse_messages(rows).select("symbol", "_parse_ok").collect()
    assert [(r.symbol, r._parse_ok) for r in got] == [("A", True), (None, False)]


def test_fill_event_id_keeps_given_and_is_stable(spark):
    df = spark.createDataFrame([("x", "A", 1.0, 2.0, 3), (None, "A", 1.0, 2.0, 3)],
                               "event_id string, symbol string, price double, volume double, timestamp bigint")
    a = [r.event_id for r in P.fill_event_id(df).collect()]
    b = [r.event_id for r in P.fill_event_id(df).collect()]
    assert a[0] == "x" and len(a[1]) == 64 and a == b


def test_flatten_envelope_filters_type(spark):
    env = spark.createDataFrame(
        [('{"type":"trade","data":[{"s":"A","p":1.0,"t":1,"v":2.0},{"s":"B","p":2.0,"t":2,"v":1.0,"c":["1"]}]}',),
         ('{"type":"ping"}',)], "value string")
    out = P.flatten_envelopes(env).orderBy("symbol").collect()
    assert [(r.symbol, r.conditions) for r in out] == [("A", []), ("B", ["1"])]


def test_envelope_messages_keep_raw_types(spark):
    import json
    env = spark.createDataFrame(
        [('{"type":"trade","data":[{"s":"AAPL","p":"150.5","t":1706659200000,"v":10},'
          '{"s":"X","p":1,"t":"x","v":null,"c":["1"]},{"s":"Y","p":2,"t":3}]}',),
         ('{"type":"ping"}',), ("not json",)], "value string")
    got = [(r.key, json.loads(r.value)) for r in P.envelope_messages(env, processed_at=F.lit(7)).collect()]
    assert [k for k, _ in got] == ["AAPL", "X", "Y"]
    assert got[0][1] == {"symbol": "AAPL", "price": "150.5", "volume": 10, "timestamp": 1706659200000,
                         "conditions": [], "processed_at": 7}
    assert got[1][1]["volume"] is None and got[1][1]["conditions"] == ["1"]
    assert "volume" not in got[2][1]


def test_trade_table_shapes(spark):
    from tickyard.sources.adapters import trades_from_events
    from tickyard.sources.tables import table
    from conftest import SMALL
    t = trades_from_events(table(spark, SMALL, "events"))
    v2 = C.to_trade_table(t, "v2")
    assert v2.columns == C.TRADE_TABLE_V2
    r = v2.orderBy("timestamp").first()
    assert (r.trade_year, r.trade_month) == (2024, 1) and r.trade_time is not None
    v1 = C.to_trade_table(t, "v1")
    assert v1.columns == C.TRADE_TABLE_V1 and v1.first().date_bucket.startswith("202401")


def test_conform_v2_keeps_present_values_and_fills_nulls(spark):
    from tickyard.schemas import TRADE_V2
    df = spark.createDataFrame([("A", 1.0, 1, 1.0, [], 1, "X", "t1", 0.9, 1.1, True, {"k": "v"}),
                                ("B", 1.0, 1, 1.0, [], 1, None, None, None, None, None, None)], TRADE_V2)
    rows = {r.symbol: r for r in C.conform_v2(df).collect()}
    assert rows["A"].exchange == "X" and rows["A"].is_market_hours is True and rows["A"].metadata == {"k": "v"}
    assert rows["B"].is_market_hours is False and rows["B"].metadata == {} and rows["B"].bid_price is None
