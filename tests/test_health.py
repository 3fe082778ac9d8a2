import datetime as dt
import random

from pyspark.sql import functions as F

from tickyard.functions import quality as Q
from tickyard.operators import metrics as M
from tickyard.session import fresh_dir
from tickyard.streaming import health as H, jobs as J

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, event_time timestamp"


def trades(spark, seed=1, n=400):
    r = random.Random(seed)
    rows = [(r.choice(["A", "A", "A", "B", None]), T0 + dt.timedelta(milliseconds=r.randrange(20_000_000))) for _ in range(n)]
    edge = dt.timedelta(minutes=2)
    more = T0 + 2 * edge + dt.timedelta(milliseconds=1)
    rows += [("E", T0), ("E", T0 + edge), ("E", more), ("E", more), ("N", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_silences_equal_the_batch_gaps(spark):
    df = trades(spark)
    got = {(r.symbol, r.silent_since) for r in H.silences(df, dt.timedelta(minutes=2)).collect()}
    gaps = M.silence_gaps(df.filter("event_time is not null"), "2 minutes", as_of=T0 + dt.timedelta(days=1))
    want = {(r.symbol, r.t) for r in gaps.select("symbol", F.timestamp_millis("gap_start_ms").alias("t")).collect()}
    assert got == want and ("E", T0) not in got and ("E", T0 + dt.timedelta(minutes=2)) in got
    assert H.silences(df.filter("false")).collect() == []


def test_rate_episodes_equal_the_batch_alerts(spark):
    df = trades(spark, 2, 900).filter("event_time is not null")
    minute = dt.timedelta(minutes=1)
    cols = ["first_slot", "last_slot", "n_slots", "n_events"]
    for most, hold, keys in ((2, 1, []), (2, 3, []), (1, 2, ["symbol"]), (50, 1, [])):
        got = H.rate_episodes(df, most, hold, minute, keys).select(*keys, *cols).collect()
        want = M.threshold_alerts(M.slot_counts(df, "1 minute", keys), most, hold, keys).select(*keys, *cols).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_health_streams_wait_for_the_watermark(spark):
    """Late rows within the delay still count; what the watermark has not passed is not written."""
    src = fresh_dir(spark, "test-health")
    at = lambda m: T0 + dt.timedelta(minutes=m)
    for part in ([("A", at(0)), ("A", at(30))], [("A", at(25)), ("B", at(29))], [("A", at(60))]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src).withWatermark("event_time", "10 minutes")
    out = fresh_dir(spark, "test-sink")
    q = J.start_append(H.silences(stream, dt.timedelta(minutes=10)), out, fresh_dir(spark, "test-ck"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert {(r.symbol, r.silent_since) for r in spark.read.parquet(out).collect()} == {
        ("A", at(0)), ("A", at(30)), ("B", at(29))}


def test_merged_sketches_of_any_span(spark):
    r = random.Random(4)
    values = sorted(r.expovariate(1) * 1000 for _ in range(6000))
    rows = [("A", T0 + dt.timedelta(seconds=r.randrange(86_400)), 0, int(v * 1000)) for v in values] + [("A", T0, 0, None)]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp, timestamp bigint, processed_at bigint")
    sketches = M.latency_sketches(df)
    assert sketches.count() == 24
    for q in (0.5, 0.95):
        got = M.sketch_quantile(sketches, q).first()
        rank = sum(int(v * 1000) / 1000 <= got["quantile"] for v in values) / len(values)
        assert got.n == 6000 and abs(rank - q) <= M.SKETCH_ERROR
    assert M.sketch_quantile(sketches, 0.95, span="6 hours").count() == 4
    assert M.sketch_quantile(M.latency_sketches(df.filter("false"))).collect() == []


def test_a_new_checkpoint_keeps_the_routed_batches(spark):
    """Both jobs number their first batch 0; neither overwrites the other's rows."""
    main, dlq = fresh_dir(spark, "test-sink"), fresh_dir(spark, "test-dlq")
    for value in ('{"symbol":"A","price":1,"volume":1,"timestamp":1}', '{"symbol":"B","price":1,"volume":1,"timestamp":1}'):
        src = fresh_dir(spark, "test-src")
        spark.createDataFrame([(value,), ("{",)], "value string").coalesce(1).write.text(src)
        q = J.start_validated_routing(spark.readStream.text(src), main, dlq, fresh_dir(spark, "test-ck"), mode="types",
                                      available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    assert {r.symbol for r in spark.read.parquet(main).collect()} == {"A", "B"}
    assert spark.read.parquet(dlq).count() == 2


def test_maps_are_part_of_a_row_without_a_key(spark):
    from tickyard.operators.dedupe import dedupe
    rows = [(None, {"a": "1", "b": "2"}), (None, {"b": "2", "a": "1"}), (None, {"a": "2"}), ("x", {"a": "1"}), ("x", {})]
    df = spark.createDataFrame(rows, "event_id string, extra map<string,string>")
    assert dedupe(df, ["event_id"]).count() == 3
    assert Q.validate(df.selectExpr("'{}' AS value"), mode="types").select("errors").count() == 5
