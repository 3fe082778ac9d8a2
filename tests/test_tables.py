import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tickyard.operators import dedupe as U
from tickyard.operators import tables as K
from tickyard.session import fresh_dir

SCHEMA = "trade_date date, symbol string, event_id string, price double, version bigint"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
KEYS = ("trade_date", "symbol", "event_id")


def _content(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).select(
        "trade_date", "symbol", "event_id", "price", "version").collect())


def test_upsert_last_version_wins_and_replay_is_noop(spark):
    path = fresh_dir(spark, "test-tables")
    a = _df(spark, [(D1, "A", "1", 1.0, 1), (D2, "A", "2", 2.0, 1)])
    b = _df(spark, [(D2, "A", "2", 20.0, 2), (D3, "A", "3", 3.0, 2)])
    K.upsert(a, path, KEYS, "version", "trade_date")
    K.upsert(b, path, KEYS, "version", "trade_date")
    first = _content(spark, path)
    assert first == [(D1, "A", "1", 1.0, 1), (D2, "A", "2", 20.0, 2), (D3, "A", "3", 3.0, 2)]
    K.upsert(a, path, KEYS, "version", "trade_date")  # old batch replayed
    K.upsert(b, path, KEYS, "version", "trade_date")  # same batch twice
    assert _content(spark, path) == first
    assert K.upsert(a.limit(0), path, KEYS, "version", "trade_date")["written"] is False


def test_upsert_requires_partition_in_key(spark):
    import pytest
    with pytest.raises(ValueError):
        K.upsert(_df(spark, [(D1, "A", "1", 1.0, 1)]), fresh_dir(spark, "t"), ("symbol",), "version",
                 "trade_date")


def test_expire_and_scan_range(spark):
    path = fresh_dir(spark, "test-tables")
    df = _df(spark, [(D1, "A", "1", 1.0, 1), (D2, "A", "2", 2.0, 1), (D3, "A", "3", 3.0, 1)])
    df.write.partitionBy("trade_date").parquet(path)
    s = spark.read.schema(SCHEMA).parquet(path)
    assert K.scan_range(spark, path, "2024-01-02", "2024-01-03", schema=s.schema).count() == 2
    plan = K.scan_range(spark, path, "2024-01-02", "2024-01-03", schema=s.schema)._jdf \
        .queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    gone = K.expire(spark, path, 1, "2024-01-03 12:00:00", schema=s.schema)
    assert gone == [D1]
    assert [r.event_id for r in spark.read.schema(SCHEMA).parquet(path).collect()] != []
    assert sorted(r.event_id for r in spark.read.schema(SCHEMA).parquet(path).collect()) == ["2", "3"]


def test_dedupe_hot_key_defined_survivor(spark):
    base = spark.range(5000).select(
        F.lit("HOT").alias("symbol"), F.lit("x").alias("event_id"),
        (F.col("id") % 97).cast("double").alias("price"), F.lit(1.0).alias("volume"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 13).alias("event_time"))
    r = U.dedupe(base.repartition(7), ("symbol", "event_id")).collect()
    assert len(r) == 1
    assert r[0].event_time == base.agg(F.min("event_time")).first()[0]
    assert r[0].price == 0.0


def test_failed_merge_leaves_the_table_as_it_was(spark):
    path = fresh_dir(spark, "test-tables")
    K.upsert(_df(spark, [(D1, "A", "1", 1.0, 1), (D2, "A", "2", 2.0, 1)]), path, KEYS, "version", "trade_date")
    before = _content(spark, path)
    bad = F.when(F.col("price") > 10, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("version"))
    with pytest.raises(Exception, match="stop"):
        K.upsert(_df(spark, [(D1, "A", "3", 3.0, 2), (D2, "A", "2", 20.0, 2)]), path, KEYS, bad, "trade_date")
    assert _content(spark, path) == before
    K.upsert(_df(spark, [(D2, "A", "2", 20.0, 2)]), path, KEYS, "version", "trade_date")
    assert _content(spark, path) == [before[0], (D2, "A", "2", 20.0, 2)]


def test_table_folder_holds_data_only(spark):
    path = fresh_dir(spark, "test-tables")
    for price in (1.0, 2.0):
        K.upsert(_df(spark, [(D1, "A", "1", price, 1)]), path, KEYS, "version", "trade_date", buckets=4)
    top = [n for n in os.listdir(path) if not n.startswith(".")]
    assert [n for n in top if n != "_SUCCESS"] == ["trade_date=2024-01-01"]


def test_upsert_reports_rows_without_extra_job(spark):
    path = fresh_dir(spark, "test-tables")
    out = K.upsert(_df(spark, [(D1, "A", "1", 1.0, 1), (D1, "A", "2", 1.0, 1)]), path, KEYS, "version",
                   "trade_date")
    assert out["rows"] == 2 and out["partitions"] == 1


def test_repartition_by_symbol_splits_a_hot_symbol(spark):
    df = spark.range(4000).select(F.lit("HOT").alias("symbol"), F.col("id").cast("string").alias("event_id"))
    sizes = [r[0] for r in K.repartition_by_symbol(df, 16, salt=8).groupBy(F.spark_partition_id())
             .count().select("count").collect()]
    assert len(sizes) > 1 and max(sizes) < 4000
    plain = K.repartition_by_symbol(df, 16, salt=1).groupBy(F.spark_partition_id()).count().count()
    assert plain == 1


def test_upsert_caps_records_per_file(spark):
    import glob
    path = fresh_dir(spark, "test-tables")
    rows = [(D1, "A", str(i), float(i), 1) for i in range(50)]
    K.upsert(_df(spark, rows), path, KEYS, "version", "trade_date", max_records_per_file=10)
    assert len(glob.glob(path.replace("file:", "") + "/trade_date=*/*.parquet")) >= 5
    K.upsert(_df(spark, rows[:5]), path, KEYS, "version", "trade_date", max_records_per_file=10)
    assert spark.read.parquet(path).count() == 50


def test_rows_without_a_day_are_kept_and_replaced(spark):
    path = fresh_dir(spark, "test-tables")
    for k, price in (("1", 1.0), ("2", 2.0), ("3", 3.0), ("1", 9.0)):
        K.upsert(_df(spark, [(None, "A", k, price, int(price))]), path, KEYS, "version", "trade_date")
    K.upsert(_df(spark, [(D1, "A", "1", 5.0, 1)]), path, KEYS, "version", "trade_date")
    assert sorted((r.trade_date is None, r.event_id, r.price) for r in K.read_table(spark, path).collect()) == [
        (False, "1", 5.0), (True, "1", 9.0), (True, "2", 2.0), (True, "3", 3.0)]
    assert K.expire(spark, path, 1, "2024-02-01") == [D1]
    assert K.read_table(spark, path).count() == 3


def test_rows_without_an_id_are_not_merged(spark):
    path = fresh_dir(spark, "test-tables")
    rows = [(D1, "A", None, float(i), 1) for i in range(5)] + [(D1, "A", None, 0.0, 1)]
    for _ in range(2):      # the replay doubles nothing
        K.upsert(_df(spark, rows), path, KEYS, "version", "trade_date")
    assert sorted(r.price for r in K.read_table(spark, path).collect()) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_columns_come_and_stay(spark):
    path = fresh_dir(spark, "test-tables")
    K.upsert(_df(spark, [(D1, "A", "1", 1.0, 1), (D2, "A", "2", 2.0, 1)]).withColumn("note", F.lit("old")),
             path, KEYS, "version", "trade_date")
    K.upsert(_df(spark, [(D1, "A", "3", 3.0, 1)]), path, KEYS, "version", "trade_date")
    K.upsert(_df(spark, [(D2, "A", "4", 4.0, 1)]).withColumn("extra", F.lit(7)), path, KEYS, "version", "trade_date")
    got = {r.event_id: (r.note, r.extra) for r in K.read_table(spark, path).collect()}
    assert got == {"1": ("old", None), "2": ("old", None), "3": (None, None), "4": (None, 7)}
    with pytest.raises(ValueError):
        K.upsert(_df(spark, [(D1, "A", "5", 3.0, 1)]).withColumn("note", F.lit(1)), path, KEYS, "version", "trade_date")


def test_small_batch_rewrites_one_bucket(spark):
    path = fresh_dir(spark, "test-tables")
    rows = [(D1, "A", str(i), 1.0, 1) for i in range(400)]
    K.upsert(_df(spark, rows), path, KEYS, "version", "trade_date", buckets=8)
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*/part-*")}
    before = files()
    out = K.upsert(_df(spark, [(D1, "A", "7", 2.0, 2)]), path, KEYS, "version", "trade_date", buckets=3)
    after = files()
    changed = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(after.items())}
    assert out["folders"] == 1 and len(changed) == 1 and len({os.path.dirname(f) for f in after}) == 8
    got = {r.event_id: r.price for r in K.read_table(spark, path).collect()}
    assert len(got) == 400 and got["7"] == 2.0 and not any("bucket" in c for c in K.read_table(spark, path).columns)


def test_newer_write_wins_at_equal_versions(spark):
    path = fresh_dir(spark, "test-tables")
    for price in (5.0, 2.0):
        K.upsert(_df(spark, [(D1, "A", "1", price, 1)]), path, KEYS, "version", "trade_date")
    assert _content(spark, path) == [(D1, "A", "1", 2.0, 1)]


def test_input_is_evaluated_once(spark):
    """A day that depends on when it is computed does not disturb other days."""
    path = fresh_dir(spark, "test-tables")
    K.upsert(_df(spark, [(D1, "A", "1", 1.0, 1), (D2, "A", "2", 1.0, 1), (D3, "A", "3", 1.0, 1)]), path, KEYS,
             "version", "trade_date")
    moving = spark.range(1).select(
        F.element_at(F.array(*[F.lit(d) for d in (D1, D2, D3)]), (F.floor(F.rand() * 3) + 1).cast("int")).alias("trade_date"),
        F.lit("A").alias("symbol"), F.lit("9").alias("event_id"), F.lit(9.0).alias("price"),
        F.lit(1).cast("bigint").alias("version"))
    K.upsert(moving, path, KEYS, "version", "trade_date")
    assert sorted(r.event_id for r in K.read_table(spark, path).collect()) == ["1", "2", "3", "9"]


def test_dedupe_keeps_trades_without_an_id(spark):
    df = spark.createDataFrame([("A", None, 1.0), ("A", None, 2.0), ("A", None, 2.0), ("A", "x", 3.0), ("A", "x", 4.0)],
                               "symbol string, event_id string, price double")
    assert sorted(r.price for r in U.dedupe(df, ("symbol", "event_id"), ("price",)).collect()) == [1.0, 2.0, 3.0]


def test_end_time_is_inclusive_to_the_microsecond(spark):
    path = fresh_dir(spark, "files")
    spark.sql("SELECT timestamp_micros(1704067200000000 + id * 100) AS trade_time FROM range(20)").write.parquet(path)
    assert K.load_historical(spark, path, "2024-01-01 00:00:00", "2024-01-01 00:00:00.000500").count() == 6
    assert K.load_historical(spark, path, "2024-01-01", "2024-01-01").count() == 20


def _source(spark, rows, **layout):
    path = fresh_dir(spark, "test-source")
    df = spark.createDataFrame(rows, "trade_date date, symbol string, event_id string, event_time timestamp, "
                                     "price double, version bigint, extra map<string,string>")
    df.repartition(layout.get("files", 1)).write.partitionBy("trade_date").parquet(path)
    return path, df.schema


def test_backfill_copies_only_days_that_differ(spark):
    def row(d, i, price=1.0, version=1, extra=None):
        return (d, "A" if i % 2 else None, str(i), dt.datetime.combine(d, dt.time(1)), price, version, extra)
    rows = [row(d, i, extra={"b": "1", "a": "2"} if i == 3 else None) for d in (D1, D2, D3) for i in range(20)]
    target = fresh_dir(spark, "test-target")

    def copy(source_rows, **layout):
        source, schema = _source(spark, source_rows, **layout)
        return K.backfill_changed(spark, source, target, D1, D3, KEYS, "version", schema=schema)

    assert copy(rows) == [str(D1), str(D2), str(D3)]
    assert copy(list(reversed(rows)), files=5) == []      # other order, other files
    assert copy([r if r[:3] != (D2, "A", "7") else row(D2, 7, 2.0, 2) for r in rows]) == [str(D2)]
    assert K.read_table(spark, target).filter("price = 2.0").count() == 1
    # a value that moves from one nullable column to another, a map entry, a repeated row
    assert copy([r if r[:3] != (D3, "A", "3") else row(D3, 3, extra={"a": "1", "b": "2"}, version=3) for r in rows]) == [
        str(D2), str(D3)]     # D2 holds the newer version, which stays
    assert K.read_table(spark, target).count() == 60


def test_fingerprints_tell_repeated_rows_and_null_places_apart(spark):
    def prints(rows):
        df = spark.createDataFrame(rows, "trade_date date, symbol string, a string, b string")
        return sorted(map(tuple, K.fingerprints(df, ["trade_date", "symbol"]).collect()))
    assert prints([(D1, "A", "x", None)]) != prints([(D1, "A", None, "x")])
    assert prints([(D1, "A", "x", "y")]) != prints([(D1, "A", "x", "y")] * 2)
    assert prints([(D1, "A", "x", "y"), (D1, "A", "z", "y")]) == prints([(D1, "A", "z", "y"), (D1, "A", "x", "y")])
    assert prints([]) == []
