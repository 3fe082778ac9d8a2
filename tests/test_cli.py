from pyspark.sql import functions as F

from conftest import SMALL
from tickyard import cli
from tickyard.operators import tables as K
from tickyard.session import fresh_dir
from tickyard.sources.adapters import message_rows, trades_from_events
from tickyard.sources.tables import table
from tickyard.plans.replay import write_message_files


def test_backfill_command(spark):
    t = trades_from_events(table(spark, SMALL, "events")).withColumn("trade_date", F.to_date("event_time"))
    src, dst = fresh_dir(spark, "test-src"), fresh_dir(spark, "test-dst")
    K.write_layout(t, "trade_date").write.partitionBy("trade_date").parquet(src)
    cli.main(["backfill", "--source", src, "--target", dst, "--start", "2024-01-05", "--end", "2024-01-06",
              "--granularity", "hourly"])
    got = spark.read.parquet(dst)
    want = t.filter(F.col("trade_date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-06").cast("date")))
    assert got.count() == want.count() > 0
    assert got.select(F.length("date_bucket")).distinct().first()[0] == 10


def test_ingest_command_available_now(spark):
    trades = trades_from_events(table(spark, SMALL, "events"))
    src = fresh_dir(spark, "test-replay")
    write_message_files(message_rows(trades), src, 2)
    tbl, bars, ck = fresh_dir(spark, "test-t"), fresh_dir(spark, "test-b"), fresh_dir(spark, "test-ck")
    cli.main(["ingest", "--files", src, "--trades-table", tbl, "--bars-path", bars, "--checkpoint", ck,
              "--window", "1 hour", "--available-now", "--dlq-path", fresh_dir(spark, "test-dlq")])
    assert spark.read.parquet(tbl).count() == trades.count()


def test_backfill_command_from_files(spark):
    t = trades_from_events(table(spark, SMALL, "events")).withColumnRenamed("event_time", "trade_time")
    src, dst = fresh_dir(spark, "test-files"), fresh_dir(spark, "test-dst")
    t.write.parquet(src)
    cli.main(["backfill", "--files", "--source", src, "--target", dst, "--start", "2024-01-10 00:00:00",
              "--end", "2024-01-11", "--time-col", "trade_time"])
    got = spark.read.parquet(dst)
    want = t.filter((F.col("trade_time") >= F.lit("2024-01-10").cast("timestamp"))
                    & (F.col("trade_time") < F.lit("2024-01-12").cast("timestamp")))
    assert got.count() == want.count() > 0
    assert {"trade_year", "trade_month", "trade_day", "trade_hour"} <= set(got.columns)
