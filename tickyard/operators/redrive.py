"""Dead letters judged again (D11): attempts are counted, accepted messages move, the rest is parked.

The folders are those of the routing job (``job=.../batch_id=...`` below the
main and the dead-letter path); a re-drive only adds to them.  Where a message
is follows from its rows, so no write has to be taken back after a crash.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.quality import dlq_records, invalid_rows, valid_trades, validate
from .tables import _fs

JOB = "redrive"
MAX_RETRIES = 3


def letter_id() -> Column:
    """A message's identity: its broker position, else its topic, key and text (two
    equal messages without a position are one)."""
    text = F.sha2(F.to_json(F.struct("original_topic", "original_key", "original_value")), 256)
    at = F.concat_ws("/", F.coalesce("original_topic", F.lit("")), "original_partition", "original_offset")
    return F.when(F.col("original_partition").isNotNull() & F.col("original_offset").isNotNull(), at).otherwise(text)


def latest_letters(letters: DataFrame) -> DataFrame:
    """One row per message: its letter of the most attempts.  A message that was
    dead-lettered many times over is combined before the shuffle."""
    cols = [c for c in letters.columns if c not in ("job", "batch_id")]
    tries = F.coalesce("retry_count", F.lit(0))
    rows = letters.select(letter_id().alias("letter_id"), F.struct(*cols).alias("letter"),
                          F.struct(tries, "failed_at", "error_reasons").alias("order"))
    last = rows.groupBy("letter_id").agg(F.max_by("letter", "order").alias("letter"))
    return last.select("letter_id", "letter.*").withColumn("retry_count", tries)


def recovered_ids(spark: SparkSession, main_path: str) -> DataFrame:
    """Ids of the messages that re-drives have moved to the main path."""
    path, schema = f"{main_path.rstrip('/')}/job={JOB}", "letter_id STRING"
    p, fs = _fs(spark, path)
    found = spark.read.schema(schema).parquet(path) if fs.exists(p) else spark.createDataFrame([], schema)
    return found.select("letter_id").distinct()


def letter_places(spark: SparkSession, main_path: str, dlq_path: str, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Every dead-lettered message once, with its last letter and its ``place``:
    ``recovered`` (moved to the main path), ``parked`` (failed ``max_retries``
    re-drives) or ``waiting``."""
    done = recovered_ids(spark, main_path).withColumn("_done", F.lit(True))
    place = (F.when(F.col("_done"), F.lit("recovered"))
             .when(F.col("retry_count") >= max_retries, F.lit("parked")).otherwise(F.lit("waiting")))
    last = latest_letters(spark.read.parquet(dlq_path))
    return last.join(done, "letter_id", "left").withColumn("place", place).drop("_done")


def redrive(spark: SparkSession, main_path: str, dlq_path: str, as_of=None, mode: str = "lenient",
            max_retries: int = MAX_RETRIES, repair: Callable[[Column], Column] | None = None,
            run: int | None = None, failed_at: Column | None = None) -> dict:
    """Judge every waiting message again; returns how many were recovered and how many failed.

    Accepted messages are appended to the main path, with their ``letter_id``;
    the others get a letter with one attempt more, which keeps the message as it
    was first received.  ``repair`` mends the text that is judged.  ``run``
    names the folders of the run (default: the time in ms).

    The main path is written first.  After a crash between the writes the
    accepted messages count as recovered, since their rows are there, and the
    others wait with the attempts they had: call it again, with any ``run``.
    Only one re-drive may run at a time.  Both joins are on the message's id,
    of which there is one row on either side."""
    run = time.time_ns() // 1_000_000 if run is None else run
    to = f"job={JOB}/batch_id={run}"
    value = F.col("original_value")
    due = letter_places(spark, main_path, dlq_path, max_retries).filter(F.col("place") == "waiting")
    rows = due.select("letter_id", F.col("original_topic").alias("topic"), F.col("original_partition").alias("partition"),
                      F.col("original_offset").alias("offset"), F.col("original_key").alias("key"),
                      value.alias("received"), F.col("retry_count").alias("tries"), F.col("source_topic").alias("sent_from"),
                      (repair(value) if repair else value).alias("value"))
    judged = validate(rows, as_of=as_of, mode=mode).persist(StorageLevel.MEMORY_AND_DISK)
    one = F.count(F.lit(1)).alias("n")
    try:
        ok, bad = Observation(), Observation()
        (valid_trades(judged, carry=["letter_id"]).observe(ok, one)
         .write.mode("append").parquet(f"{main_path.rstrip('/')}/{to}"))
        again = dlq_records(invalid_rows(judged), failed_at=failed_at, carry=["received", "tries", "sent_from"])
        again = again.withColumns({"original": F.col("received"), "original_value": F.col("received"),
                                   "source_topic": F.col("sent_from"), "retry_count": F.col("tries") + 1})
        (again.drop("received", "tries", "sent_from").observe(bad, one)
         .write.mode("append").parquet(f"{dlq_path.rstrip('/')}/{to}"))
        return {"recovered": ok.get["n"], "failed": bad.get["n"]}
    finally:
        judged.unpersist()
