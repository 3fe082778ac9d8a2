"""Counters of running jobs (W6, M1): received, sent, rejected and late messages per batch.

The counts ride on the job's own batches as a named observation, so no message is
read twice for them; a listener writes one small row per batch.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COUNTS = "message_counts"     # the observation's name
METRICS_SCHEMA = ("job STRING, name STRING, batch_id BIGINT, n_received BIGINT, n_sent BIGINT, "
                  "n_rejected BIGINT, n_late BIGINT, stamped_at STRING")


def counted(checked: DataFrame) -> DataFrame:
    """A validated stream (``jobs.checked_stream``) whose batches count their messages."""
    return checked.observe(COUNTS, F.count(F.lit(1)).alias("n_received"), F.count_if("is_valid").alias("n_sent"),
                           F.count_if(~F.col("is_valid")).alias("n_rejected"))


def progress_row(progress: dict) -> tuple:
    """One metrics row of a query's progress report; a batch without input counts nothing."""
    seen = (progress.get("observedMetrics") or {}).get(COUNTS) or {}
    late = sum(op.get("numRowsDroppedByWatermark", 0) for op in progress.get("stateOperators") or [])
    return (progress["id"], progress.get("name"), progress["batchId"], seen.get("n_received", 0),
            seen.get("n_sent", 0), seen.get("n_rejected", 0), late, progress["timestamp"])


class JobMetrics(StreamingQueryListener):
    """Writes a row per batch of the watched queries to ``path``.

    Each batch has a folder named by the query's id and the batch, which a retry of
    the batch overwrites, so the table's sums count every batch once.  Late rows are
    those that the stateful operators dropped behind the watermark.  Idle triggers make no
    report.  A driver that dies between a batch's commit and its report leaves that batch
    without a row.  Add it with ``spark.streams.addListener`` before the queries start."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.failure: Exception | None = None
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self.record(json.loads(event.progress.json))
        except Exception as e:  # noqa: BLE001 - kept for ``wait``; the listener bus would only log it
            self.failure = e

    def record(self, progress: dict) -> None:
        row = progress_row(progress)
        (self.spark.createDataFrame([row], METRICS_SCHEMA).drop("job", "batch_id").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/job={row[0]}/batch_id={row[2]}"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Block until the reports of an ended query are written; raise what stopped one."""
        if not self._end(query.runId).wait(timeout):
            raise TimeoutError(f"no end of query {query.id} was reported")
        if self.failure is not None:
            raise RuntimeError(f"job metrics could not be written: {self.failure}") from self.failure


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all jobs and batches."""
    return spark.read.schema(METRICS_SCHEMA).parquet(path)
