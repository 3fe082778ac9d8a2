"""Late rows kept (W2): a micro-batch split at the event-time high-water mark.

A stateful query drops rows behind its watermark and only counts them.  This
job goes before it: rows in time go to the main sink, rows behind the mark to a
sink of their own, from where a backfill can take them up.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.tables import _delete
from .jobs import WATERMARK_DELAY, _trigger, query_id


def is_late(mark_ms: Column | int | None, delay: str = WATERMARK_DELAY, time_col: str = "event_time") -> Column:
    """Whether a row is behind the watermark that ``mark_ms``, the greatest event time
    so far, gives.  Nothing is late before there is a mark; a row without a time never is."""
    mark = F.lit(mark_ms).cast("bigint") if not isinstance(mark_ms, Column) else mark_ms
    return F.coalesce(F.col(time_col) <= F.timestamp_millis(mark) - F.expr(f"INTERVAL {delay}"), F.lit(False))


def start_split(rows: DataFrame, main_path: str, late_path: str, marks_path: str, checkpoint: str,
                delay: str = WATERMARK_DELAY, time_col: str = "event_time", trigger: str | None = None,
                available_now: bool = False) -> StreamingQuery:
    """Every row of ``rows`` ends in the main or the late sink, once.

    A row is late if its time is not after the greatest time of the batches
    before its own less ``delay``, as a watermark on the same batches has it.
    The mark of batch n is one row below ``marks_path``; batch n + 1 reads it, so
    a restart goes on with it.  The sinks have a folder per query and batch that
    a retry of the batch overwrites with the same rows, since it starts from the
    same mark.  The batch is read once; its greatest time is taken while the main
    sink is written, and late rows cannot raise it."""
    job: list[str] = []
    main_path, late_path, marks_path = (p.rstrip("/") for p in (main_path, late_path, marks_path))

    def mark_before(batch: DataFrame, n: int) -> int | None:
        if n == 0:
            return None
        old = batch.sparkSession.read.schema("mark BIGINT").parquet(f"{marks_path}/job={job[0]}/batch_id={n - 1}")
        return old.first()["mark"]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not job:
            job.append(query_id(spark, checkpoint))
        mark = mark_before(batch, batch_id)
        to = f"job={job[0]}/batch_id={batch_id}"
        late, seen = is_late(mark, delay, time_col), Observation()
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            in_time = batch.filter(~late).observe(seen, F.max(F.unix_millis(time_col)).alias("mark"))
            in_time.write.mode("overwrite").parquet(f"{main_path}/{to}")
            batch.filter(late).write.mode("overwrite").parquet(f"{late_path}/{to}")
        finally:
            batch.unpersist()
        mark = max((m for m in (mark, seen.get["mark"]) if m is not None), default=None)
        (spark.createDataFrame([(mark,)], "mark BIGINT").coalesce(1)
         .write.mode("overwrite").parquet(f"{marks_path}/{to}"))
        if batch_id >= 2:      # the batch before this one is committed; a retry of this one reads its mark only
            _delete(spark, f"{marks_path}/job={job[0]}/batch_id={batch_id - 2}")

    w = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger, available_now).start()
