"""Replay fixture: broker rows as time-ordered message files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_message_files(rows: DataFrame, path: str, slices: int, time_col: str = "timestamp") -> int:
    """Write broker rows as ``slices`` JSON-line files in time order, in one pass:
    the rows are range-partitioned by time, so file i holds the i-th part.  The
    files' modification times are then set in that order, since it is what a file
    stream goes by; with ``max_files_per_trigger=1`` each micro-batch reads one
    part.  Returns the number of files."""
    spark = rows.sparkSession
    (rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                 F.col(time_col).alias("timestamp"))
     .repartitionByRange(slices, "timestamp").write.json(path))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((st.getPath() for st in fs.listStatus(folder) if st.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    for i, f in enumerate(files):
        fs.setTimes(f, 1_700_000_000_000 + 1000 * i, -1)
    return len(files)
