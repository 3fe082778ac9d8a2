"""Keyed Parquet tables: upsert, layout, retention, backfill.

A table is plain Parquet partitioned by one date column and, if asked for, by a
hash of the other key columns.  The primary key must contain the date column
(as the wide-column keys did), so an upsert only rewrites the folders its input
touches, by Spark's own dynamic partition overwrite.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.errors import AnalysisException

from ..functions.columns import date_bucket
from ..session import fresh_dir


BUCKET = "key_bucket_"   # the number of buckets follows: the column's name says how a table is split
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _read(spark: SparkSession, paths: Sequence[str], schema: StructType | None, **options) -> DataFrame | None:
    r = spark.read.options(**options)
    try:
        return (r.schema(schema) if schema is not None else r).parquet(*paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) \
                or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """Read a table; ``None`` when it does not exist yet.  Without a schema the
    columns of all files are merged, so rows of days written before a column
    was added show it as NULL; a given schema saves reading the footers."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):  # a new table: no failed read, no error in the logs
        return None
    df = _read(spark, [path], schema, **({} if schema is not None else {"mergeSchema": "true"}))
    return df.drop(*[c for c in df.columns if c.startswith(BUCKET)]) if df is not None else None


def write_layout(df: DataFrame, partition_col: str, n: int | None = None,
                 cluster: Sequence[Column | str] = ()) -> DataFrame:
    """K4 + K5: range-partition the rows by (date, clustering columns) into
    writer tasks and sort inside each task.  Without ``n`` the task count is
    left to adaptive execution, which sizes the range partitions to its
    advisory size (files of ~64 MB by default), so small batches do not
    explode into many small files and large ones get as many as they need.

    Each task then writes one contiguous slice of one or two date partitions:
    files are sorted for row-group pruning, their count grows with ``n``
    rather than with tasks x dates, and a date (or a symbol-date) holding a
    large share of the rows is split over as many tasks as its size needs,
    since the range bounds are sampled from the data."""
    order = [F.col(partition_col)] + [F.col(c) if isinstance(c, str) else c for c in cluster]
    ranged = df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def repartition_by_symbol(df: DataFrame, n: int = 10, salt: int = 8, key: str = "symbol",
                          spread_col: str = "event_id") -> DataFrame:
    """K4: hash-partition by symbol into ``n`` partitions, salted so that one
    symbol holding a large share of the rows is split over ``salt``
    partitions instead of landing in one (``salt=1`` gives the plain form)."""
    if salt <= 1:
        return df.repartition(n, key)
    return df.repartition(n, F.col(key), F.pmod(F.xxhash64(spread_col), F.lit(salt)))


def upsert(df: DataFrame, path: str, keys: Sequence[str], version: str | Column,
           partition_col: str, cluster: Sequence[Column | str] = (),
           writers: int | None = None, max_records_per_file: int | None = None,
           buckets: int | None = None) -> dict:
    """K1 (+K2, K4, K5): replay-safe keyed upsert, last *version* wins.

    The table is split into folders by ``partition_col`` (a date, text or whole
    number) and, with ``buckets``, by a hash of the other key columns; a batch
    rewrites only the folders that its keys fall into.

    1. The input is written once below the shared work root, so a lost executor
       cannot make it come out differently while it is merged.  The touched
       folders (days x buckets: bounded by the time span, not the row count)
       are the only thing brought to the driver.
    2. Rows of those folders are read, unioned with the new rows by column
       name (a column that one side lacks is NULL there) and reduced to one
       row per key with ``max_by(row, version)``, an aggregate combined
       map-side, so a hot key never forms one big group.
    3. The result is written with dynamic partition overwrite: Spark replaces
       the touched folders when all tasks have ended; others are not opened.

    A row whose key columns are partly NULL has no identity: it is matched by
    its whole content, so it is neither merged with others nor doubled by a
    replay.  Rows without a ``partition_col`` value have a folder of their own.
    Replaying an old batch changes nothing, because a row only replaces another
    when its version is greater or equal; at equal versions the incoming row
    wins.  ``buckets`` counts for a new table; later calls use the table's own
    count.  ``max_records_per_file`` caps file size on top of the AQE-sized
    writer tasks.  Returns a small summary (touched partitions, input rows).
    """
    spark = df.sparkSession
    if partition_col not in keys:
        raise ValueError("the key must contain the partition column")
    kind = df.schema[partition_col].dataType.typeName()
    if kind not in ("date", "string", "integer", "long"):
        raise ValueError(f"a table cannot be partitioned by a {kind} column")
    bucket = _bucket_column(spark, path, partition_col, buckets)
    folder_cols = [partition_col] + ([bucket] if bucket else [])
    incoming = df
    if bucket:
        others = [F.col(k) for k in keys if k != partition_col]
        count = int(bucket[len(BUCKET):])
        incoming = df.withColumn(bucket, F.pmod(F.xxhash64(*others), F.lit(count)).cast("int"))
    obs = Observation("upsert_input")  # B5: the input row count rides on the write
    batch = fresh_dir(spark, "batches")
    try:
        incoming.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(batch)
        incoming = spark.read.schema(incoming.schema).parquet(batch)
        touched = {tuple(NULL_FOLDER if v is None else str(v) for v in r)
                   for r in incoming.select(*folder_cols).distinct().collect()}
        summary = {"partitions": len({t[0] for t in touched}), "folders": len(touched),
                   "rows": obs.get.get("rows", 0), "written": bool(touched)}
        if not touched:  # K2: nothing to write for an empty batch
            return summary
        ver = F.col(version) if isinstance(version, str) else version
        rows = incoming.withColumns({"_ver": ver, "_new": F.lit(1)})
        schema = incoming.schema
        present = [f for v, f in _folders(spark, path, folder_cols).items() if v in touched]
        if present:
            at = {"basePath": path}
            # footers of the touched folders only; the folder columns keep their declared types
            there = _read(spark, present, None, mergeSchema="true", **at)
            schema = _union_schema(there.drop(*folder_cols).schema if there is not None else None, schema)
            old = _read(spark, present, schema, **at).withColumns({"_ver": ver, "_new": F.lit(0)})
            rows = old.unionByName(rows, allowMissingColumns=True)
        order = list(cluster) or [k for k in keys if k != partition_col]
        cap = {"maxRecordsPerFile": str(max_records_per_file)} if max_records_per_file else {}
        merged = _latest_per_key(rows, schema, keys, partition_col)
        (write_layout(merged, partition_col, writers, folder_cols[1:] + order)
         .write.options(partitionOverwriteMode="dynamic", **cap).mode("overwrite")
         .partitionBy(*folder_cols).parquet(path))
        return summary
    finally:
        _delete(spark, batch)


def _bucket_column(spark: SparkSession, path: str, partition_col: str, buckets: int | None) -> str | None:
    """The bucket column that the table's folders show, else one for ``buckets``."""
    days = _folders(spark, path, [partition_col])
    if days:
        inside = _names(spark, next(iter(days.values())))
        return next((n.split("=")[0] for n in inside if n.startswith(BUCKET)), None)
    return f"{BUCKET}{buckets}" if buckets and buckets > 1 else None


def _union_schema(old: StructType | None, new: StructType) -> StructType:
    """The stored columns, then the new ones; a column keeps its stored type."""
    if old is None:
        return new
    known = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in known and known[f.name].dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()} in the table, "
                             f"{f.dataType.simpleString()} in the batch")
    return StructType([StructField(f.name, f.dataType, True) for f in old.fields]
                      + [StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known])


def _folders(spark: SparkSession, path: str, cols: Sequence[str]) -> dict[tuple[str, ...], str]:
    """Partition values -> folder, from directory listings of ``cols`` levels."""
    found = {(): path.rstrip("/")}
    for col in cols:
        found = {(*values, unquote(name[len(col) + 1:])): f"{folder}/{name}"
                 for values, folder in found.items() for name in _names(spark, folder)
                 if name.startswith(f"{col}=")}
    return found


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    """Recursive delete through the cluster file system (HDFS, object store, local)."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def backfill_from_files(spark: SparkSession, source: str, target: str, start, end,
                        keys: Sequence[str], version: str, fmt: str = "parquet",
                        schema: StructType | None = None, time_col: str = "trade_time",
                        partition_col: str = "trade_date") -> dict:
    """K8: historical files -> time filter (end day whole) -> year/month/day/
    hour bucket columns -> keyed upsert into the target table."""
    from ..functions.columns import add_partitioning_columns
    rows = load_historical(spark, source, start, end, fmt, schema, time_col)
    rows = add_partitioning_columns(rows, time_col).withColumn(partition_col, F.to_date(time_col))
    return upsert(rows, target, keys, version, partition_col)


def key_or_content(keys: Sequence[str], content: Sequence[Column | str]) -> Column:
    """NULL for a complete key; else a hash of the row's content, which as one
    more grouping column keeps rows without a full key apart."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return F.when(missing, F.xxhash64(*content))


def hashable(schema: StructType) -> list[Column]:
    """All columns in a form that can be hashed: a map by its sorted entries."""
    return [F.to_json(F.sort_array(F.map_entries(f.name))) if f.dataType.typeName() == "map" else F.col(f.name)
            for f in schema.fields]


def _latest_per_key(rows: DataFrame, schema: StructType, keys: Sequence[str], partition_col: str) -> DataFrame:
    """One row per key: the highest ``_ver``, then the newer write, then the
    row's orderable columns, so the survivor never depends on shuffle order."""
    plain = [F.col(f.name) for f in schema.fields if f.dataType.typeName() != "map"]
    identity = key_or_content([k for k in keys if k != partition_col], hashable(schema))
    return (rows.groupBy(*keys, identity.alias("_content"))
            .agg(F.max_by(F.struct(*schema.names), F.struct("_ver", "_new", *plain)).alias("_r"))
            .select("_r.*"))


def scan_range(spark: SparkSession, path: str, start, end, partition_col: str = "trade_date",
               schema: StructType | None = None) -> DataFrame:
    """Table rows whose date partition lies in [start, end] (inclusive
    days); the predicate is on the partition column, so only those folders
    are listed and read (``PartitionFilters`` in the plan)."""
    df = read_table(spark, path, schema)
    if df is None:
        raise FileNotFoundError(path)
    return df.filter(F.col(partition_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def load_historical(spark: SparkSession, path: str, start, end, fmt: str = "parquet",
                    schema: StructType | None = None, time_col: str = "trade_time") -> DataFrame:
    """S3: files (Parquet or CSV with header) filtered to a time range whose
    end day is included whole (so 'until 2024-01-09' keeps all of the 9th)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    df = r.load(path)
    lo = F.lit(str(start)).cast("timestamp")
    end_s = str(end)
    hi = (F.lit(end_s).cast("date") + F.expr("INTERVAL 1 DAY")).cast("timestamp") if len(end_s) <= 10 \
        else F.lit(end_s).cast("timestamp")
    upto = F.col(time_col) < hi if len(end_s) <= 10 else F.col(time_col) <= hi   # a time is inclusive
    return df.filter((F.col(time_col) >= lo) & upto)


def partition_values(spark: SparkSession, path: str, partition_col: str) -> list[str]:
    """The values of the top-level partition folders (``col=value``) of a
    table, from one directory listing: no file is opened, so the cost grows
    with the number of partitions (days), not with the data."""
    return sorted(v for v, in _folders(spark, path, [partition_col]))


def expired_partitions(spark: SparkSession, path: str, days: int, as_of,
                       partition_col: str = "trade_date", schema: StructType | None = None) -> list:
    """Date partition values older than ``as_of - days``, from the folder
    listing (``schema`` is accepted for symmetry with the readers)."""
    as_of_day = _dt.datetime.fromisoformat(str(as_of)).date() if not isinstance(as_of, _dt.date) \
        else (as_of.date() if isinstance(as_of, _dt.datetime) else as_of)
    cutoff = as_of_day - _dt.timedelta(days=days)
    days_there = [_dt.date.fromisoformat(v) for v in partition_values(spark, path, partition_col)
                  if v != NULL_FOLDER]     # rows without a day never expire
    return [d for d in days_there if d < cutoff]


def expire(spark: SparkSession, path: str, days: int, as_of,
           partition_col: str = "trade_date", schema: StructType | None = None) -> list:
    """K6: retention.  Whole date partitions older than ``as_of - days`` are
    deleted (a file-system delete per folder; no row is rewritten).  The
    wide-column TTL counted from write time; this counts from event time."""
    gone = expired_partitions(spark, path, days, as_of, partition_col, schema)
    for v in gone:
        _delete(spark, f"{path.rstrip('/')}/{partition_col}={v}")
    return gone


def backfill(spark: SparkSession, source: str, target: str, start, end, keys: Sequence[str],
             version: str, granularity: str = "daily", batch_days: int | None = None,
             partition_col: str = "trade_date", time_col: str = "event_time",
             schema: StructType | None = None, writers: int | None = None) -> list[dict]:
    """K7/K8: copy [start, end] (inclusive days) from a source table into the
    target with date buckets, through the keyed upsert.

    One partition-pruned job by default; ``batch_days`` splits the range into
    consecutive slices (each its own upsert) for very long ranges; ``writers``
    fixes the number of writer tasks of each.  No sleep
    between slices: back-pressure is the cluster's job.
    """
    d0 = _dt.date.fromisoformat(str(start)[:10])
    d1 = _dt.date.fromisoformat(str(end)[:10])
    step = (d1 - d0).days + 1 if not batch_days else batch_days
    out = []
    a = d0
    while a <= d1:
        b = min(d1, a + _dt.timedelta(days=step - 1))
        rows = scan_range(spark, source, a.isoformat(), b.isoformat(), partition_col, schema)
        rows = rows.withColumn("date_bucket", date_bucket(time_col, granularity))
        out.append(upsert(rows, target, keys, version, partition_col, writers=writers))
        a = b + _dt.timedelta(days=1)
    return out


MODULUS = 2_147_483_647   # of the fingerprint sums: 2**32 rows of a group still fit 64 bits


def fingerprints(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: the row count and two modular sums of 64-bit row hashes.  Sums do not
    depend on the order or the files of the rows, and combine map-side.  Every other
    column is hashed by its name's place, maps by their sorted entries."""
    content = [c for c, f in zip(hashable(rows.schema), rows.schema.fields) if f.name not in by]

    def total(seed: int) -> Column:
        # a NULL is skipped by the hash, so its places are hashed too
        nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in content])
        return F.pmod(F.sum(F.pmod(F.xxhash64(F.lit(seed), nulls, *content), F.lit(MODULUS))), F.lit(MODULUS))

    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), total(1).alias("sum_a"), total(2).alias("sum_b"))


def differing_days(source: DataFrame, target: DataFrame | None, partition_col: str = "trade_date",
                   key: str = "symbol") -> DataFrame:
    """The days of ``source`` on which some key's rows are not those of ``target``, which
    may have more columns.  One aggregate per side; what is joined is a row per day and
    key.  Days that only the target has are no difference: a backfill adds, it does not take."""
    ours = fingerprints(source, [partition_col, key])
    if target is None or not set(source.columns) <= set(target.columns):
        return ours.select(partition_col).distinct()
    same = target.select(*[F.col(f.name).cast(f.dataType) for f in source.schema.fields])
    theirs = fingerprints(same, [partition_col, key])
    a, b = ours.alias("a"), theirs.alias("b")
    met = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ours.columns]
    return a.join(b, met, "left_anti").select(partition_col).distinct()


def backfill_changed(spark: SparkSession, source: str, target: str, start, end, keys: Sequence[str],
                     version: str, granularity: str = "daily", partition_col: str = "trade_date",
                     time_col: str = "event_time", schema: StructType | None = None,
                     key: str = "symbol") -> list[str]:
    """K7 by difference: of [start, end] (inclusive days) only the days whose rows differ
    between source and target go through the keyed upsert; returns those days.

    Both sides are read once for their fingerprints; a repeated run, or one after the
    source was compacted or rewritten in another order, copies nothing.  A day on which
    the target holds rows of its own, or newer versions, stays different and is merged
    again, which changes nothing."""
    rows = scan_range(spark, source, start, end, partition_col, schema)
    there = read_table(spark, target)
    if there is not None:
        there = there.filter(F.col(partition_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    days = sorted(r[0] for r in differing_days(rows, there, partition_col, key).collect())  # bounded by the span
    if days:
        changed = rows.filter(F.col(partition_col).isin(days))
        changed = changed.withColumn("date_bucket", date_bucket(time_col, granularity))
        upsert(changed, target, keys, version, partition_col)
    return [str(d) for d in days]
