"""Session helpers: UTC time, sane shuffle sizing, shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickyard", driver_memory: str | None = None,
                rocksdb_state: bool = False) -> SparkSession:
    """Build (or reuse) a session configured the way the library expects.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    settings below are all SQL confs that are safe to apply at any scale.
    ``rocksdb_state=True`` keeps streaming state (dedupe ids, open bars) in
    RocksDB with changelog checkpoints instead of executor heap - the choice
    for many symbols or long watermarks; it is fixed per query at first start.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", UTC)
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if rocksdb_state:
        b = (b.config("spark.sql.streaming.stateStore.providerClass",
                      "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
              .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"))
    if driver_memory:  # only takes effect when this call starts the JVM
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """All bucket, hour and window arithmetic in this library is UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def work_root(spark: SparkSession) -> str:
    """Shared folder for tables, staging and stream checkpoints.

    Read from ``spark.checkpoint.dir`` (the cluster's shared location).  When it
    is unset a local master gets a folder under the system temp dir, registered
    so that ``DataFrame.checkpoint()`` works too; on a cluster, where executors
    would each write to their own disk, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile
        root = os.path.join(tempfile.gettempdir(), "tickyard-checkpoints")
        if sc is not None:
            sc.setCheckpointDir(root)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) one."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no context
        return None


def parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (default parallelism); shuffle partitions remotely."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, unique path below the shared work folder."""
    return f"{work_root(spark)}/tickyard/{kind}/{uuid.uuid4().hex}"
