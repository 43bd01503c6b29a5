"""SparkSession construction and shared settings."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splitting protects the one sort-merge join
# on a hot part key; the broadcast threshold is the size check behind every
# broadcast (we never hint a broadcast of data that grows with the input).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # bar windows are CPU-heavy for their bytes (seven window functions per
    # row); let AQE keep small shuffles spread over the cores instead of
    # coalescing them into one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024),
}

# Correctness guards applied to every session a query runs in (also one we
# did not build).  With ``unionOutputPartitioning`` on (the 4.1 default) a
# Union whose branches read one reused shuffle reports hash partitioning it
# does not have; windows and aggregates above it then skip their exchange and
# split a ticker over two tasks (observed: duplicated per-ticker rows and
# "Can't zip RDDs with unequal numbers of partitions").
SAFE_CONF = {
    "spark.sql.unionOutputPartitioning": "false",
}


def apply_safe_conf(spark: SparkSession) -> SparkSession:
    for k, v in SAFE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickerwise", extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a local one for tests and benches."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **SAFE_CONF}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_safe_conf(spark)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Only when the session leaves it unset (local tests) do we
    pick a fresh scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            # a machine-local folder is not shared by executors on other hosts
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               f"(shared file system or object store); master is {master!r}")
        path = tempfile.mkdtemp(prefix="tickerwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table when the driver program ends (lazy results may read it until then)."""
    atexit.register(_remove, spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None:  # the session is gone, and with it the access to the file system
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
