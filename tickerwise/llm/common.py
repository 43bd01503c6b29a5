"""Helpers shared by the operators of this subpackage: tables in the shared folder, row keys, counters, components."""

from __future__ import annotations

import atexit
import gc
import time
import uuid
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerwise.session import apply_safe_conf, checkpoint_dir

COUNTER_ROWS, COUNTER_BITS = 2, 17  # word-frequency sketch: 2 x 131,072 counters whatever the corpus size


def small_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by bytes: ten thousand texts at once would cost an executor's Python workers hundreds of MB."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


class Workspace:
    """One run's folder under ``spark.checkpoint.dir``; tables written there cut lineage.

    A lost executor then re-reads a table instead of recomputing the chain before it.  The folder is removed when
    the driver program ends (results are lazy, so they may still read it until then); ``drop`` removes a table early.
    """

    def __init__(self, spark: SparkSession):
        apply_safe_conf(spark)
        small_batches(spark)
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.path)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._remove(f"{self.path}/{name}")

    def release(self) -> None:
        """Let Spark's cleaner remove shuffle files that no table needs any more.

        It acts on what the driver's collector finds unreachable, asynchronously: hence the calls and pauses.
        """
        gc.collect()
        for _ in range(3):
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.7)

    def _remove(self, path: str) -> None:
        if self.spark.sparkContext._jsc is None:
            return
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sum_counters(df: DataFrame, lanes: int = 32) -> dict[int, np.ndarray]:
    """Sum rows (slice int, counts binary of int64) into one array per slice on the driver.

    The number and width of slices are fixed by the caller, so what reaches the driver never grows with the data.
    Two streaming levels (lanes, then slices) keep one counter array per slice in each task's memory.
    """
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for s, c in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(c.as_buffer(), np.int64)
                total[s] = part.copy() if s not in total else total[s] + part
        if total:
            yield pa.record_batch({"slice": pa.array(list(total), pa.int32()),
                                   "counts": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    first = (df.withColumn("lane", F.spark_partition_id() % lanes).repartition(partitions(df.sparkSession), "slice", "lane")
             .select("slice", "counts").mapInArrow(add, "slice int, counts binary"))
    last = first.repartition("slice").mapInArrow(add, "slice int, counts binary")
    out: dict[int, np.ndarray] = {}
    for r in last.collect():
        part = np.frombuffer(r["counts"], np.int64)
        out[r["slice"]] = part if r["slice"] not in out else out[r["slice"]] + part
    return out


def connected_components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Smallest reachable node of every node in ``edges`` (a long, b long) -> (node, component).

    Alternating large-star / small-star: each round is two aggregations by node with map-side combine and one joined
    pass, so neither a hub nor a long chain collects in one task; it ends when a round changes nothing.  Every round
    is written to the shared folder.  Self loops and repeated edges are ignored.
    """
    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    cur = work.table(cur, f"{name}-0")
    for k in count(1):
        # large star: every larger neighbour of a node is linked to the node's smallest neighbour (itself included)
        both = cur.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(cur.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        large = (cur.join(least, cur["lo"] == least["n"]).select("hi", F.col("low").alias("lo")))
        # small star: a node's smaller neighbours are linked to the smallest of them
        small_min = large.groupBy("hi").agg(F.min("lo").alias("low"))
        joined = large.join(small_min, "hi")
        nxt = (joined.select(F.col("lo").alias("hi"), F.col("low").alias("lo")).union(small_min.select("hi", F.col("low").alias("lo")))
               .where("hi <> lo").distinct())
        nxt = work.table(nxt, f"{name}-{k}")
        a = cur.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        b = nxt.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        work.drop(f"{name}-{k - 1}")
        cur = nxt
        if tuple(a) == tuple(b):
            break
    # a star forest now: every node but the roots has exactly one edge, to its root
    return cur.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        cur.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
