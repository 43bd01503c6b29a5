"""Streaming jobs.  Each ``run_*`` starts a query with ``trigger(availableNow=True)``
over a file source, waits for it and returns the sink read back as a batch
DataFrame, so the same result can be checked against the batch twin.

Sources and sinks live under the session's ``spark.checkpoint.dir`` (a
shared folder on a cluster); every run takes a fresh sub-folder, and the
query checkpoint makes a restarted run resume where the lost one stopped.
"""

from __future__ import annotations

import contextlib
import math
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tickerwise.operators.models import score_linear
from tickerwise.schema import KEY, LATENCY_BUCKETS, ORDER, ROLLING_WINDOWS
from tickerwise.session import checkpoint_dir, remove_at_exit
from tickerwise.streaming.table import EpochTable

LATE_POLICY = {
    "stream_bars": "every hour is in the result, updated until the watermark (max(ts) - 1 hour) closes it; events later than that are dropped",
    "stream_request_counts": "same watermark; one row per (hour, endpoint, status)",
    "stream_latency_histogram": "same watermark; one row per (hour, endpoint, le)",
    "stream_online_snapshot": "no drop: the latest row per ticker by event time wins, whatever the arrival order",
    "stream_dedup": "no row is too late: the lowest seq per (ticker, Date) wins, whatever the arrival order; state goes 7 days after a key's last arrival",
    "stream_dedup_last": "the same with the highest seq",
    "stream_features": "a bar not newer than the ticker's last processed bar is dropped (counted in state)",
}


# How a staged table is replayed: the number of micro-batches is fixed, and files and state partitions follow the rows, so a run
# costs what its rows cost, whatever ``spark.sql.shuffle.partitions`` says (each micro-batch has a task and a state store per partition).
REPLAY_BATCHES = 8
FILE_ROWS = 100_000
STATE_ROWS = 20_000


def run_dir(spark: SparkSession, name: str) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/tickerwise-stream/{name}-{uuid.uuid4().hex[:12]}"
    remove_at_exit(spark, path)
    return path


def stage(df: DataFrame, path: str, files: int | None = None) -> str:
    """Write a batch DataFrame as the file source of a stream."""
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)
    return path


def stage_files(df: DataFrame, path: str, files: int | None = None, max_files: int | None = None) -> tuple[int, int]:
    """Write ``df`` as the file source of a stream that is replayed in :data:`REPLAY_BATCHES` micro-batches.

    Without ``files`` there are as many as the rows need, at least one per micro-batch; without ``max_files`` a micro-batch
    takes an equal share of them.  Returns the rows and the files per micro-batch.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}-raw")
    raw = spark.read.schema(df.schema).parquet(f"{path}-raw")
    rows = raw.count()
    files = files or max(REPLAY_BATCHES, math.ceil(rows / FILE_ROWS))
    stage(raw, path, files)
    return rows, max_files or math.ceil(files / REPLAY_BATCHES)


def stage_in_order(df: DataFrame, path: str, order: str = ORDER, chunks: int = REPLAY_BATCHES, files: int | None = None,
                   key: str = KEY) -> tuple[int, int]:
    """Write ``df`` as ``chunks`` consecutive appends covering equal spans of ``order``.

    The file source replays files oldest first, so a stream reading ``path``
    sees the data in time order chunk by chunk.  Inside a chunk the rows are
    hash-partitioned by ``key`` over ``files`` files (unless given, as many as the rows of a chunk need):
    all rows of one ticker in one chunk sit in one file, hence in one
    micro-batch, and never arrive after a later chunk.  The input is computed once, into a
    table partitioned by chunk that the appends read a partition of each.
    Only the two span bounds and the count reach the driver.  Returns the rows and the files per chunk.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}-raw")
    raw = spark.read.schema(df.schema).parquet(f"{path}-raw")
    lo, hi, rows = raw.agg(F.min(order).cast("date"), F.max(order).cast("date"), F.count(F.lit(1))).first()
    files = files or max(1, math.ceil(rows / chunks / FILE_ROWS))
    span = max((hi - lo).days + 1, 1) if lo is not None else 1
    bucket = F.floor(F.datediff(F.col(order).cast("date"), F.lit(lo)) * F.lit(chunks) / F.lit(span))
    raw.withColumn("_chunk", F.coalesce(bucket, F.lit(0)).cast("int")).write.mode("overwrite").partitionBy("_chunk").parquet(f"{path}-chunks")
    parts = spark.read.parquet(f"{path}-chunks")
    for k in range(chunks):
        parts.filter(F.col("_chunk") == k).select(df.columns).repartition(files, key).write.mode("append").parquet(path)
    return rows, files


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """Stream one input table file of ``sf_dir`` (the folder is the source, filtered by file name)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(sf_dir)


def dir_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


@contextlib.contextmanager
def state_in_rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which ``transformWithState`` needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def state_partitions(spark: SparkSession, rows: int):
    """Queries started inside spread their state over partitions of about :data:`STATE_ROWS` rows: one per core at least, the session's at most."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), max(spark.sparkContext.defaultParallelism, math.ceil(rows / STATE_ROWS)))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _sink_append(df: DataFrame, path: str) -> DataFrame:
    q = (df.writeStream.outputMode("append").format("parquet").option("path", f"{path}/out")
         .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.parquet(f"{path}/out")


def _sink_upsert(df: DataFrame, path: str, keys: list[str], fanout: int = 8) -> DataFrame:
    """Run a stream whose rows replace earlier rows of the same ``keys``; returns the table as it is at the end.

    Update mode: a micro-batch holds the changed keys only and goes to an :class:`EpochTable`, so a reader always finds a
    whole table in few folders, and a retry of an epoch is idempotent.
    """
    spark = df.sparkSession
    table = EpochTable(spark, f"{path}/out", df.schema, keys, fanout=fanout)
    q = (df.writeStream.outputMode("update").foreachBatch(table.publish)
         .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return table.read()


# ------------------------------------------------------------------ ST1
def hourly_bars_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """ST1: tumbling 1-hour OHLCV bars per event type with a watermark."""
    ev = events.withColumn("_ts", F.col("ts").cast("timestamp")).withWatermark("_ts", delay)
    order = F.struct("_ts", "event_id")
    return (ev.groupBy(F.window("_ts", "1 hour"), F.col("event_type").alias(KEY))
            .agg(F.min_by("value", order).alias("Open"), F.max("value").alias("High"),
                 F.min("value").alias("Low"), F.max_by("value", order).alias("Close"),
                 F.count(F.lit(1)).alias("Volume"))
            .select(KEY, F.col("window.start").cast("timestamp_ntz").alias(ORDER), "Open", "High", "Low", "Close",
                    "Volume"))


def run_stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sink_upsert(hourly_bars_stream(table_stream(spark, sf_dir, "events")), run_dir(spark, "bars"), [KEY, ORDER])


# ------------------------------------------------------------------ ST3
def request_counts_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """ST3: requests per (hour, endpoint, status) with latency sum."""
    ev = (events.withColumn("_ts", F.col("ts").cast("timestamp")).withWatermark("_ts", delay)
          .withColumn("status", F.when(F.coalesce(F.col("value") > 0, F.lit(False)), F.lit("success"))
                      .otherwise(F.lit("error"))))
    return (ev.groupBy(F.window("_ts", "1 hour"), F.col("event_type").alias("endpoint"), "status")
            .agg(F.count(F.lit(1)).alias("requests"), F.sum(F.col("value") / 100.0).alias("latency_sum"))
            .select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "endpoint", "status", "requests",
                    "latency_sum"))


def run_stream_request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sink_upsert(request_counts_stream(table_stream(spark, sf_dir, "events")), run_dir(spark, "requests"),
                        ["hour", "endpoint", "status"])


def latency_histogram_stream(events: DataFrame, buckets=LATENCY_BUCKETS, delay: str = "1 hour") -> DataFrame:
    """ST3: cumulative latency buckets per (hour, endpoint), as N5 over time."""
    ev = events.withColumn("_ts", F.col("ts").cast("timestamp")).withWatermark("_ts", delay)
    latency = F.col("value") / 100.0
    counts = [F.count_if(latency <= b).alias(f"b{i}") for i, b in enumerate(buckets)]
    wide = (ev.groupBy(F.window("_ts", "1 hour"), F.col("event_type").alias("endpoint"))
            .agg(*counts, F.count(F.lit(1)).alias("latency_count"), F.sum(latency).alias("latency_sum")))
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(buckets)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("latency_count").alias("count")))
    return wide.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "endpoint", "latency_sum", "latency_count",
                       F.inline(F.array(*rows)))


def run_stream_latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sink_upsert(latency_histogram_stream(table_stream(spark, sf_dir, "events")), run_dir(spark, "latency"),
                        ["hour", "endpoint", "le"])


# ------------------------------------------------------------------ ST2
def run_stream_scores(spark: SparkSession, scaled: DataFrame, features: list[str]) -> DataFrame:
    """ST2: stateless scoring of prepared (standardized) feature rows arriving as files."""
    path = run_dir(spark, "scores")
    stage(scaled, f"{path}/in")
    scored = score_linear(dir_stream(spark, f"{path}/in"), features)
    return _sink_append(scored.select(KEY, ORDER, "probability", "prediction", "confidence"), path)


# ------------------------------------------------------------------ ST4
def run_stream_online_snapshot(spark: SparkSession, view: DataFrame, ts: str = "event_timestamp",
                               max_files: int | None = None) -> DataFrame:
    """ST4: continuously materialized latest row per ticker.

    A streaming ``max_by`` aggregation keeps one state row per ticker; each micro-batch publishes the
    tickers it changed (see :func:`_sink_upsert`).
    """
    path = run_dir(spark, "snapshot")
    rows, max_files = stage_files(view, f"{path}/in", max_files=max_files)
    fields = [c for c in view.columns if c not in (KEY, ts)]
    latest = (dir_stream(spark, f"{path}/in", max_files)
              .groupBy(KEY).agg(F.max_by(F.struct(ts, *fields), F.col(ts)).alias("_r"))
              .select(KEY, "_r.*"))
    with state_partitions(spark, rows):
        return _sink_upsert(latest, path, [KEY])


# ------------------------------------------------------------------ ST5 with a watermark on the bar's date
# (the registered queries use streaming/dedup.py, which drops no late row)
def dedup_stream(rows: DataFrame, delay: str = "7 days") -> DataFrame:
    """Drop repeated (ticker, Date) rows within the watermark, the first arrival is kept; state ends with the watermark, later rows are dropped."""
    return (rows.withColumn("_ets", F.col(ORDER).cast("timestamp")).withWatermark("_ets", delay)
            .dropDuplicatesWithinWatermark([KEY, ORDER]).drop("_ets"))


def dedup_last_stream(rows: DataFrame, seq: str = "seq", delay: str = "7 days") -> DataFrame:
    """ST5 keep-last: one row per (ticker, Date), the one with the highest ``seq`` among its arrivals.

    A streaming aggregate keyed by (ticker, event time) keeps the best row
    seen so far in state; ``max_by`` makes the arrival order inside the
    watermark irrelevant.  A correction may arrive up to ``delay`` late and still win.
    """
    fields = [c for c in rows.columns if c not in (KEY,)]
    return (rows.withColumn("_ets", F.col(ORDER).cast("timestamp")).withWatermark("_ets", delay)
            .groupBy(KEY, "_ets").agg(F.max_by(F.struct(*fields), F.col(seq)).alias("_r"))
            .select(KEY, "_r.*"))


# ------------------------------------------------------------------ ST6
FEATURE_OUT = T.StructType([
    T.StructField(KEY, T.StringType()), T.StructField(ORDER, T.DateType()), T.StructField("Close", T.DoubleType()),
    T.StructField("returns", T.DoubleType()),
    *[T.StructField(f"ma_{n}", T.DoubleType()) for n in ROLLING_WINDOWS],
    *[T.StructField(f"volatility_{n}", T.DoubleType()) for n in ROLLING_WINDOWS],
])
FEATURE_STATE = T.StructType([T.StructField("last_date", T.DateType()),
                              T.StructField("closes", T.ArrayType(T.DoubleType())),
                              T.StructField("padded", T.ArrayType(T.DoubleType())),
                              T.StructField("dropped_late", T.LongType())])


def _rolling_update(key, pdfs, state):
    """Per ticker: append this micro-batch's bars to the buffered last closes, emit new rows' features.

    State keeps the last 21 raw closes (rolling means need the raw values,
    NULLs included) and the last 21 forward-filled closes (returns pad a
    missing close with the last known one, however far back it was).
    """
    windows = ROLLING_WINDOWS
    keep = max(windows) + 1
    if state.exists:
        last_date, closes, padded_hist, dropped = state.get
        closes, padded_hist = list(closes), list(padded_hist)
    else:
        last_date, closes, padded_hist, dropped = None, [], [], 0
    parts = [p for p in pdfs if len(p)]
    if not parts:
        return
    new = pd.concat(parts, ignore_index=True).sort_values(ORDER)
    if last_date is not None:
        late = new[ORDER] <= last_date
        dropped += int(late.sum())
        new = new[~late]
    new = new.drop_duplicates(ORDER, keep="last")
    if len(new):
        fresh = new["Close"].astype(float).tolist()
        series = pd.Series(closes + fresh, dtype="float64")
        padded = pd.Series(padded_hist + fresh, dtype="float64").ffill()   # as the batch operator: pad, then divide
        prev = padded.shift(1)
        ret = (padded / prev.where(prev != 0)) - 1.0  # zero or missing base -> NaN (NULL), not inf
        out = pd.DataFrame({KEY: key[0], ORDER: new[ORDER].to_numpy(), "Close": new["Close"].to_numpy(dtype=float)})
        tail = slice(len(closes), len(series))
        out["returns"] = ret.iloc[tail].to_numpy()
        for n in windows:
            out[f"ma_{n}"] = series.rolling(n).mean().iloc[tail].to_numpy()
        for n in windows:
            out[f"volatility_{n}"] = ret.rolling(n).std(ddof=1).iloc[tail].to_numpy()
        closes, padded_hist = series.iloc[-keep:].tolist(), padded.iloc[-keep:].tolist()
        last_date = new[ORDER].iloc[-1]
        state.update((last_date, closes, padded_hist, dropped))
        yield out
    else:
        state.update((last_date, closes, padded_hist, dropped))


def run_stream_features(spark: SparkSession, bars: DataFrame, max_files: int | None = None) -> DataFrame:
    """ST6: incremental returns / rolling means / rolling volatility per ticker.

    Row frames are not allowed on streams, so each ticker keeps its last 21
    closes in state (``applyInPandasWithState``); a micro-batch only carries
    its own new bars (``maxFilesPerTrigger``: the files of a chunk of time, unless ``max_files`` says otherwise).
    """
    path = run_dir(spark, "features")
    rows, files = stage_in_order(bars.select(KEY, ORDER, "Close"), f"{path}/in")
    s = dir_stream(spark, f"{path}/in", max_files or files)
    out = s.groupBy(KEY).applyInPandasWithState(_rolling_update, FEATURE_OUT, FEATURE_STATE, "append",
                                                GroupStateTimeout.NoTimeout)
    with state_partitions(spark, rows):
        return _sink_append(out, path)
