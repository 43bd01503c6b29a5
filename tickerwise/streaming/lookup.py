"""J1 / ST2 online: a stream of requests meets a stream of feature rows.

Both streams carry a watermark; a request waits until no feature row of its time can come any more, then it is answered with the latest
one within its TTL, or as a miss.  The interval join is an equality on (ticker, TTL bucket) plus the time bound, as in
the batch operator, so a hot ticker's state is spread over its buckets and goes as the watermark passes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerwise.schema import FEATURE_VIEW_TTL_DAYS, KEY
from tickerwise.streaming.jobs import _sink_append, dir_stream, run_dir, stage_in_order


def lookup_stream(requests: DataFrame, view: DataFrame, ttl_days: float = FEATURE_VIEW_TTL_DAYS, delay: str = "1 day", key: str = KEY,
                  ts: str = "event_timestamp", request_id: str = "request_id", fields=None) -> DataFrame:
    """Requests (request_id, ticker, event_timestamp) joined as they arrive: feature_timestamp, fields and found.

    Same answers as ``serving.asof_features`` for rows that come at most ``delay`` out of order within their own stream, whatever the
    order between the streams (the slower one holds the watermark back); later rows are dropped.  A request needs a time; of
    requests equal in id, ticker and time one is answered.
    """
    fields = fields or [c for c in view.columns if c not in (key, ts)]
    ttl = max(1, round(ttl_days * 86_400_000_000))
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(ttl))
    r = (requests.where(F.col(ts).isNotNull()).select(request_id, key, F.col(ts).cast("timestamp").alias("_rts")).withWatermark("_rts", delay)
         .withColumn("_bucket", F.explode(F.array(bucket(F.col("_rts")), bucket(F.col("_rts")) - 1))))
    v = (view.where(F.col(ts).isNotNull()).select(F.col(key).alias("_vkey"), F.col(ts).cast("timestamp").alias("_vts"), *[F.col(c).alias(f"_v_{c}") for c in fields])
         .withWatermark("_vts", delay).withColumn("_vbucket", bucket(F.col("_vts"))))
    span = F.expr(f"INTERVAL '{ttl // 1_000_000}.{ttl % 1_000_000:06d}' SECOND")
    hit = (F.col(key) == F.col("_vkey")) & (F.col("_bucket") == F.col("_vbucket")) & (F.col("_vts") <= F.col("_rts")) & (F.col("_vts") > F.col("_rts") - span)
    row = F.struct("_vts", *[f"_v_{c}" for c in fields])
    best = r.join(v, hit, "leftOuter").groupBy(request_id, key, "_rts").agg(F.max_by(row, F.col("_vts")).alias("_b"))
    return best.select(request_id, key, F.col("_rts").cast("timestamp_ntz").alias(ts), F.col("_b._vts").cast("timestamp_ntz").alias("feature_timestamp"),
                      *[F.col(f"_b._v_{c}").alias(c) for c in fields], F.col("_b._vts").isNotNull().alias("found"))


def close_stream(path: str, sample: DataFrame, ts: str, end, key: str = KEY) -> None:
    """Append a last file of one row with the time ``end`` and an empty key: it moves the watermark past all rows before it.

    The key is not NULL, as a row that can join nothing is filtered out before the watermark sees it.  The row itself is never answered:
    the watermark stays behind its time.
    """
    value = lambda f: F.lit(end) if f.name == ts else F.lit("") if f.name == key else F.lit(None)
    cols = [value(f).cast(f.dataType).alias(f.name) for f in sample.schema.fields]
    sample.sparkSession.range(1).select(*cols).coalesce(1).write.mode("append").parquet(path)


def run_stream_lookup(spark: SparkSession, requests: DataFrame, view: DataFrame, ttl_days: float = FEATURE_VIEW_TTL_DAYS, chunks: int = 4,
                      files: int | None = None, max_files: tuple[int | None, int | None] = (None, None), ts: str = "event_timestamp") -> DataFrame:
    """Replay both tables as streams, each in chunks of time, and return all answers.

    A chunk goes through whole (``max_files`` files a micro-batch of each stream, the files of one chunk by default), and the
    watermark waits for the slower stream, so nothing is late.  A closing row in each stream moves it past the last rows.
    """
    path = run_dir(spark, "lookup")
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = requests.agg(F.max(ts).cast("timestamp").alias("t")).union(view.agg(F.max(ts).cast("timestamp"))).agg(
        F.max("t") + F.expr(f"INTERVAL '{int(ttl_days * 3) + 5}' DAY")).first()[0]
    tables = [("requests", requests, max_files[0]), ("view", view, max_files[1])]
    for name, table, _ in tables:
        stage_in_order(table.where(F.col(ts).isNotNull()), f"{path}/{name}", order=ts, chunks=chunks, files=n)
        if end is not None:
            close_stream(f"{path}/{name}", table, ts, end)
    streams = [dir_stream(spark, f"{path}/{name}", most or n) for name, _, most in tables]
    return _sink_append(lookup_stream(*streams, ttl_days=ttl_days), path)
