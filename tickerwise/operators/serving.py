"""Point-in-time feature serving and source resolution.

* The offline feature view is a table of (ticker, event_timestamp, fields).
* The online snapshot is the latest row per ticker inside a window.
* As-of lookup (J1): each request gets the latest feature row of its own ticker
  whose timestamp lies in (ts - ttl, ts].  The distinct times asked and the
  feature rows are sorted together inside (ticker, bucket of one TTL) and the
  latest row is carried along — no request meets more than one row, and a hot
  ticker spreads over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.operators.clean import nan_to_null
from tickerwise.schema import FEATURE_VIEW_FIELDS, FEATURE_VIEW_TTL_DAYS, KEY, OHLCV, ORDER, REQUIRED_COLUMNS


class SourceError(LookupError):
    """Raised when a requested ticker is in no acceptable source."""


# ------------------------------------------------------------------ sources
def lookback_scan(df: DataFrame, start, end, order: str = ORDER) -> DataFrame:
    """Rows with start <= Date < end (the upper bound is exclusive).

    Applied to a scan, the bounds reach the Parquet reader as pushed filters.
    """
    return df.filter((F.col(order) >= start) & (F.col(order) < end))


def source_acceptance(df: DataFrame, source: str, key: str = KEY) -> DataFrame:
    """Per ticker: non-empty, required columns present, not every OHLCV cell missing (NULL or NaN)."""
    df = nan_to_null(df)
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        return (df.select(key).distinct()
                .withColumns({"source": F.lit(source), "n_rows": F.lit(0).cast("bigint"),
                              "n_null_rows": F.lit(0).cast("bigint"), "accepted": F.lit(False)}))
    all_null = F.greatest(*[F.col(c).isNull() for c in OHLCV]) & ~F.greatest(*[F.col(c).isNotNull() for c in OHLCV])
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(all_null).alias("n_null_rows"))
            .withColumn("source", F.lit(source))
            .withColumn("accepted", (F.col("n_rows") > 0) & (F.col("n_null_rows") < F.col("n_rows")))
            .select(key, "source", "n_rows", "n_null_rows", "accepted"))


def source_fallback(primary: DataFrame, snapshot: DataFrame, key: str = KEY,
                    names=("primary", "snapshot")) -> DataFrame:
    """S3: all rows of tickers the primary source serves acceptably, snapshot rows for the rest.

    Adds ``data_source``.  Per-ticker decision by semi / anti joins against
    the acceptance table — both sides stay distributed.
    """
    ok = source_acceptance(primary, names[0], key).filter("accepted").select(key)
    snap_ok = source_acceptance(snapshot, names[1], key).filter("accepted").select(key)
    cols = [c for c in primary.columns if c in snapshot.columns]
    prim = primary.join(ok, key, "left_semi").select(*cols).withColumn("data_source", F.lit(names[0]))
    snap = (snapshot.join(snap_ok, key, "left_semi").join(ok, key, "left_anti")
            .select(*cols).withColumn("data_source", F.lit(names[1])))
    return prim.unionByName(snap)


def require_tickers(resolved: DataFrame, requested: DataFrame, key: str = KEY) -> DataFrame:
    """S3 strict: raise if a requested ticker is in neither source."""
    missing = requested.select(key).distinct().join(resolved.select(key).distinct(), key, "left_anti")
    row = missing.orderBy(key).limit(1).collect()
    if row:
        raise SourceError(f"no acceptable source for ticker {row[0][key]}")
    return resolved


# ------------------------------------------------------------- feature view
def feature_view_offline(features: DataFrame, fields=FEATURE_VIEW_FIELDS, key: str = KEY,
                         order: str = ORDER) -> DataFrame:
    """(ticker, event_timestamp, fields present) as DOUBLE, any-null rows dropped."""
    present = [c for c in fields if c in features.columns]
    return (features.select(key, F.col(order).cast("timestamp_ntz").alias("event_timestamp"),
                            *[F.col(c).cast("double").alias(c) for c in present])
            .dropna("any"))


def online_snapshot(view: DataFrame, start, end, key: str = KEY, ts: str = "event_timestamp") -> DataFrame:
    """Latest feature row per ticker with start <= ts <= end (max_by, map-side partial)."""
    fields = [c for c in view.columns if c not in (key, ts)]
    latest = (view.filter((F.col(ts) >= start) & (F.col(ts) <= end))
              .groupBy(key).agg(F.max_by(F.struct(ts, *fields), F.col(ts)).alias("_r")))
    return latest.select(key, "_r.*")


def online_lookup(requests: DataFrame, snapshot: DataFrame, key: str = KEY) -> DataFrame:
    """Each request gets its ticker's online row; ``found`` is false on a miss."""
    snap = snapshot.withColumn("_hit", F.lit(True))
    return requests.join(snap, key, "left").withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")


def online_misses(requests: DataFrame, snapshot: DataFrame, key: str = KEY) -> DataFrame:
    """Requests whose ticker has no online row (left anti join)."""
    return requests.join(snapshot.select(key), key, "left_anti")


def asof_features(requests: DataFrame, view: DataFrame, ttl_days: float = FEATURE_VIEW_TTL_DAYS,
                  key: str = KEY, req_ts: str = "event_timestamp", view_ts: str = "event_timestamp",
                  request_id: str = "request_id", fields=None, as_of: Column | None = None) -> DataFrame:
    """Point-in-time lookup: latest view row with ts - ttl < view_ts <= ts.

    One row out per row in: a request without a timestamp is asked ``as_of`` (default: now), a
    miss keeps the request with NULL fields and ``found`` = false, a repeated request is answered as often.  ``ttl_days``
    may be fractional.  Each distinct (ticker, time) is answered once and the requests take its answer, so a time that
    very many ask for costs no more than another.  The time axis is cut into buckets of one TTL: inside a bucket the
    latest row is carried along the time, before a bucket's first row stands the last one of the bucket before.
    Every row is sorted once, whatever the TTL, and a hot ticker spreads over its buckets.
    """
    fields = fields or [c for c in view.columns if c not in (key, view_ts)]
    ttl = max(1, round(ttl_days * 86_400_000_000))
    now = F.current_timestamp() if as_of is None else as_of
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    kind = requests.schema[req_ts].dataType
    asked = requests.select(request_id, key, F.coalesce(F.col(req_ts), now.cast(kind)).alias("_rts"))
    bucket = F.floor(F.try_divide(F.col("_us"), F.lit(ttl)))
    row = F.struct(F.col(view_ts).alias("_vts"), *[F.col(c).alias(f"_v_{c}") for c in fields])
    rows = (view.where(F.col(view_ts).isNotNull())
            .select(F.col(key).alias("_key"), micros(F.col(view_ts)).alias("_us"), row.alias("_row")).withColumn("_bucket", bucket))
    last = rows.groupBy("_key", "_bucket").agg(F.max_by(F.struct("_us", "_row"), "_us").alias("_carried"))
    carried = last.select("_key", (F.col("_bucket") + 1).alias("_bucket"), F.col("_carried._us").alias("_us"), F.col("_carried._row").alias("_row"))
    times = (asked.where(F.col(key).isNotNull() & F.col("_rts").isNotNull()).select(F.col(key).alias("_key"), "_rts").distinct()
             .withColumn("_us", micros(F.col("_rts"))).withColumn("_bucket", bucket))
    none = lambda df, name: F.lit(None).cast(df.schema[name].dataType).alias(name)
    cols = ["_key", "_bucket", "_us"]
    line = (rows.unionByName(carried).select(*cols, F.struct("_us", "_row").alias("_at"), none(times, "_rts"))
            .unionByName(times.select(*cols, F.lit(None).cast(last.schema["_carried"].dataType).alias("_at"), "_rts")))
    upto = Window.partitionBy("_key", "_bucket").orderBy("_us", F.col("_rts").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    seen = line.withColumn("_at", F.last("_at", ignorenulls=True).over(upto)).where(F.col("_rts").isNotNull())
    answers = seen.where(F.col("_at._us") > F.col("_us") - ttl).select("_key", F.col("_rts").alias("_time"), F.col("_at._row").alias("_b"))
    out = asked.join(answers, (F.col(key) == F.col("_key")) & (F.col("_rts") == F.col("_time")), "left")
    return out.select(request_id, key, F.col("_rts").alias(req_ts), F.col("_b._vts").alias("feature_timestamp"),
                      *[F.col(f"_b._v_{c}").alias(c) for c in fields], F.col("_b._vts").isNotNull().alias("found"))
