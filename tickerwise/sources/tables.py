"""Scans of the input tables and the bar views derived from them.

The inputs hold no price bars, so bars are resampled from trade-like rows
(S11): lineitem lines become daily bars per part brand, events become hourly
bars per event type.  Every scan selects only the columns it needs so the
Parquet reader prunes the rest (visible as ``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerwise.schema import KEY, ORDER
from tickerwise.sources.reuse import reuse


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def resample_bars(trades: DataFrame, key: str, bucket, price: str, size, tiebreak: list[str]) -> DataFrame:
    """Ticks -> OHLCV bars.

    Open/Close are the prices of the first/last trade under a total order
    ``tiebreak``: the min / max of the struct (tiebreak..., price) carries
    the price of the first / last trade in its last field (same result as
    ``min_by``/``max_by``, one comparison buffer instead of two).  All five
    aggregates are decomposable, so the aggregate runs partial (map side)
    then final, which also absorbs hot tickers before the shuffle.
    """
    keyed = F.struct(*[F.col(c) for c in tiebreak], F.col(price).alias("_price"))
    return (trades
            .groupBy(F.col(key).alias(KEY), bucket.alias(ORDER))
            .agg(F.min(keyed)["_price"].alias("Open"),
                 F.max(price).alias("High"),
                 F.min(price).alias("Low"),
                 F.max(keyed)["_price"].alias("Close"),
                 size.alias("Volume")))


def bars_daily(spark: SparkSession, sf_dir: str, line_filter=None) -> DataFrame:
    """Daily bars (see :func:`derive_bars_daily`), built once per query inside ``shared_inputs``."""
    key = ("bars_daily", sf_dir, None if line_filter is None else str(line_filter))
    return reuse(key, lambda: derive_bars_daily(spark, sf_dir, line_filter))


def derive_bars_daily(spark: SparkSession, sf_dir: str, line_filter=None) -> DataFrame:
    """Daily bars: ticker = part brand, one bar per ship date.

    ``line_filter`` (a Column over lineitem columns) is applied to the scan so
    date bounds reach the Parquet reader as pushed filters.

    The join to ``part`` is left to the planner: the pruned (partkey, brand)
    projection is broadcast only while it is under
    ``spark.sql.autoBroadcastJoinThreshold`` (the size check), otherwise it is
    a sort-merge join that AQE splits when one part key is hot.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_shipdate", *(["l_linestatus"] if line_filter is not None else []))
    if line_filter is not None:
        li = li.filter(line_filter)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    trades = li.join(part, li.l_partkey == part.p_partkey)
    return resample_bars(
        trades, "p_brand", F.to_date("l_shipdate"), "l_extendedprice",
        F.sum("l_quantity").cast("bigint"),
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars: ticker = event type, price = value, volume = event count."""
    return reuse(("bars_hourly", sf_dir), lambda: derive_bars_hourly(spark, sf_dir))


def derive_bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return resample_bars(ev, "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz"), "value",
                         F.count(F.lit(1)), ["ts", "event_id"])


# fixed breakage pattern of dirty_bars: every k-th bar of a ticker (by date)
DIRTY_SWAP_HIGH_LOW = 97
DIRTY_NULL_CLOSE = 89
DIRTY_ZERO_VOLUME = 83
DIRTY_NEGATE_OPEN = 79
DIRTY_DUPLICATE = 73
HEAVY_NEGATE_OPEN = 5


def dirty_bars(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """``bars_daily`` with deterministic breakage and an arrival ``seq``.

    Row r (1-based per ticker by Date) arrives with seq = 2r; every
    DIRTY_DUPLICATE-th row arrives again right after with Close + 1 and
    seq = 2r + 1 (a correction that keep-last dedup must prefer).
    ``heavy`` negates Open on every 5th row so the 10 % removal gate trips.
    """
    b = bars_daily(spark, sf_dir)
    r = F.row_number().over(Window.partitionBy(KEY).orderBy(ORDER)).cast("bigint")
    b = b.withColumn("r", r)
    neg = DIRTY_NEGATE_OPEN if not heavy else HEAVY_NEGATE_OPEN
    hit = lambda k: (F.col("r") % k) == 0
    broken = b.select(
        KEY, ORDER,
        F.when(hit(neg), -F.col("Open")).otherwise(F.col("Open")).alias("Open"),
        F.when(hit(DIRTY_SWAP_HIGH_LOW), F.col("Low")).otherwise(F.col("High")).alias("High"),
        F.when(hit(DIRTY_SWAP_HIGH_LOW), F.col("High")).otherwise(F.col("Low")).alias("Low"),
        F.when(hit(DIRTY_NULL_CLOSE), F.lit(None).cast("double")).otherwise(F.col("Close")).alias("Close"),
        F.when(hit(DIRTY_ZERO_VOLUME), F.lit(0).cast("bigint")).otherwise(F.col("Volume")).alias("Volume"),
        (F.col("r") * 2).alias("seq"),
        "r",
    )
    dups = (broken.filter(hit(DIRTY_DUPLICATE))
            .withColumn("Close", F.col("Close") + 1)
            .withColumn("seq", F.col("seq") + 1))
    return broken.unionByName(dups).drop("r")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-request log: endpoint = event type, latency = value / 100 s.

    status is 'error' for a non-positive or missing latency, else 'success';
    prediction_class is the UP/DOWN class implied by the parity of the user id.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        "event_id", "ts",
        F.col("event_type").alias("endpoint"),
        (F.col("value") / F.lit(100.0)).alias("latency"),
        F.when(F.coalesce(F.col("value") > 0, F.lit(False)), F.lit("success"))
         .otherwise(F.lit("error")).alias("status"),
        F.when(F.col("user_id") % 2 == 0, F.lit("UP")).otherwise(F.lit("DOWN")).alias("prediction_class"),
    )


def entity_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-in-time lookup requests: one per order, ticker from the order key.

    The 25 brands are Brand#1 .. Brand#25; key k maps to Brand#(k mod 25 + 1).
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ticker = F.concat(F.lit("Brand#"), (F.pmod(F.col("o_orderkey"), F.lit(25)) + 1).cast("string"))
    return o.select(F.col("o_orderkey").alias("request_id"), ticker.alias(KEY),
                    F.col("o_orderdate").alias("event_timestamp"))


def label_predictions(spark: SparkSession, sf_dir: str, min_chars: int = 1000) -> DataFrame:
    """``labels.quality`` as truth and a length rule on ``documents.n_chars`` as prediction."""
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (lab.join(doc, "doc_id")
            .select("doc_id", F.col("quality").alias("y_true"),
                    F.when(F.col("n_chars") >= min_chars, 1).otherwise(0).cast("int").alias("y_pred")))
