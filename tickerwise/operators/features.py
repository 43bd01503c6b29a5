"""Rolling features and the next-bar label.

All windows share ``partitionBy(ticker).orderBy(Date)`` so Catalyst plans a
single Exchange + Sort followed by stacked Window nodes.  Frames are ROWS
frames of at most 20 rows; a ticker's bars stream through one task in Date
order without being materialised as a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.functions.exprs import by_ticker, rolling, safe_div
from tickerwise.operators.clean import nan_to_null
from tickerwise.schema import KEY, ORDER, ROLLING_WINDOWS, TARGET


def padded(col: str, key: str = KEY, order: str = ORDER) -> Column:
    """Last non-null value up to the current row (pandas pads before pct_change)."""
    return F.last(col, ignorenulls=True).over(
        by_ticker(key, order).rowsBetween(Window.unboundedPreceding, 0))


def add_returns(df: DataFrame, price: str = "Close", key: str = KEY, order: str = ORDER,
                out: str = "returns") -> DataFrame:
    """C[t] / C[t-1] - 1 on the padded series; first row NULL, zero base NULL; a NaN price is a missing one."""
    df = nan_to_null(df, [price])
    w = by_ticker(key, order)
    p = padded(price, key, order)
    prev = F.lag(p).over(w)
    return df.withColumn(out, safe_div(p, prev) - F.lit(1.0))


def add_rolling_means(df: DataFrame, windows=ROLLING_WINDOWS, price: str = "Close",
                      key: str = KEY, order: str = ORDER) -> DataFrame:
    """Mean of the last N rows, NULL until N values (neither NULL nor NaN) are in the frame."""
    df = nan_to_null(df, [price])
    cols = {}
    for n in windows:
        w = rolling(n, key, order)
        cols[f"ma_{n}"] = F.when(F.count(price).over(w) == n, F.avg(price).over(w))
    return df.withColumns(cols)


def add_rolling_volatility(df: DataFrame, windows=ROLLING_WINDOWS, key: str = KEY,
                           order: str = ORDER, src: str = "returns") -> DataFrame:
    """Sample std (ddof=1) of returns over N rows, NULL until N non-null returns."""
    if src not in df.columns:
        df = add_returns(df, key=key, order=order, out=src)
    cols = {}
    for n in windows:
        w = rolling(n, key, order)
        cols[f"volatility_{n}"] = F.when(F.count(src).over(w) == n, F.stddev_samp(src).over(w))
    return df.withColumns(cols)


def add_target(df: DataFrame, price: str = "Close", key: str = KEY, order: str = ORDER,
               drop_unlabeled: bool = False) -> DataFrame:
    """1 if the next bar closes higher, else 0.

    As coded in the reference the last bar of a ticker gets 0 (a missing next
    close compares false); ``drop_unlabeled=True`` removes it instead.
    """
    df = nan_to_null(df, [price])
    nxt = F.lead(price).over(by_ticker(key, order))
    out = df.withColumn(TARGET, F.when(F.coalesce(nxt > F.col(price), F.lit(False)), 1)
                        .otherwise(0).cast("int"))
    if drop_unlabeled:
        out = out.withColumn("_nxt", nxt).filter(F.col("_nxt").isNotNull()).drop("_nxt")
    return out


def add_all_features(df: DataFrame, windows=ROLLING_WINDOWS, key: str = KEY,
                     order: str = ORDER) -> DataFrame:
    """returns, ma_N, volatility_N, target — without dropping the warm-up rows."""
    df = add_returns(df, key=key, order=order)
    df = add_rolling_means(df, windows, key=key, order=order)
    df = add_rolling_volatility(df, windows, key=key, order=order)
    return add_target(df, key=key, order=order)


def features_full(df: DataFrame, windows=ROLLING_WINDOWS, key: str = KEY,
                  order: str = ORDER, drop_unlabeled: bool = False) -> DataFrame:
    """All features, then drop any row with a NULL (the rolling warm-up)."""
    out = add_all_features(nan_to_null(df), windows, key, order)
    if drop_unlabeled:
        nxt = F.lead("Close").over(by_ticker(key, order))
        out = out.withColumn("_nxt", nxt).filter(F.col("_nxt").isNotNull()).drop("_nxt")
    return out.dropna("any")


def warmup_dropped(df: DataFrame, windows=ROLLING_WINDOWS, key: str = KEY,
                   order: str = ORDER) -> DataFrame:
    """P6 count: rows lost to the warm-up per ticker (rows_in, rows_out, dropped)."""
    full = add_all_features(nan_to_null(df), windows, key, order)
    complete = F.when(F.greatest(*[F.col(c).isNull() for c in full.columns]), 0).otherwise(1)
    return (full.groupBy(key)
            .agg(F.count(F.lit(1)).alias("rows_in"), F.sum(complete).cast("bigint").alias("rows_out"))
            .withColumn("dropped", F.col("rows_in") - F.col("rows_out")))


def cumulative_return(df: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Running sum of log returns and the compounded return since the first bar."""
    w = by_ticker(key, order)
    lr = F.log(safe_div(F.col("Close"), F.lag("Close").over(w)))
    run = by_ticker(key, order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("log_return", lr)
            .withColumn("cum_log_return", F.coalesce(F.sum("log_return").over(run), F.lit(0.0)))
            .withColumn("cum_return", F.exp("cum_log_return") - F.lit(1.0)))


def temporal_split(df: DataFrame, train_ratio: float = 0.8, key: str = KEY,
                   order: str = ORDER, names=("train", "test")) -> DataFrame:
    """First floor(n * r) rows of each ticker are train, the rest test.

    ``floor(double(n) * double(r))`` reproduces Python's ``int(n * r)``; n is
    a per-ticker aggregate joined back, so no frame spans a whole ticker.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed(key, "_key")
    cut = F.floor(F.col("_n").cast("double") * F.lit(float(train_ratio)))
    out = df.join(sizes, df[key].eqNullSafe(sizes["_key"]), "left").withColumn(
        "split", F.when(F.row_number().over(by_ticker(key, order)) <= cut, F.lit(names[0])).otherwise(F.lit(names[1])))
    return out.select(*[c for c in df.columns if c != "split"], "split")


def head_tail(df: DataFrame, n: int = 5, key: str = KEY, order: str = ORDER) -> DataFrame:
    """First and last n bars of each ticker, tagged 'head' / 'tail'."""
    asc = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).asc()))
    desc = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    t = df.withColumn("_a", asc).withColumn("_d", desc)
    head = t.filter(F.col("_a") <= n).withColumn("part", F.lit("head")).withColumn("pos", F.col("_a"))
    tail = t.filter(F.col("_d") <= n).withColumn("part", F.lit("tail")).withColumn("pos", F.col("_d"))
    return head.unionByName(tail).drop("_a", "_d").withColumn("pos", F.col("pos").cast("bigint"))
