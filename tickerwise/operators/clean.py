"""Cleaning (P2-P6): keep-last dedup, forward/backward fill, zero-volume drop.

Dedup is an aggregate by (ticker, Date); the fill is one running window per
ticker plus one small per-ticker aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.schema import KEY, OHLCV, ORDER


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """NaN cells as NULL: the contract treats both as missing, while Spark takes NaN for a value larger than all others.

    Every operator that takes a table of bars or features calls it first; without DOUBLE or FLOAT columns it changes nothing.
    """
    cols = [c for c, t in df.dtypes if t in ("double", "float") and (cols is None or c in cols)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols}) if cols else df


def dedup_keep_last(df: DataFrame, seq: str = "seq", key: str = KEY, order: str = ORDER) -> DataFrame:
    """One row per (ticker, Date), the one that arrived last (highest ``seq``).

    An aggregate by (ticker, Date) with map-side combine: raw arrivals of a hot
    ticker collapse before they move.  Rows without a ``seq`` count as the
    earliest; of equal ``seq`` the larger row wins.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    row = F.struct(seq, *[c for c in rest if c != seq])
    return df.groupBy(key, order).agg(F.max(row).alias("_r")).select(*[F.col(c) if c in (key, order) else F.col(f"_r.{c}") for c in df.columns])


def fill_ffill_bfill(df: DataFrame, cols=OHLCV, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Forward fill, then backward fill, per ticker in Date order.

    After the forward fill only leading NULLs remain; their value is the
    ticker's first non-null one, a per-ticker aggregate joined back (no frame
    spans the whole ticker).
    """
    cols, df = [c for c in cols if c in df.columns], nan_to_null(df)
    run = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    first = df.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_first_{c}") for c in cols])
    first = first.withColumnRenamed(key, "_key")
    filled = df.join(first, df[key].eqNullSafe(first["_key"]), "left").withColumns(
        {c: F.coalesce(F.col(c), F.last(c, ignorenulls=True).over(run), F.col(f"_first_{c}")) for c in cols})
    return filled.select(df.columns)


def drop_zero_volume(df: DataFrame) -> DataFrame:
    """Keep Volume > 0 (NULL volume is dropped too)."""
    return df.filter(F.col("Volume") > 0)


def clean_bars(df: DataFrame, seq: str | None = "seq", fill: str = "ffill_bfill",
               key: str = KEY, order: str = ORDER) -> DataFrame:
    """P5: dedup (keep last) -> order -> fill -> drop Volume <= 0.

    ``fill='none'`` skips the fill (the written contract says no forward
    fill; the reference code fills).  Without a ``seq`` column the input is
    taken to be unique per (ticker, Date).
    """
    df = nan_to_null(df)
    if seq and seq in df.columns:
        df = dedup_keep_last(df, seq, key, order)
    if fill == "ffill_bfill":
        df = fill_ffill_bfill(df, key=key, order=order)
    elif fill != "none":
        raise ValueError(f"unknown fill {fill!r}")
    return drop_zero_volume(df)
