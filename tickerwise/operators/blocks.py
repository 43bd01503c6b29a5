"""Window operators for tickers of any length (P4, W1–W5, W8, W10): blocks of consecutive rows instead of whole tickers.

Rows are dealt by range of (ticker, Date), so their numbers need no window over a ticker: a row's place in its partition plus the
rows of the ticker in the partitions before.  A block is ``block`` consecutive rows of a ticker.  Rolling frames take the rows they need
from the neighbouring blocks (a halo); running values are taken inside the block and completed by a small scan over one row
per block, which carries the state (last value, running sum) from block to block.  The largest task has a block's rows, or a
ticker's number of blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.functions.exprs import safe_div
from tickerwise.operators.clean import nan_to_null
from tickerwise.operators.features import add_rolling_means, add_rolling_volatility, add_target
from tickerwise.schema import KEY, OHLCV, ORDER, ROLLING_WINDOWS
from tickerwise.sources.reuse import materialize

BLOCK = 50_000


def _matched(rows: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Left join by null-safe equality; ``other`` is written first, so that the join can split a hot ticker's rows."""
    other = materialize(other.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in other.columns if c not in on]), "blocks")
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return rows.join(other, same, "left").drop(*[f"_on_{c}" for c in on])


def numbered(df: DataFrame, key: str = KEY, order: str = ORDER, block: int = BLOCK) -> DataFrame:
    """``df`` with ``_pos`` (0, 1, ... per ticker by Date) and ``_b`` (its block)."""
    dealt = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, order).sortWithinPartitions(key, order)
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()), "numbered")
    parts = dealt.groupBy(key, "_part").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = parts.select(key, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    out = _matched(dealt, parts, [key, "_part"]).withColumn("_pos", F.col("_i") + F.col("_shift")).withColumn("_b", F.expr(f"_pos div {block}"))
    return out.select(*df.columns, "_pos", "_b")


def inside(key: str = KEY):
    return Window.partitionBy(key, "_b").orderBy("_pos")


def carried(rows: DataFrame, aggs: dict[str, Column], scans: dict[str, Column], key: str = KEY) -> DataFrame:
    """``rows`` with the state that the blocks before hand over: ``aggs`` per block, then ``scans`` over a ticker's earlier blocks."""
    blocks = rows.groupBy(key, "_b").agg(*[c.alias(n) for n, c in aggs.items()])
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return _matched(rows, blocks.select(key, "_b", *[c.over(earlier).alias(n) for n, c in scans.items()]), [key, "_b"])


def _last_known(rows: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Columns ``_pad_<c>``: the last value present up to the row, however far back."""
    rows = carried(rows, {f"_l_{c}": F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))) for c in cols},
                   {f"_c_{c}": F.last(f"_l_{c}", ignorenulls=True) for c in cols}, key)
    run = inside(key).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({f"_pad_{c}": F.coalesce(F.last(c, ignorenulls=True).over(run), F.col(f"_c_{c}")) for c in cols})


def features_blocked(df: DataFrame, windows=ROLLING_WINDOWS, price: str = "Close", key: str = KEY, order: str = ORDER, block: int = BLOCK) -> DataFrame:
    """W5 as ``features_full``: returns, rolling means and volatilities, next-bar label, warm-up dropped."""
    halo = max(windows) - 1
    if block <= halo:
        raise ValueError(f"a block has more rows than the longest frame, {halo + 1}")
    rows = _last_known(numbered(nan_to_null(df), key, order, block), [price], key)
    start = F.col("_pos") % block == 0
    previous = F.when(start, F.col(f"_c_{price}")).otherwise(F.lag(f"_pad_{price}").over(inside(key)))
    rows = materialize(rows.withColumn("returns", safe_div(F.col(f"_pad_{price}"), previous) - F.lit(1.0)).select(*df.columns, "returns", "_pos", "_b"), "returns")
    # a block's last rows open the frames of the next block, its first row is the label's next bar of the block before
    place = lambda to, own: F.struct(to.alias("b"), F.lit(own).alias("own"))
    homes = F.array_compact(F.array(place(F.col("_b"), True), F.when(F.col("_pos") % block >= block - halo, place(F.col("_b") + 1, False)),
                                    F.when(start & (F.col("_b") > 0), place(F.col("_b") - 1, False))))
    x = rows.withColumn("_home", F.explode(homes)).withColumn("_cell", F.struct(F.col(key).alias("k"), F.col("_home.b").alias("b")))
    x = add_rolling_means(x, windows, price, "_cell", "_pos")
    x = add_target(add_rolling_volatility(x, windows, "_cell", "_pos"), price, "_cell", "_pos")
    return x.where("_home.own").drop("_home", "_cell", "_pos", "_b").dropna("any")


def fill_blocked(df: DataFrame, cols=OHLCV, key: str = KEY, order: str = ORDER, block: int = BLOCK) -> DataFrame:
    """P4 as ``fill_ffill_bfill``: forward fill, then the ticker's first value for what is still missing at its start."""
    cols = [c for c in cols if c in df.columns]
    rows = _last_known(numbered(nan_to_null(df), key, order, block), cols, key)
    first = rows.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_f_{c}") for c in cols])
    out = _matched(rows, first, [key]).withColumns({c: F.coalesce(f"_pad_{c}", f"_f_{c}") for c in cols})
    return out.select(df.columns)


def cumulative_return_blocked(df: DataFrame, price: str = "Close", key: str = KEY, order: str = ORDER, block: int = BLOCK) -> DataFrame:
    """W8 as ``cumulative_return``: running sum of log returns and the compounded return since the first bar."""
    rows = numbered(nan_to_null(df), key, order, block)
    rows = carried(rows, {"_e": F.max_by(F.struct(price), "_pos")}, {"_e": F.last("_e")}, key)
    previous = F.when(F.col("_pos") % block == 0, F.col(f"_e.{price}")).otherwise(F.lag(price).over(inside(key)))
    rows = materialize(rows.withColumn("log_return", F.log(safe_div(F.col(price), previous))).drop("_e"), "log-returns")
    rows = carried(rows, {"_s": F.sum("log_return")}, {"_s": F.sum("_s")}, key)
    here = F.sum("log_return").over(inside(key).rowsBetween(Window.unboundedPreceding, 0))
    total = F.coalesce("_s", F.lit(0.0)) + F.coalesce(here, F.lit(0.0))
    return rows.withColumn("cum_log_return", total).withColumn("cum_return", F.exp("cum_log_return") - F.lit(1.0)).drop("_s", "_pos", "_b")


def split_blocked(df: DataFrame, train_ratio: float = 0.8, key: str = KEY, order: str = ORDER, names=("train", "test"), block: int = BLOCK) -> DataFrame:
    """W10 as ``temporal_split``: the first floor(n * ratio) rows of a ticker are train; the row numbers need no window."""
    rows = numbered(df, key, order, block)
    out = _matched(rows, rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), [key])
    cut = F.floor(F.col("_n").cast("double") * F.lit(float(train_ratio)))
    out = out.withColumn("split", F.when(F.col("_pos") < cut, F.lit(names[0])).otherwise(F.lit(names[1])))
    return out.select(*[c for c in df.columns if c != "split"], "split")
