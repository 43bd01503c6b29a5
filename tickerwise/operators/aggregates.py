"""Aggregations (A1-A9): describe, up/down days, class distribution, manifests, correlation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.functions.exprs import by_ticker, safe_div
from tickerwise.operators.clean import nan_to_null
from tickerwise.schema import KEY, OHLCV, ORDER, TARGET
from tickerwise.sources.reuse import materialize


def unpivot(df: DataFrame, ids: list[str], cols: list[str], name: str = "column",
            value: str = "value") -> DataFrame:
    """Wide -> long with every value cast to DOUBLE."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ids, cols, name, value)


RANGES = 256  # value ranges a group is cut into before the one that holds a rank is looked at


def order_statistics(values: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (as pandas) of groups of any size: (by..., q0, q1, ...).

    Distinct values are counted with map-side combine.  Approximate cuts deal a group's values into ranges, whose counts
    say which range holds each rank; only those ranges are sorted, each as a window of its own.  No group is ever in one buffer or
    one task.  ``values`` holds no missing value.
    """
    counts = values.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    cuts = counts.groupBy(*by).agg(F.sum("_c").alias("_n"), F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 10 * RANGES).alias("_cuts"))
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{b}{c}")) for c in by])  # noqa: E731, ARG005
    named = lambda df, to: df.select(*[F.col(c).alias(f"{to}{c}") for c in by], *[c for c in df.columns if c not in by])
    dealt = counts.join(named(cuts, "_g"), same("", "_g")).withColumn("_r", F.size(F.filter("_cuts", lambda x: x < F.col(value)))).select(*by, value, "_c", "_r")
    dealt = materialize(dealt, "order-statistics")  # read for the counts of the ranges and again for the ranges looked at
    ranges = dealt.groupBy(*by, "_r").agg(F.sum("_c").alias("_m"))
    before = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_m").over(before), F.lit(0)))
    ranks = [F.struct(F.lit(i).alias("i"), (F.col("_n") - 1).cast("double").alias("top"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares)]
    asked = named(cuts, "_g").select(*[f"_g{c}" for c in by], F.explode(F.array(*ranks)).alias("_q"))
    asked = asked.select(*[f"_g{c}" for c in by], F.col("_q.i").alias("_i"), (F.col("_q.top") * F.col("_q.share")).alias("_at"))
    asked = asked.withColumn("_w", F.explode(F.array(F.floor("_at"), F.ceil("_at"))))
    held = ranges.join(asked, same("", "_g") & (F.col("_w") >= F.col("_before")) & (F.col("_w") < F.col("_before") + F.col("_m")))
    held = held.select(*[F.col(c).alias(f"_h{c}") for c in by], F.col("_r").alias("_hr"), "_before", "_i", "_at", "_w").distinct()
    inside = held.select(*[f"_h{c}" for c in by], "_hr", "_before").distinct()
    upto = Window.partitionBy(*by, "_r").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.join(inside, same("", "_h") & (F.col("_r") == F.col("_hr"))).select(*by, value, "_r", "_c", "_before")
    placed = placed.withColumn("_end", F.col("_before") + F.sum("_c").over(upto)).withColumn("_start", F.col("_end") - F.col("_c"))
    held = held.drop("_before")
    found = placed.join(held, same("", "_h") & (F.col("_r") == F.col("_hr")) & (F.col("_w") >= F.col("_start")) & (F.col("_w") < F.col("_end")))
    pairs = found.groupBy(*by, "_i", "_at").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    linear = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))
    return pairs.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, linear)).alias(f"q{i}") for i in range(len(shares))])


def describe(df: DataFrame, cols=OHLCV, key: str = KEY) -> DataFrame:
    """A4: count, mean, std, min, quartiles (linear interpolation, as pandas), max per (ticker, column) of the cells present."""
    long = unpivot(nan_to_null(df), [key], list(cols))
    stats = long.groupBy(key, "column").agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                            F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = order_statistics(long.where("value is not null"), [key, "column"], "value", [0.25, 0.5, 0.75])
    quartiles = quartiles.select(F.col(key).alias("_k"), F.col("column").alias("_f"), F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return (stats.join(quartiles, F.col(key).eqNullSafe(F.col("_k")) & (F.col("column") == F.col("_f")), "left")
            .select(key, "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def up_down_days(df: DataFrame, price: str = "Close", key: str = KEY, order: str = ORDER) -> DataFrame:
    """Moves up / down between consecutive bars and the up share of all moves."""
    d = F.col(price) - F.lag(price).over(by_ticker(key, order))
    t = df.withColumn("_d", d)
    return (t.groupBy(key).agg(F.count_if(F.col("_d") > 0).alias("up_days"),
                               F.count_if(F.col("_d") < 0).alias("down_days"))
            .withColumn("up_share", safe_div(F.col("up_days").cast("double"),
                                             (F.col("up_days") + F.col("down_days")).cast("double"))))


def class_distribution(df: DataFrame, by=(KEY, "split"), label: str = TARGET) -> DataFrame:
    """A2: rows per label value within each group."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n_rows"))


def positive_rate(df: DataFrame, by=(KEY, "split"), label: str = TARGET) -> DataFrame:
    """A3: share of label 1 per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                               F.avg(F.col(label).cast("double")).alias("positive_rate"))


def split_manifest(df: DataFrame, n_features: int, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Rows, first and last date and feature count per (ticker, split)."""
    return (df.groupBy(key, "split").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.min(order).alias("start_date"), F.max(order).alias("end_date"))
            .withColumn("n_features", F.lit(n_features).cast("bigint")))


def pearson(x: str, y: str):
    """Pearson r on complete pairs; NULL (not an error) for zero variance.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on constant input.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xx = F.when(both, F.col(x).cast("double"))
    yy = F.when(both, F.col(y).cast("double"))
    den = F.stddev_pop(xx) * F.stddev_pop(yy)
    return F.when(den > 0, F.covar_pop(xx, yy) / den)
