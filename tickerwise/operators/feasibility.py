"""Dataset feasibility checks per ticker (C1-C7) and the trading calendar.

The table form evaluates every check for every ticker (the reference stops
at the first failure); ``feasibility_strict`` raises in the reference order.
Check rows share one shape: (ticker, check, value, threshold, passed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.functions.exprs import by_ticker, null_safe_bool, safe_div
from tickerwise.operators.clean import nan_to_null
from tickerwise.operators.features import add_returns
from tickerwise.schema import (
    EXAMPLES_SHOWN, KEY, LOOKAHEAD_KEYWORDS, MAX_GAP_DAYS, MAX_LABEL_BALANCE, MAX_OUTLIER_PCT,
    MIN_COMPLETENESS_PCT, MIN_LABEL_BALANCE, MIN_SAMPLES, OHLCV, ORDER, OUTLIER_Z, TARGET,
)


class DataFeasibilityError(ValueError):
    """Raised by the strict wrapper when a feasibility check fails."""


def _row(check: str, value: Column, threshold: float, passed: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), value.cast("double").alias("value"),
                    F.lit(float(threshold)).alias("threshold"), passed.alias("passed"))


def min_samples(df: DataFrame, key: str = KEY, n_min: int = MIN_SAMPLES) -> DataFrame:
    """N >= 100 rows."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("passed", F.col("n_rows") >= n_min))


def completeness(df: DataFrame, key: str = KEY, cols=OHLCV, pct_min: float = MIN_COMPLETENESS_PCT) -> DataFrame:
    """Share of OHLCV cells that are present (neither NULL nor NaN) in % (0 with no rows), passes at >= 90."""
    df = nan_to_null(df)
    nulls = sum((F.col(c).isNull().cast("bigint") for c in cols), F.lit(0).cast("bigint"))
    out = (df.groupBy(key).agg((F.count(F.lit(1)) * len(cols)).alias("total_cells"),
                               F.sum(nulls).cast("bigint").alias("missing_cells")))
    pct = F.coalesce(safe_div((F.col("total_cells") - F.col("missing_cells")).cast("double") * 100.0,
                              F.col("total_cells").cast("double")), F.lit(0.0))
    return out.withColumn("completeness_pct", pct).withColumn("passed", F.col("completeness_pct") >= pct_min)


def _gaps(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.select(key, order).withColumn(
        "gap_days", F.datediff(F.col(order), F.lag(order).over(by_ticker(key, order))))


def continuity(df: DataFrame, key: str = KEY, order: str = ORDER, max_gap: int = MAX_GAP_DAYS) -> DataFrame:
    """Largest calendar-day gap between consecutive bars, passes at <= 10."""
    g = _gaps(df, key, order)
    return (g.groupBy(key).agg(F.max("gap_days").alias("max_gap_days"),
                               F.count_if(F.col("gap_days") > max_gap).alias("n_large_gaps"))
            .withColumn("passed", F.coalesce(F.col("max_gap_days") <= max_gap, F.lit(True))))


def gap_list(df: DataFrame, key: str = KEY, order: str = ORDER, max_gap: int = MAX_GAP_DAYS,
             k: int = EXAMPLES_SHOWN) -> DataFrame:
    """C3 examples: the first k gaps over the limit per ticker (start, end, days)."""
    g = (_gaps(df, key, order).withColumn("gap_start", F.lag(order).over(by_ticker(key, order)))
         .filter(F.col("gap_days") > max_gap))
    rn = F.row_number().over(by_ticker(key, order))
    return (g.withColumn("rank", rn.cast("bigint")).filter(F.col("rank") <= k)
            .select(key, "rank", "gap_start", F.col(order).alias("gap_end"), "gap_days"))


def _with_return_stats(r: DataFrame, key: str = KEY) -> DataFrame:
    """Rows with ``returns`` and their ticker's mean, sample std and |z|: a per-ticker aggregate joined back."""
    stats = r.groupBy(key).agg(F.avg("returns").alias("_mean"), F.stddev_samp("returns").alias("_std"),
                               F.count("returns").alias("_n")).withColumnRenamed(key, "_key")
    return (r.join(stats, r[key].eqNullSafe(stats["_key"]), "left").drop("_key")
            .withColumn("z", F.abs(safe_div(F.col("returns") - F.col("_mean"), F.col("_std")))))


def return_z(df: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Daily return and its z-score against the ticker's own mean / sample std."""
    return _with_return_stats(add_returns(df.select(key, order, "Close"), key=key, order=order), key)


def outliers(df: DataFrame, key: str = KEY, order: str = ORDER, z_max: float = OUTLIER_Z,
             pct_max: float = MAX_OUTLIER_PCT) -> DataFrame:
    """C4: share of |z| > 4 among daily returns, passes at <= 1 %.

    Skipped (passed, 0 %) when a ticker has no returns or zero std.
    """
    z = return_z(df, key, order)
    out = z.groupBy(key).agg(F.count("returns").alias("n_returns"),
                             F.count_if(null_safe_bool(F.col("z") > z_max)).alias("n_outliers"),
                             F.max("_std").alias("return_std"))
    skipped = (F.col("n_returns") == 0) | F.coalesce(F.col("return_std") == 0, F.lit(True))
    pct = F.when(skipped, F.lit(0.0)).otherwise(F.col("n_outliers").cast("double") * 100.0 / F.col("n_returns"))
    return (out.withColumn("outlier_pct", pct).withColumn("skipped", skipped)
            .withColumn("passed", F.col("outlier_pct") <= pct_max).drop("return_std"))


def outlier_rows(df: DataFrame, key: str = KEY, order: str = ORDER, z_max: float = OUTLIER_Z,
                 k: int = EXAMPLES_SHOWN) -> DataFrame:
    """C4 examples: first k outlying returns per ticker by date."""
    z = return_z(df, key, order).filter(null_safe_bool(F.col("z") > z_max))
    return (z.withColumn("rank", F.row_number().over(by_ticker(key, order)).cast("bigint"))
            .filter(F.col("rank") <= k).select(key, "rank", order, "returns", "z"))


def label_balance(df: DataFrame, key: str = KEY, label: str = TARGET, lo: float = MIN_LABEL_BALANCE,
                  hi: float = MAX_LABEL_BALANCE) -> DataFrame:
    """Minority class count / all rows within [0.2, 0.8].

    A single-class ticker has minority = all rows -> ratio 1.0 -> fails as
    "too balanced", as in the reference.
    """
    counts = df.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    per = (counts.groupBy(key).agg(
        F.min(F.when(F.col(label).isNotNull(), F.col("n"))).alias("minority_count"),
        F.sum("n").alias("n_rows"),
        F.map_from_entries(F.collect_list(F.when(F.col(label).isNotNull(),
                                                 F.struct(F.col(label), F.col("n"))))).alias("label_distribution")))
    ratio = F.coalesce(safe_div(F.col("minority_count").cast("double"), F.col("n_rows").cast("double")), F.lit(0.0))
    return (per.withColumn("minority_ratio", ratio)
            .withColumn("passed", (F.col("minority_ratio") >= lo) & (F.col("minority_ratio") <= hi)))


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def lookahead_columns(schema: T.StructType, target: str = TARGET) -> list[tuple[str, str]]:
    """Numeric columns whose lower-cased name contains a look-ahead keyword.

    Schema metadata only; returns (column, first matching keyword) pairs.
    """
    keys = [target] + LOOKAHEAD_KEYWORDS
    out = []
    for f in schema.fields:
        if not isinstance(f.dataType, NUMERIC) or f.name == target:
            continue
        hit = next((k for k in keys if k.lower() in f.name.lower()), None)
        if hit:
            out.append((f.name, hit))
    return out


def lookahead_report(df: DataFrame, key: str = KEY, target: str = TARGET) -> DataFrame:
    """C6 as a table: per ticker, each suspicious numeric column, its keyword and non-null count.

    The column list is schema metadata; the counts are one aggregate over the
    data, so a leaky column that is empty for a ticker is visible as 0.
    """
    hits = lookahead_columns(df.schema, target)
    schema = "ticker string, `column` string, keyword string, n_values bigint".replace("ticker", key, 1)
    if not hits:
        return df.sparkSession.createDataFrame([], schema)
    agg = df.groupBy(key).agg(*[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, (c, _) in enumerate(hits)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("keyword"), F.col(f"_n{i}").alias("n_values"))
            for i, (c, k) in enumerate(hits)]
    return agg.select(key, F.inline(F.array(*rows)))


def feasibility_report(df: DataFrame, key: str = KEY, order: str = ORDER, label: str | None = TARGET) -> DataFrame:
    """One row per (ticker, check) for all six checks.

    C1-C4 come from one aggregate over rows flagged by one window family
    (gap to the previous bar, daily return) and the ticker's own mean / sample
    std of the return; the label distribution is one small
    aggregate of its own.  The checks are stacked with an ``inline`` of a
    struct array.  Same values as the per-check operators above.
    """
    df = nan_to_null(df)
    n_suspicious = len(lookahead_columns(df.schema, label)) if label else 0
    gaps = add_returns(df.select(key, order, *OHLCV), key=key, order=order).withColumn(
        "_gap", F.datediff(F.col(order), F.lag(order).over(by_ticker(key, order))))
    z = _with_return_stats(gaps, key)
    nulls = sum((F.col(c).isNull().cast("bigint") for c in OHLCV), F.lit(0).cast("bigint"))
    per = (z.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(nulls).cast("bigint").alias("_missing"),
        F.max("_gap").alias("max_gap_days"),
        F.count("returns").alias("_n_returns"),
        F.count_if(null_safe_bool(F.col("z") > OUTLIER_Z)).alias("_n_outliers"),
        F.max("_std").alias("_return_std")))
    cells = F.col("n_rows") * len(OHLCV)
    completeness = F.coalesce(safe_div((cells - F.col("_missing")).cast("double") * 100.0, cells.cast("double")),
                              F.lit(0.0))
    skipped = (F.col("_n_returns") == 0) | F.coalesce(F.col("_return_std") == 0, F.lit(True))
    outlier_pct = F.when(skipped, F.lit(0.0)).otherwise(
        F.col("_n_outliers").cast("double") * 100.0 / F.col("_n_returns"))
    rows = [
        _row("min_samples", F.col("n_rows"), MIN_SAMPLES, F.col("n_rows") >= MIN_SAMPLES),
        _row("completeness", completeness, MIN_COMPLETENESS_PCT, completeness >= MIN_COMPLETENESS_PCT),
        _row("temporal_continuity", F.col("max_gap_days"), MAX_GAP_DAYS,
             F.coalesce(F.col("max_gap_days") <= MAX_GAP_DAYS, F.lit(True))),
        _row("outliers", outlier_pct, MAX_OUTLIER_PCT, outlier_pct <= MAX_OUTLIER_PCT),
    ]
    if label and label in df.columns:
        lb = label_balance(df, key, label).select(key, "minority_ratio", F.col("passed").alias("_c5"))
        per = per.join(lb, key)
        rows.append(_row("label_balance", F.col("minority_ratio"), MIN_LABEL_BALANCE, F.col("_c5")))
    rows.append(_row("lookahead_bias", F.lit(n_suspicious), 0, F.lit(n_suspicious == 0)))
    return per.select(key, F.inline(F.array(*rows)))


def feasibility_verdict(report: DataFrame, key: str = KEY) -> DataFrame:
    """C7 verdict: production_ready when every check passed."""
    return (report.groupBy(key).agg(F.bool_and("passed").alias("production_ready"),
                                    F.count_if(~F.col("passed")).alias("n_failed"),
                                    F.count(F.lit(1)).alias("n_checks"))
            .withColumn("verdict", F.when(F.col("production_ready"), F.lit("PASS")).otherwise(F.lit("FAIL"))))


CHECK_ORDER = ["min_samples", "completeness", "temporal_continuity", "outliers", "label_balance", "lookahead_bias"]


def feasibility_strict(df: DataFrame, key: str = KEY, order: str = ORDER, label: str | None = TARGET) -> DataFrame:
    """Raise on the first failed check (reference order) of the first failing ticker."""
    rep = feasibility_report(df, key, order, label)
    failed = (
        rep.filter(~F.col("passed"))
        .withColumn("_o", F.array_position(F.array(*[F.lit(c) for c in CHECK_ORDER]), F.col("check")))
        .orderBy(key, "_o").limit(1).collect())
    if failed:
        r = failed[0]
        raise DataFeasibilityError(f"{r['check']} check FAILED for {r[key]}: value {r['value']}")
    return rep


def trading_calendar(df: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Weekdays between each ticker's first and last bar, flagged with has_bar.

    One generated row per calendar day per ticker (bounded by the date span),
    then a left join to the bars on (ticker, Date).
    """
    span = df.groupBy(key).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    cal = (span.select(key, F.explode(F.sequence("_lo", "_hi")).alias(order))
           .filter(F.weekday(order) < 5))
    present = df.select(key, order).distinct().withColumn("has_bar", F.lit(True))
    return (cal.join(present, [key, order], "left")
            .withColumn("has_bar", F.coalesce("has_bar", F.lit(False))))


def missing_days(df: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Weekdays inside each ticker's span that have no bar (left anti join)."""
    span = df.groupBy(key).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    cal = (span.select(key, F.explode(F.sequence("_lo", "_hi")).alias(order))
           .filter(F.weekday(order) < 5))
    return cal.join(df.select(key, order), [key, order], "left_anti")
