"""Bar resampling and rolling-feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerwise.operators import features as feat
from tickerwise.plans import sql_blocks as S
from tickerwise.plans.registry import register
from tickerwise.sources import bars_daily, bars_hourly

BARS = f"WITH bars AS ({S.BARS_DAILY})"
FEAT = f"{BARS}, {S.features('bars')}"


@register("bars_daily", f"{BARS} SELECT * FROM bars")
def q_bars_daily(spark, sf):
    """Daily OHLCV bars per brand from lineitem x part."""
    return bars_daily(spark, sf)


@register("bars_hourly", f"WITH bars AS ({S.BARS_HOURLY}) SELECT * FROM bars")
def q_bars_hourly(spark, sf):
    """Hourly OHLCV bars per event type from events."""
    return bars_hourly(spark, sf)


@register("features_full", f"{FEAT} SELECT ticker, Date, {S.r6(S.FEATURE_COLS)} FROM feat_all "
          f"WHERE {S.not_null(S.FEATURE_COLS)}")
def q_features_full(spark, sf):
    """Bars -> returns, ma_5/10/20, volatility_5/10/20, target, warm-up dropped."""
    return feat.features_full(bars_daily(spark, sf))


@register("returns", f"{FEAT} SELECT ticker, Date, Close, round(returns, 6) AS returns FROM feat_all")
def q_returns(spark, sf):
    """Daily return per ticker (first bar NULL)."""
    return feat.add_returns(bars_daily(spark, sf)).select("ticker", "Date", "Close", "returns")


@register("rolling_mean", f"{FEAT} SELECT ticker, Date, Close, {S.r6(['ma_5', 'ma_10', 'ma_20'])} FROM feat_all")
def q_rolling_mean(spark, sf):
    """N-row rolling means, NULL during the warm-up."""
    return feat.add_rolling_means(bars_daily(spark, sf)).select("ticker", "Date", "Close", "ma_5", "ma_10", "ma_20")


@register("rolling_volatility",
          f"{FEAT} SELECT ticker, Date, {S.r6(['returns', 'volatility_5', 'volatility_10', 'volatility_20'])} FROM feat_all")
def q_rolling_volatility(spark, sf):
    """N-row sample std of returns, NULL until N returns exist."""
    return feat.add_rolling_volatility(bars_daily(spark, sf)).select(
        "ticker", "Date", "returns", "volatility_5", "volatility_10", "volatility_20")


@register("target_label", f"{FEAT} SELECT ticker, Date, Close, target FROM feat_all")
def q_target_label(spark, sf):
    """Next-bar up label; the last bar of each ticker is 0."""
    return feat.add_target(bars_daily(spark, sf)).select("ticker", "Date", "Close", "target")


@register("warmup_dropped", f"""{FEAT}
SELECT ticker, CAST(count(*) AS BIGINT) AS rows_in,
  CAST(sum(CASE WHEN {S.not_null(['ticker', 'Date'] + S.FEATURE_COLS)} THEN 1 ELSE 0 END) AS BIGINT) AS rows_out,
  CAST(count(*) - sum(CASE WHEN {S.not_null(['ticker', 'Date'] + S.FEATURE_COLS)} THEN 1 ELSE 0 END) AS BIGINT) AS dropped
FROM feat_all GROUP BY ticker""")
def q_warmup_dropped(spark, sf):
    """Rows lost to the rolling warm-up per ticker."""
    return feat.warmup_dropped(bars_daily(spark, sf))


@register("cumulative_return", f"""{BARS},
lr AS (SELECT ticker, Date, Close,
  ln(CASE WHEN lag(Close) OVER (PARTITION BY ticker ORDER BY Date) <> 0
          THEN Close / lag(Close) OVER (PARTITION BY ticker ORDER BY Date) END) AS log_return FROM bars),
cum AS (SELECT *, coalesce(sum(log_return) OVER (PARTITION BY ticker ORDER BY Date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS cum_log_return FROM lr)
SELECT ticker, Date, Close, round(log_return, 6) AS log_return, round(cum_log_return, 6) AS cum_log_return,
  round(exp(cum_log_return) - 1.0, 6) AS cum_return FROM cum""")
def q_cumulative_return(spark, sf):
    """Running log return and compounded return per ticker."""
    return feat.cumulative_return(bars_daily(spark, sf).select("ticker", "Date", "Close"))


SPLIT_SQL = """
SELECT *, CASE WHEN row_number() OVER (PARTITION BY ticker ORDER BY Date)
   <= floor(CAST(count(*) OVER (PARTITION BY ticker) AS DOUBLE) * CAST({r} AS DOUBLE))
  THEN 'train' ELSE 'test' END AS split FROM {src}"""


@register("temporal_split", f"""{FEAT}, fe AS (SELECT * FROM feat_all WHERE {S.not_null(S.FEATURE_COLS)}),
sp AS ({SPLIT_SQL.format(r=0.8, src='fe')})
SELECT ticker, Date, split FROM sp""")
def q_temporal_split(spark, sf):
    """Chronological 80/20 split per ticker of the feature table."""
    return feat.temporal_split(feat.features_full(bars_daily(spark, sf))).select("ticker", "Date", "split")


@register("head_tail", f"""{BARS},
t AS (SELECT ticker, Date, Close,
  row_number() OVER (PARTITION BY ticker ORDER BY Date ASC) AS _a,
  row_number() OVER (PARTITION BY ticker ORDER BY Date DESC) AS _d FROM bars)
SELECT ticker, Date, Close, 'head' AS part, CAST(_a AS BIGINT) AS pos FROM t WHERE _a <= 5
UNION ALL
SELECT ticker, Date, Close, 'tail' AS part, CAST(_d AS BIGINT) AS pos FROM t WHERE _d <= 5""")
def q_head_tail(spark, sf):
    """First / last 5 bars per ticker (a top-k report)."""
    return feat.head_tail(bars_daily(spark, sf).select("ticker", "Date", "Close"), 5)
