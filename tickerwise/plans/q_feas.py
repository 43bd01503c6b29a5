"""Feasibility queries (C1-C7), trading calendar and missing days."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerwise.operators import feasibility as fz
from tickerwise.operators.features import add_target
from tickerwise.plans import sql_blocks as S
from tickerwise.plans.registry import register
from tickerwise.sources import bars_daily

FB = f"""WITH bars AS ({S.BARS_DAILY}),
fb AS (SELECT *, CAST(CASE WHEN coalesce(lead(Close) OVER (PARTITION BY ticker ORDER BY Date) > Close, false)
  THEN 1 ELSE 0 END AS INTEGER) AS target FROM bars)"""

C1 = "SELECT ticker, CAST(count(*) AS BIGINT) AS n_rows, count(*) >= 100 AS passed FROM fb GROUP BY ticker"
C2 = """SELECT ticker, total_cells, missing_cells,
  coalesce(CASE WHEN total_cells <> 0 THEN CAST(total_cells - missing_cells AS DOUBLE) * 100.0 / total_cells END, 0.0)
    AS completeness_pct
FROM (SELECT ticker, CAST(count(*) * 5 AS BIGINT) AS total_cells,
  CAST(sum(CAST(Open IS NULL AS BIGINT) + CAST(High IS NULL AS BIGINT) + CAST(Low IS NULL AS BIGINT)
    + CAST(Close IS NULL AS BIGINT) + CAST(Volume IS NULL AS BIGINT)) AS BIGINT) AS missing_cells
  FROM fb GROUP BY ticker)"""
GAPS = """gaps AS (SELECT ticker, Date, lag(Date) OVER (PARTITION BY ticker ORDER BY Date) AS gap_start,
  CAST(date_diff('day', lag(Date) OVER (PARTITION BY ticker ORDER BY Date), Date) AS INTEGER) AS gap_days FROM fb)"""
C3 = """SELECT ticker, max(gap_days) AS max_gap_days, CAST(count(*) FILTER (WHERE gap_days > 10) AS BIGINT) AS n_large_gaps,
  coalesce(max(gap_days) <= 10, true) AS passed FROM gaps GROUP BY ticker"""
RZ = """pc AS (SELECT ticker, Date, last_value(Close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY Date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _pc FROM fb),
rr AS (SELECT ticker, Date, CASE WHEN _prev <> 0 THEN _pc / _prev END - 1.0 AS returns
  FROM (SELECT *, lag(_pc) OVER (PARTITION BY ticker ORDER BY Date) AS _prev FROM pc)),
rz AS (SELECT *, abs(CASE WHEN _std <> 0 THEN (returns - _mean) / _std END) AS z FROM (
  SELECT *, avg(returns) OVER (PARTITION BY ticker) AS _mean, stddev_samp(returns) OVER (PARTITION BY ticker) AS _std
  FROM rr))"""
C4 = """SELECT ticker, n_returns, n_outliers,
  CASE WHEN skipped THEN 0.0 ELSE CAST(n_outliers AS DOUBLE) * 100.0 / n_returns END AS outlier_pct, skipped,
  CASE WHEN skipped THEN 0.0 ELSE CAST(n_outliers AS DOUBLE) * 100.0 / n_returns END <= 1.0 AS passed
FROM (SELECT ticker, CAST(count(returns) AS BIGINT) AS n_returns,
  CAST(count(*) FILTER (WHERE coalesce(z > 4.0, false)) AS BIGINT) AS n_outliers,
  count(returns) = 0 OR coalesce(max(_std) = 0, true) AS skipped FROM rz GROUP BY ticker)"""
C5 = """SELECT ticker, minority_count, n_rows,
  coalesce(CASE WHEN n_rows <> 0 THEN CAST(minority_count AS DOUBLE) / n_rows END, 0.0) AS minority_ratio
FROM (SELECT ticker, CAST(min(n) FILTER (WHERE target IS NOT NULL) AS BIGINT) AS minority_count,
  CAST(sum(n) AS BIGINT) AS n_rows
  FROM (SELECT ticker, target, count(*) AS n FROM fb GROUP BY ticker, target) GROUP BY ticker)"""


def _fb(spark, sf):
    return add_target(bars_daily(spark, sf))


@register("feas_min_samples", f"{FB} {C1}")
def q_min_samples(spark, sf):
    """At least 100 bars per ticker."""
    return fz.min_samples(_fb(spark, sf))


@register("feas_completeness", f"{FB}, c AS ({C2}) SELECT *, completeness_pct >= 90.0 AS passed FROM c")
def q_completeness(spark, sf):
    """Non-null OHLCV cells in %."""
    return fz.completeness(_fb(spark, sf))


@register("feas_gaps", f"{FB}, {GAPS} {C3}")
def q_gaps(spark, sf):
    """Largest gap between consecutive bars, calendar days."""
    return fz.continuity(_fb(spark, sf))


@register("feas_gap_list", f"""{FB}, {GAPS}
SELECT ticker, CAST(rank AS BIGINT) AS rank, gap_start, gap_end, gap_days FROM (
  SELECT ticker, gap_start, Date AS gap_end, gap_days,
    row_number() OVER (PARTITION BY ticker ORDER BY Date) AS rank FROM gaps WHERE gap_days > 10)
WHERE rank <= 5""")
def q_gap_list(spark, sf):
    """C3 examples: first 5 gaps over 10 days per ticker."""
    return fz.gap_list(_fb(spark, sf))


@register("feas_outliers", f"{FB}, {RZ} {C4}")
def q_outliers(spark, sf):
    """C4: share of |z| > 4 daily returns per ticker."""
    return fz.outliers(_fb(spark, sf))


@register("feas_outlier_rows", f"""{FB}, {RZ}
SELECT ticker, CAST(rank AS BIGINT) AS rank, Date, round(returns, 6) AS returns, round(z, 6) AS z FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY Date) AS rank FROM rz WHERE coalesce(z > 4.0, false))
WHERE rank <= 5""")
def q_outlier_rows(spark, sf):
    """C4 examples: first 5 outlying returns per ticker."""
    return fz.outlier_rows(_fb(spark, sf))


@register("feas_label_balance", f"{FB}, c AS ({C5}) SELECT *, minority_ratio >= 0.2 AND minority_ratio <= 0.8 AS passed FROM c")
def q_label_balance(spark, sf):
    """Minority label share within [0.2, 0.8]."""
    return fz.label_balance(_fb(spark, sf)).drop("label_distribution")


REPORT_SQL = f"""{FB}, {GAPS}, {RZ},
c1 AS ({C1}), c2 AS ({C2}), c3 AS ({C3}), c4 AS ({C4}), c5 AS ({C5}),
rep AS (
  SELECT ticker, 'min_samples' AS "check", CAST(n_rows AS DOUBLE) AS value, CAST(100.0 AS DOUBLE) AS threshold, passed FROM c1
  UNION ALL SELECT ticker, 'completeness', round(completeness_pct, 6), 90.0, completeness_pct >= 90.0 FROM c2
  UNION ALL SELECT ticker, 'temporal_continuity', CAST(max_gap_days AS DOUBLE), 10.0, passed FROM c3
  UNION ALL SELECT ticker, 'outliers', round(outlier_pct, 6), 1.0, passed FROM c4
  UNION ALL SELECT ticker, 'label_balance', round(minority_ratio, 6), 0.2,
    minority_ratio >= 0.2 AND minority_ratio <= 0.8 FROM c5
  UNION ALL SELECT ticker, 'lookahead_bias', 0.0, 0.0, true FROM c1)"""


@register("feasibility_report", f"{REPORT_SQL} SELECT * FROM rep")
def q_feasibility_report(spark, sf):
    """Every check for every ticker as (ticker, check, value, threshold, passed)."""
    return fz.feasibility_report(_fb(spark, sf))


@register("feasibility_verdict", f"""{REPORT_SQL}
SELECT ticker, bool_and(passed) AS production_ready, CAST(count(*) FILTER (WHERE NOT passed) AS BIGINT) AS n_failed,
  CAST(count(*) AS BIGINT) AS n_checks, CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM rep GROUP BY ticker""")
def q_feasibility_verdict(spark, sf):
    """C7 verdict: PASS only when all six checks pass."""
    return fz.feasibility_verdict(fz.feasibility_report(_fb(spark, sf)))


CAL = f"""WITH bars AS ({S.BARS_DAILY}),
span AS (SELECT ticker, min(Date) AS lo, max(Date) AS hi FROM bars GROUP BY ticker),
cal AS (SELECT ticker, CAST(d AS DATE) AS Date FROM span, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS t(d)
  WHERE isodow(CAST(d AS DATE)) - 1 < 5)"""


@register("trading_calendar", f"""{CAL}
SELECT c.ticker, c.Date, EXISTS (SELECT 1 FROM bars b WHERE b.ticker = c.ticker AND b.Date = c.Date) AS has_bar FROM cal c""")
def q_trading_calendar(spark, sf):
    """Weekday calendar over each ticker's span, flagged with has_bar."""
    return fz.trading_calendar(bars_daily(spark, sf))


@register("missing_days", f"{CAL} SELECT ticker, Date FROM cal c WHERE NOT EXISTS "
          f"(SELECT 1 FROM bars b WHERE b.ticker = c.ticker AND b.Date = c.Date)")
def q_missing_days(spark, sf):
    """Weekdays inside each ticker's span without a bar."""
    return fz.missing_days(bars_daily(spark, sf))


LEAKY_SQL = """lk AS (SELECT *, lead(Close) OVER (PARTITION BY ticker ORDER BY Date) AS future_price,
  lead(Volume) OVER (PARTITION BY ticker ORDER BY Date) AS next_day_volume FROM fb)"""


@register("lookahead_columns", f"""{FB}, {LEAKY_SQL}
SELECT ticker, 'future_price' AS "column", 'future' AS keyword, CAST(count(future_price) AS BIGINT) AS n_values
FROM lk GROUP BY ticker
UNION ALL
SELECT ticker, 'next_day_volume' AS "column", 'next' AS keyword, CAST(count(next_day_volume) AS BIGINT) AS n_values
FROM lk GROUP BY ticker""")
def q_lookahead_columns(spark, sf):
    """Bars with two leaked next-bar columns; each is reported per ticker with its keyword."""
    from tickerwise.functions.exprs import by_ticker
    w = by_ticker()
    fb = add_target(bars_daily(spark, sf))
    leaky = fb.withColumns({"future_price": F.lead("Close").over(w), "next_day_volume": F.lead("Volume").over(w)})
    return fz.lookahead_report(leaky)
