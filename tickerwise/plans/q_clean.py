"""Cleaning, data-contract and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerwise.operators import aggregates as agg
from tickerwise.operators import clean, validate
from tickerwise.operators import features as feat
from tickerwise.plans import sql_blocks as S
from tickerwise.plans.registry import register
from tickerwise.sources.reuse import reuse
from tickerwise.schema import OHLCV
from tickerwise.sources import bars_daily, dirty_bars

BARS = f"WITH bars AS ({S.BARS_DAILY})"
DIRTY = f"{BARS}, {S.dirty()}"
DIRTY_HEAVY = f"{BARS}, {S.dirty(heavy=True)}"

DEDUP_SQL = """dedup AS (SELECT * EXCLUDE (_nd) FROM (
  SELECT *, lead(Date) OVER (PARTITION BY ticker ORDER BY Date, seq) AS _nd FROM dirty)
  WHERE _nd IS NULL OR _nd <> Date)"""

FILL_SQL = "filled AS (SELECT ticker, Date, seq, " + ", ".join(
    f"coalesce({c}, last_value({c} IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY Date "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER "
    f"(PARTITION BY ticker ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {c}"
    for c in OHLCV) + " FROM dedup)"

CLEAN_SQL = f"{DEDUP_SQL}, {FILL_SQL}, cleaned AS (SELECT * FROM filled WHERE Volume > 0)"

RULE_SQL = """CASE
  WHEN coalesce(Open <= 0 OR High <= 0 OR Low <= 0 OR Close <= 0, false) THEN 'negative_or_zero_prices'
  WHEN coalesce(Volume < 0, false) THEN 'negative_volume'
  WHEN coalesce(High < Low, false) THEN 'high_less_than_low'
  WHEN coalesce(High < Open, false) THEN 'high_less_than_open'
  WHEN coalesce(High < Close, false) THEN 'high_less_than_close'
  WHEN coalesce(Low > Open, false) THEN 'low_greater_than_open'
  WHEN coalesce(Low > Close, false) THEN 'low_greater_than_close'
END"""

GATE_SQL = f"""SELECT ticker, CAST(count(*) AS BIGINT) AS rows_before,
  CAST(count(*) FILTER (WHERE v IS NOT NULL) AS BIGINT) AS rows_removed,
  CAST(count(*) FILTER (WHERE v IS NOT NULL) AS DOUBLE) * 100.0 / count(*) AS removal_pct
FROM (SELECT *, {RULE_SQL} AS v FROM {{src}}) GROUP BY ticker"""


def _dirty(spark, sf, heavy=False):
    return dirty_bars(spark, sf, heavy=heavy)


def _cleaned(spark, sf):
    return clean.clean_bars(_dirty(spark, sf))


@register("dedup_keep_last", f"{DIRTY}, {DEDUP_SQL} SELECT ticker, Date, seq, Close FROM dedup")
def q_dedup_keep_last(spark, sf):
    """One row per (ticker, Date), the last to arrive."""
    return clean.dedup_keep_last(_dirty(spark, sf)).select("ticker", "Date", "seq", "Close")


@register("fill_ffill_bfill", f"{DIRTY}, {DEDUP_SQL}, {FILL_SQL} SELECT * FROM filled")
def q_fill(spark, sf):
    """Forward then backward fill of OHLCV per ticker."""
    return clean.fill_ffill_bfill(clean.dedup_keep_last(_dirty(spark, sf))).select(
        "ticker", "Date", "seq", *OHLCV)


@register("clean_bars", f"{DIRTY}, {CLEAN_SQL} SELECT * FROM cleaned")
def q_clean_bars(spark, sf):
    """P5: dedup -> fill -> drop Volume <= 0."""
    return _cleaned(spark, sf).select("ticker", "Date", "seq", *OHLCV)


@register("time_contract", f"""{DIRTY},
t1 AS (SELECT ticker, Date, seq,
  coalesce(lag(Date) OVER (PARTITION BY ticker ORDER BY Date, seq) = Date, false) AS rep,
  coalesce(lag(Date) OVER (PARTITION BY ticker ORDER BY seq) > Date, false) AS uns FROM dirty),
t2 AS (SELECT *, sum(CAST(rep AS INTEGER)) OVER (PARTITION BY ticker ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dr FROM t1)
SELECT ticker, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE rep) AS BIGINT) AS n_duplicates,
  coalesce(array_to_string(list_transform(list_sort(list(Date) FILTER (WHERE rep AND dr <= 5)),
    lambda d: strftime(d, '%Y-%m-%d')), ','), '') AS duplicate_examples,
  CAST(count(*) FILTER (WHERE uns) AS BIGINT) AS n_out_of_order,
  CAST(count(*) FILTER (WHERE isodow(Date) - 1 >= 5) AS BIGINT) AS n_weekend,
  count(*) FILTER (WHERE uns) = 0 AS is_sorted,
  count(*) FILTER (WHERE rep) = 0 AND count(*) FILTER (WHERE uns) = 0 AS passed
FROM t2 GROUP BY ticker""")
def q_time_contract(spark, sf):
    """V2: duplicates, arrival order and weekend rows per ticker."""
    t = validate.time_contract(_dirty(spark, sf))
    return t.withColumn("duplicate_examples", F.array_join(
        F.transform("duplicate_examples", lambda d: F.date_format(d, "yyyy-MM-dd")), ","))


@register("integrity_filter", f"{DIRTY} SELECT ticker, Date, seq, Open, High, Low, Close, Volume "
          f"FROM dirty WHERE ({RULE_SQL}) IS NULL")
def q_integrity_filter(spark, sf):
    """V3: rows that break none of the seven integrity rules."""
    return validate.integrity_filter(_dirty(spark, sf)).select("ticker", "Date", "seq", *OHLCV)


@register("integrity_breakdown", f"""{DIRTY}
SELECT ticker, v AS rule, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT ticker, {RULE_SQL} AS v FROM dirty) WHERE v IS NOT NULL GROUP BY ticker, v""")
def q_integrity_breakdown(spark, sf):
    """V4: rows charged to each rule (first broken rule wins)."""
    return validate.integrity_breakdown(_dirty(spark, sf))


@register("integrity_gate", f"{DIRTY} SELECT *, removal_pct <= 10.0 AS passed FROM ({GATE_SQL.format(src='dirty')})")
def q_integrity_gate(spark, sf):
    """V5: removal rate per ticker, passes at <= 10 %."""
    return validate.integrity_gate(_dirty(spark, sf))


@register("integrity_gate_heavy",
          f"{DIRTY_HEAVY} SELECT *, removal_pct <= 10.0 AS passed FROM ({GATE_SQL.format(src='dirty')})")
def q_integrity_gate_heavy(spark, sf):
    """V5 failing side: every 5th bar broken, so the gate trips."""
    return validate.integrity_gate(_dirty(spark, sf, heavy=True))


@register("missing_counts", f"""{DIRTY},
m AS (SELECT ticker, {', '.join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}" for c in OHLCV)}
  FROM dirty GROUP BY ticker)
SELECT ticker, "column", n_missing, n_missing = 0 AS passed FROM m
UNPIVOT (n_missing FOR "column" IN ({', '.join(OHLCV)}))""")
def q_missing_counts(spark, sf):
    """V6: NULL cells per ticker and OHLCV column."""
    return validate.missing_counts(_dirty(spark, sf))


SUMMARY_SQL = """SELECT ticker, CAST(count(*) AS BIGINT) AS total_rows, min(Date) AS start_date, max(Date) AS end_date,
  min(Close) AS close_min, max(Close) AS close_max, round(avg(Close), 6) AS close_mean,
  round(stddev_samp(Close), 6) AS close_std, round(avg(Volume), 6) AS volume_mean,
  min(Volume) AS volume_min, max(Volume) AS volume_max FROM {src} GROUP BY ticker"""


@register("bar_summary", f"{BARS} {SUMMARY_SQL.format(src='bars')}")
def q_bar_summary(spark, sf):
    """V7: rows, date range, Close and Volume statistics per ticker."""
    return validate.bar_summary(bars_daily(spark, sf))


@register("validated_bars", f"{DIRTY}, {CLEAN_SQL} SELECT * FROM cleaned WHERE ({RULE_SQL}) IS NULL")
def q_validated_bars(spark, sf):
    """V8: cleaned bars that pass the contract."""
    valid, _ = validate.validate_bars(_cleaned(spark, sf))
    return valid.select("ticker", "Date", "seq", *OHLCV)


@register("validation_stats", f"""{DIRTY}, {CLEAN_SQL},
valid AS (SELECT * FROM cleaned WHERE ({RULE_SQL}) IS NULL),
s AS ({SUMMARY_SQL.format(src='valid')}),
g AS ({GATE_SQL.format(src='cleaned')})
SELECT g.ticker, coalesce(s.total_rows, 0) AS total_rows, g.rows_before, g.rows_removed,
  round(g.removal_pct, 6) AS removal_pct, s.start_date, s.end_date, s.close_min, s.close_max, s.close_mean,
  s.close_std, s.volume_mean, s.volume_min, s.volume_max, g.removal_pct <= 10.0 AS passed
FROM g LEFT JOIN s ON g.ticker = s.ticker""")
def q_validation_stats(spark, sf):
    """V8: one row of validation statistics per ticker (cleaned input)."""
    _, stats = validate.validate_bars(_cleaned(spark, sf))
    return stats.select("ticker", "total_rows", "rows_before", "rows_removed", "removal_pct", "start_date",
                        "end_date", "close_min", "close_max", "close_mean", "close_std", "volume_mean",
                        "volume_min", "volume_max", "passed")


GRADE_SQL = """CASE WHEN rows_removed = 0 THEN 'EXCELLENT'
  WHEN rows_removed < rows_before * 0.05 THEN 'ACCEPTABLE' ELSE 'NEEDS REVIEW' END"""


@register("quality_grade", f"""{DIRTY}, {CLEAN_SQL}
SELECT ticker, rows_before, rows_removed, {GRADE_SQL} AS grade FROM ({GATE_SQL.format(src='cleaned')})""")
def q_quality_grade(spark, sf):
    """V9: EXCELLENT / ACCEPTABLE / NEEDS REVIEW per ticker."""
    g = validate.integrity_gate(_cleaned(spark, sf))
    return g.select("ticker", "rows_before", "rows_removed",
                    validate.quality_grade(F.col("rows_removed"), F.col("rows_before")).alias("grade"))


@register("quality_report", f"""{DIRTY}, {CLEAN_SQL},
valid AS (SELECT * FROM cleaned WHERE ({RULE_SQL}) IS NULL),
s AS ({SUMMARY_SQL.format(src='valid')}),
g AS ({GATE_SQL.format(src='cleaned')})
SELECT g.ticker, 'primary' AS data_source, s.total_rows, g.rows_before, g.rows_removed, {GRADE_SQL} AS grade,
  s.start_date, s.end_date, s.close_min, s.close_max, s.close_mean, s.close_std,
  s.volume_mean, s.volume_min, s.volume_max
FROM g JOIN s ON g.ticker = s.ticker""")
def q_quality_report(spark, sf):
    """A5: validation summary + grade + source per ticker."""
    _, stats = validate.validate_bars(_cleaned(spark, sf))
    return (stats.select(
        "ticker", F.lit("primary").alias("data_source"), "total_rows", "rows_before", "rows_removed",
        validate.quality_grade(F.col("rows_removed"), F.col("rows_before")).alias("grade"),
        "start_date", "end_date", "close_min", "close_max", "close_mean", "close_std",
        "volume_mean", "volume_min", "volume_max"))


@register("freshness", f"""{BARS}
SELECT ticker, max(Date) AS last_date,
  CAST(date_diff('day', max(Date), (SELECT max(Date) FROM bars)) AS INTEGER) AS age_days,
  date_diff('day', max(Date), (SELECT max(Date) FROM bars)) > 7 AS stale
FROM bars GROUP BY ticker""")
def q_freshness(spark, sf):
    """Days between each ticker's last bar and the newest bar of all tickers."""
    b = bars_daily(spark, sf)
    as_of = b.select(F.max("Date")).scalar()
    return validate.freshness(b, as_of)


@register("describe_bars", f"""{BARS}
SELECT ticker, "column", CAST(count(value) AS BIGINT) AS count, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS std, min(value) AS min,
  round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max
FROM (SELECT ticker, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in OHLCV)} FROM bars)
UNPIVOT (value FOR "column" IN ({', '.join(OHLCV)}))
GROUP BY ticker, "column\"""")
def q_describe_bars(spark, sf):
    """A4: describe() of OHLCV per ticker, exact quartiles."""
    return agg.describe(bars_daily(spark, sf))


@register("up_down_days", f"""{BARS},
d AS (SELECT ticker, Close - lag(Close) OVER (PARTITION BY ticker ORDER BY Date) AS d FROM bars)
SELECT ticker, CAST(count(*) FILTER (WHERE d > 0) AS BIGINT) AS up_days,
  CAST(count(*) FILTER (WHERE d < 0) AS BIGINT) AS down_days,
  round(CASE WHEN count(*) FILTER (WHERE d > 0 OR d < 0) <> 0 THEN
    CAST(count(*) FILTER (WHERE d > 0) AS DOUBLE) / count(*) FILTER (WHERE d > 0 OR d < 0) END, 6) AS up_share
FROM d GROUP BY ticker""")
def q_up_down_days(spark, sf):
    """Up and down moves per ticker."""
    return agg.up_down_days(bars_daily(spark, sf))


FEAT_SPLIT = (f"{BARS}, {S.features('bars')}, fe AS (SELECT * FROM feat_all WHERE {S.not_null(S.FEATURE_COLS)}), "
              f"sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY ticker ORDER BY Date) <= "
              f"floor(CAST(count(*) OVER (PARTITION BY ticker) AS DOUBLE) * CAST(0.8 AS DOUBLE)) "
              f"THEN 'train' ELSE 'test' END AS split FROM fe)")


def split_features(spark, sf):
    """Features + chronological split; written once per run inside ``shared_inputs`` (several legs read it)."""
    return reuse(("split_features", sf), lambda: feat.temporal_split(feat.features_full(bars_daily(spark, sf))))


@register("class_distribution", f"{FEAT_SPLIT} SELECT ticker, split, target, CAST(count(*) AS BIGINT) AS n_rows "
          f"FROM sp GROUP BY ticker, split, target")
def q_class_distribution(spark, sf):
    """A2: label counts per ticker and split."""
    return agg.class_distribution(split_features(spark, sf))


@register("positive_rate", f"{FEAT_SPLIT} SELECT ticker, split, CAST(count(*) AS BIGINT) AS n_rows, "
          f"round(avg(CAST(target AS DOUBLE)), 6) AS positive_rate FROM sp GROUP BY ticker, split")
def q_positive_rate(spark, sf):
    """A3: share of up labels per ticker and split."""
    return agg.positive_rate(split_features(spark, sf))


@register("split_manifest", f"{FEAT_SPLIT} SELECT ticker, split, CAST(count(*) AS BIGINT) AS n_rows, "
          f"min(Date) AS start_date, max(Date) AS end_date, CAST(12 AS BIGINT) AS n_features "
          f"FROM sp GROUP BY ticker, split")
def q_split_manifest(spark, sf):
    """Rows, date range and feature count per ticker and split."""
    return agg.split_manifest(split_features(spark, sf), 12)
