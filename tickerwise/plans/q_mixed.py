"""Queries over bars of mixed quality: every check has tickers on either side of its limit.

The bars are derived from the daily bars: by brand number k, clean (k mod 5 = 0), only the first 50 bars (1), every 5th
open negative (2), open / high / low missing on every 2nd bar (3), broken and repeated arrivals (4), and one ticker
whose price never moves.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerwise.functions.exprs import file_safe, title_case
from tickerwise.operators import feasibility as fz
from tickerwise.operators import serving as sv
from tickerwise.operators import validate
from tickerwise.operators.features import add_target
from tickerwise.plans import sql_blocks as S
from tickerwise.plans.q_clean import BARS, GRADE_SQL, RULE_SQL
from tickerwise.plans.q_feas import C1, C2, C5
from tickerwise.plans.q_serving import ACCEPT_SQL, FV, SNAP, snapshot
from tickerwise.plans.registry import register
from tickerwise.schema import FEATURE_VIEW_FIELDS, OHLCV
from tickerwise.sources import bars_daily, dirty_bars, entity_requests

K = "CAST(replace(ticker, 'Brand#', '') AS INT)"
MIXED = f"""{BARS}, {S.dirty()},
mixed AS (
  SELECT ticker, Date, Open, High, Low, Close, Volume, r * 2 AS seq FROM numbered WHERE {K} % 5 = 0 OR ({K} % 5 = 1 AND r <= 50)
  UNION ALL SELECT ticker, Date, CASE WHEN r % 5 = 0 THEN -Open ELSE Open END, High, Low, Close, Volume, r * 2 FROM numbered WHERE {K} % 5 = 2
  UNION ALL SELECT ticker, Date, CASE WHEN r % 2 = 1 THEN Open END, CASE WHEN r % 2 = 1 THEN High END, CASE WHEN r % 2 = 1 THEN Low END,
    Close, Volume, r * 2 FROM numbered WHERE {K} % 5 = 3
  UNION ALL SELECT ticker, Date, Open, High, Low, Close, Volume, seq FROM dirty WHERE {K} % 5 = 4
  UNION ALL SELECT 'Flat', Date, 100.0, 100.0, 100.0, 100.0, Volume, r * 2 FROM numbered WHERE ticker = 'Brand#10')"""


def mixed_bars(spark, sf):
    bars = bars_daily(spark, sf).withColumn("r", F.row_number().over(Window.partitionBy("ticker").orderBy("Date")).cast("bigint"))
    k, r = F.expr(K), F.col("r")
    cols = ["ticker", "Date", *OHLCV, "seq"]
    base = bars.withColumn("seq", r * 2)
    gone = F.when(r % 4 == 0, F.lit(float("nan")))  # half of the missing cells are NULL, half NaN; the SQL knows NULL only
    odd = lambda c: F.when(r % 2 == 1, F.col(c)).otherwise(gone)
    flat = base.where("ticker = 'Brand#10'").withColumns({"ticker": F.lit("Flat"), **{c: F.lit(100.0) for c in ("Open", "High", "Low", "Close")}})
    parts = [base.where((k % 5 == 0) | ((k % 5 == 1) & (r <= 50))),
             base.where(k % 5 == 2).withColumn("Open", F.when(r % 5 == 0, -F.col("Open")).otherwise(F.col("Open"))),
             base.where(k % 5 == 3).withColumns({c: odd(c) for c in ("Open", "High", "Low")}),
             dirty_bars(spark, sf).where(k % 5 == 4), flat]
    out = parts[0].select(cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(cols))
    return out


@register("mixed_validation", f"""{MIXED},
fl AS (SELECT *, {RULE_SQL} AS v, lag(Date) OVER (PARTITION BY ticker ORDER BY seq) > Date AS down FROM mixed),
st AS (SELECT ticker, count(*) AS rows_before, count(*) FILTER (WHERE v IS NOT NULL) AS rows_removed,
  count(*) - count(DISTINCT Date) AS n_duplicates, count(*) FILTER (WHERE down) AS n_down,
  CAST(coalesce(sum((Open IS NULL)::INT + (High IS NULL)::INT + (Low IS NULL)::INT + (Close IS NULL)::INT + (Volume IS NULL)::INT)
    FILTER (WHERE v IS NULL), 0) AS BIGINT) AS n_missing FROM fl GROUP BY ticker),
br AS (SELECT ticker, string_agg(v || '=' || n, ',' ORDER BY v) AS breakdown FROM
  (SELECT ticker, v, count(*) AS n FROM fl WHERE v IS NOT NULL GROUP BY ticker, v) GROUP BY ticker)
SELECT st.ticker, rows_before, rows_removed, n_duplicates, n_missing, coalesce(breakdown, '') AS breakdown, {GRADE_SQL} AS grade,
  n_duplicates = 0 AND n_down = 0 AS time_passed, rows_removed * 100.0 / rows_before <= 10.0 AS integrity_passed,
  n_duplicates = 0 AND n_down = 0 AND rows_removed * 100.0 / rows_before <= 10.0 AND n_missing = 0 AS passed
FROM st LEFT JOIN br ON st.ticker = br.ticker""", shared=True)
def q_mixed_validation(spark, sf):
    """V2, V5, V6, V8, V9: every verdict and grade occurs; the rule breakdown as sorted text."""
    _, stats = validate.validate_bars(mixed_bars(spark, sf))
    entries = F.transform(F.array_sort(F.map_entries("invalid_row_breakdown")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return stats.select("ticker", "rows_before", "rows_removed", "n_duplicates", "n_missing", F.array_join(entries, ",").alias("breakdown"),
                        validate.quality_grade(F.col("rows_removed"), F.col("rows_before")).alias("grade"), "time_passed", "integrity_passed", "passed")


MIXED_FB = f"""{MIXED}, fb AS (SELECT *, CAST(CASE WHEN coalesce(lead(Close) OVER (PARTITION BY ticker ORDER BY Date) > Close, false)
  THEN 1 ELSE 0 END AS INTEGER) AS target FROM mixed WHERE seq % 2 = 0)"""


@register("mixed_feasibility", f"""{MIXED_FB}, c1 AS ({C1}), c2 AS ({C2}), c5 AS ({C5}),
dist AS (SELECT ticker, string_agg(target || '=' || n, ',' ORDER BY target) AS label_distribution
  FROM (SELECT ticker, target, count(*) AS n FROM fb GROUP BY ticker, target) GROUP BY ticker)
SELECT c1.ticker, n_rows, c1.passed AS enough, round(completeness_pct, 6) AS completeness_pct, completeness_pct >= 90.0 AS complete,
  round(minority_ratio, 6) AS minority_ratio, minority_ratio >= 0.2 AND minority_ratio <= 0.8 AS balanced, label_distribution
FROM c1 JOIN c2 ON c1.ticker = c2.ticker JOIN (SELECT * EXCLUDE (n_rows) FROM c5) c5 ON c1.ticker = c5.ticker JOIN dist ON c1.ticker = dist.ticker""", shared=True)
def q_mixed_feasibility(spark, sf):
    """Both outcomes of each; the label distribution as sorted text."""
    fb = add_target(mixed_bars(spark, sf).where("seq % 2 = 0"))
    entries = F.transform(F.array_sort(F.map_entries("label_distribution")), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))
    return (fz.min_samples(fb).withColumnRenamed("passed", "enough")
            .join(fz.completeness(fb).select("ticker", "completeness_pct", F.col("passed").alias("complete")), "ticker")
            .join(fz.label_balance(fb).select("ticker", "minority_ratio", F.col("passed").alias("balanced"),
                                              F.array_join(entries, ",").alias("label_distribution")), "ticker"))


PRIMARY = f"""prim AS (SELECT ticker, Date, {', '.join(f"CASE WHEN {K} % 5 <> 3 THEN {c} END AS {c}" for c in OHLCV)} FROM bars WHERE {K} % 5 <> 4)"""


def _primary(spark, sf):
    """A primary source that lacks some tickers and serves others empty: prices NaN, volume NULL."""
    k, nan = F.expr(K), F.lit(float("nan"))
    bars = bars_daily(spark, sf).where(k % 5 != 4)
    return bars.withColumns({c: F.when(k % 5 != 3, F.col(c)).otherwise(nan if t == "double" else None) for c, t in bars.dtypes if c in OHLCV})


@register("mixed_sources", f"""{BARS}, {PRIMARY},
pa AS ({ACCEPT_SQL.format(src='primary', tbl='prim')})
SELECT coalesce(pa.ticker, b.ticker) AS ticker, coalesce(pa.accepted, false) AS primary_accepted,
  CASE WHEN pa.accepted THEN 'primary' ELSE 'snapshot' END AS data_source, b.n AS n_rows
FROM (SELECT ticker, count(*) AS n FROM bars GROUP BY ticker) b LEFT JOIN pa ON pa.ticker = b.ticker""", shared=True)
def q_mixed_sources(spark, sf):
    """Primary missing, empty or accepted per ticker; the rows come from the source named; no requested ticker is lost."""
    primary, bars = _primary(spark, sf), bars_daily(spark, sf)
    resolved = sv.require_tickers(sv.source_fallback(primary, bars), bars)
    ok = sv.source_acceptance(primary, "primary").select("ticker", F.col("accepted").alias("primary_accepted"))
    return (resolved.groupBy("ticker", "data_source").agg(F.count(F.lit(1)).alias("n_rows")).join(ok, "ticker", "left")
            .withColumn("primary_accepted", F.coalesce("primary_accepted", F.lit(False))))


REQ27 = ("req AS (SELECT o_orderkey AS request_id, 'Brand#' || CAST(o_orderkey % 27 + 1 AS VARCHAR) AS ticker, "
         "o_orderdate AS event_timestamp FROM orders)")


def _requests(spark, sf):
    """Requests for 27 tickers, two of which do not exist."""
    number = F.pmod(F.col("request_id"), F.lit(27)) + 1
    return entity_requests(spark, sf).withColumn("ticker", F.concat(F.lit("Brand#"), number.cast("string")))


@register("mixed_lookup", f"""{FV}, {SNAP}, {REQ27}
SELECT r.request_id, r.ticker, s.event_timestamp, {', '.join(f'round(s.{c}, 6) AS {c}' for c in FEATURE_VIEW_FIELDS)}, s.ticker IS NOT NULL AS found
FROM req r LEFT JOIN snap s ON r.ticker = s.ticker""", shared=True)
def q_mixed_lookup(spark, sf):
    """Hits and misses of the online read."""
    return sv.online_lookup(_requests(spark, sf).drop("event_timestamp"), snapshot(spark, sf))


@register("mixed_misses", f"{FV}, {SNAP}, {REQ27} SELECT r.* FROM req r WHERE NOT EXISTS (SELECT 1 FROM snap s WHERE s.ticker = r.ticker)", shared=True)
def q_mixed_misses(spark, sf):
    """The requests whose ticker has no online row."""
    return sv.online_misses(_requests(spark, sf), snapshot(spark, sf))


@register("rule_labels", f"""{MIXED}, b AS (SELECT ticker, {RULE_SQL} AS v FROM mixed)
SELECT replace(replace(ticker, '#', '.'), '.', '_') || '_snapshot.csv' AS file_name,
  array_to_string(list_transform(string_split(v, '_'), lambda w: upper(w[1]) || w[2:]), ' ') AS label, count(*) AS n_rows
FROM b WHERE v IS NOT NULL GROUP BY ticker, v""", shared=True)
def q_rule_labels(spark, sf):
    """String helpers: snapshot file name of a ticker, rule names as titles."""
    rows = validate.integrity_breakdown(mixed_bars(spark, sf))
    dotted = F.replace(F.col("ticker"), F.lit("#"), F.lit("."))
    return rows.select(F.concat(file_safe(dotted), F.lit("_snapshot.csv")).alias("file_name"), title_case(F.col("rule")).alias("label"), "n_rows")
