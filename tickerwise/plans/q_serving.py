"""Source resolution and point-in-time serving queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickerwise.operators import features as feat
from tickerwise.operators import serving as sv
from tickerwise.plans import sql_blocks as S
from tickerwise.plans.registry import register
from tickerwise.schema import FEATURE_VIEW_FIELDS, OHLCV
from tickerwise.sources import bars_daily, dirty_bars, entity_requests

LOOKBACK_END = "2000-01-01"
LOOKBACK_YEARS = 2

BARS = f"WITH bars AS ({S.BARS_DAILY})"
FV = (f"{BARS}, {S.features('bars')}, fe AS (SELECT * FROM feat_all WHERE {S.not_null(S.FEATURE_COLS)}), "
      "fv AS (SELECT ticker, CAST(Date AS TIMESTAMP) AS event_timestamp, "
      + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_VIEW_FIELDS) + " FROM fe)")
REQ = ("req AS (SELECT o_orderkey AS request_id, 'Brand#' || CAST(o_orderkey % 25 + 1 AS VARCHAR) AS ticker, "
       "o_orderdate AS event_timestamp FROM orders)")
SNAP = ("snap AS (SELECT ticker, event_timestamp, " + ", ".join(FEATURE_VIEW_FIELDS) + " FROM (SELECT *, row_number() OVER "
        "(PARTITION BY ticker ORDER BY event_timestamp DESC) AS _r FROM fv WHERE event_timestamp >= "
        "(SELECT max(event_timestamp) FROM fv) - INTERVAL 30 DAY AND event_timestamp <= (SELECT max(event_timestamp) FROM fv)) "
        "WHERE _r = 1)")
FIELDS = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_VIEW_FIELDS)


def _lookback_bounds():
    end = F.lit(LOOKBACK_END).cast("date")
    return F.date_sub(end, 365 * LOOKBACK_YEARS), end


LOOKBACK_WHERE = (f"WHERE l.l_shipdate >= CAST(DATE '{LOOKBACK_END}' - INTERVAL {365 * LOOKBACK_YEARS} DAY AS TIMESTAMP) "
                  f"AND l.l_shipdate < CAST(DATE '{LOOKBACK_END}' AS TIMESTAMP) GROUP BY 1, 2")


@register("lookback_scan", f"WITH bars AS ({S.BARS_DAILY.replace('GROUP BY 1, 2', LOOKBACK_WHERE)}) SELECT * FROM bars")
def q_lookback_scan(spark, sf):
    """Bars of the two years before 2000-01-01 (end exclusive), filter pushed to the scan."""
    start, end = _lookback_bounds()
    cond = (F.col("l_shipdate") >= start.cast("timestamp_ntz")) & (F.col("l_shipdate") < end.cast("timestamp_ntz"))
    return bars_daily(spark, sf, line_filter=cond)


ACCEPT_SQL = f"""SELECT ticker, '{{src}}' AS source, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE {' AND '.join(f'{c} IS NULL' for c in OHLCV)}) AS BIGINT) AS n_null_rows,
  count(*) > 0 AND count(*) FILTER (WHERE {' AND '.join(f'{c} IS NULL' for c in OHLCV)}) < count(*) AS accepted
FROM {{tbl}} GROUP BY ticker"""


@register("source_acceptance", f"""{BARS}, {S.dirty()}
{ACCEPT_SQL.format(src='primary', tbl='dirty')} UNION ALL {ACCEPT_SQL.format(src='snapshot', tbl='bars')}""")
def q_source_acceptance(spark, sf):
    """Per ticker and source: rows, all-null rows, accepted."""
    return (sv.source_acceptance(dirty_bars(spark, sf), "primary")
            .unionByName(sv.source_acceptance(bars_daily(spark, sf), "snapshot")))


SETTLED = S.BARS_DAILY.replace("GROUP BY 1, 2", "WHERE l.l_linestatus = 'F' GROUP BY 1, 2")


@register("source_fallback", f"""WITH prim AS ({SETTLED}), bars AS ({S.BARS_DAILY}),
pa AS ({ACCEPT_SQL.format(src='primary', tbl='prim')}),
sa AS ({ACCEPT_SQL.format(src='snapshot', tbl='bars')})
SELECT *, 'primary' AS data_source FROM prim WHERE ticker IN (SELECT ticker FROM pa WHERE accepted)
UNION ALL
SELECT *, 'snapshot' AS data_source FROM bars WHERE ticker IN (SELECT ticker FROM sa WHERE accepted)
  AND ticker NOT IN (SELECT ticker FROM pa WHERE accepted)""")
def q_source_fallback(spark, sf):
    """S3: settled-line bars as primary source, all-line bars as snapshot fallback per ticker."""
    primary = bars_daily(spark, sf, line_filter=F.col("l_linestatus") == "F")
    return sv.source_fallback(primary, bars_daily(spark, sf))


def view(spark, sf):
    return sv.feature_view_offline(feat.features_full(bars_daily(spark, sf)))


@register("feature_view_offline", f"{FV} SELECT ticker, event_timestamp, {FIELDS} FROM fv")
def q_feature_view_offline(spark, sf):
    """Offline feature view (ticker, event_timestamp, 12 DOUBLE fields)."""
    return view(spark, sf)


def snapshot(spark, sf):
    v = view(spark, sf)
    end = v.select(F.max("event_timestamp")).scalar()
    return sv.online_snapshot(v, end - F.make_dt_interval(F.lit(30)), end)


@register("online_snapshot", f"{FV}, {SNAP} SELECT ticker, event_timestamp, {FIELDS} FROM snap")
def q_online_snapshot(spark, sf):
    """Latest feature row per ticker in the last 30 days of the view."""
    return snapshot(spark, sf)


@register("online_lookup", f"""{FV}, {SNAP}, {REQ}
SELECT r.request_id, r.ticker, r.event_timestamp AS request_timestamp, s.event_timestamp,
  {', '.join(f'round(s.{c}, 6) AS {c}' for c in FEATURE_VIEW_FIELDS)}, s.ticker IS NOT NULL AS found
FROM req r LEFT JOIN snap s ON r.ticker = s.ticker""")
def q_online_lookup(spark, sf):
    """Every request gets its ticker's online row; found flags misses."""
    req = entity_requests(spark, sf).withColumnRenamed("event_timestamp", "request_timestamp")
    return sv.online_lookup(req, snapshot(spark, sf))


@register("online_misses", f"""{FV}, {SNAP}, {REQ}
SELECT r.* FROM req r WHERE NOT EXISTS (SELECT 1 FROM snap s WHERE s.ticker = r.ticker)""")
def q_online_misses(spark, sf):
    """Requests whose ticker has no online row."""
    return sv.online_misses(entity_requests(spark, sf), snapshot(spark, sf))


@register("asof_features", f"""{FV}, {REQ},
j AS (SELECT r.request_id, r.ticker, r.event_timestamp, f.event_timestamp AS fts,
  {', '.join(f'f.{c} AS {c}' for c in FEATURE_VIEW_FIELDS)}
  FROM req r ASOF LEFT JOIN fv f ON r.ticker = f.ticker AND r.event_timestamp >= f.event_timestamp)
SELECT request_id, ticker, event_timestamp,
  CASE WHEN fts > event_timestamp - INTERVAL 1 DAY THEN fts END AS feature_timestamp,
  {', '.join(f'CASE WHEN fts > event_timestamp - INTERVAL 1 DAY THEN round({c}, 6) END AS {c}' for c in FEATURE_VIEW_FIELDS)},
  coalesce(fts > event_timestamp - INTERVAL 1 DAY, false) AS found FROM j""")
def q_asof_features(spark, sf):
    """Point-in-time features for each order-derived request, TTL 1 day."""
    return sv.asof_features(entity_requests(spark, sf), view(spark, sf), ttl_days=1)


TTLS = [0.5, 1.0, 90.0]


def request_forms(spark, sf):
    """Requests as they come: every 5th without a timestamp, every 7th sent twice."""
    r = entity_requests(spark, sf)
    odd = r.withColumn("event_timestamp", F.when(F.col("request_id") % 5 != 0, F.col("event_timestamp")))
    return odd.unionByName(odd.where("request_id % 7 = 0"))


@register("asof_request_forms", f"""{FV}, {REQ},
nowt AS (SELECT max(event_timestamp) AS t FROM fv),
r1 AS (SELECT request_id, ticker, CASE WHEN request_id % 5 <> 0 THEN event_timestamp ELSE (SELECT t FROM nowt) END AS event_timestamp FROM req),
r2 AS (SELECT * FROM r1 UNION ALL SELECT * FROM r1 WHERE request_id % 7 = 0),
j AS (SELECT r.request_id, r.ticker, r.event_timestamp, f.event_timestamp AS fts, f.Close AS c
  FROM r2 r ASOF LEFT JOIN fv f ON r.ticker = f.ticker AND r.event_timestamp >= f.event_timestamp),
t AS (SELECT unnest({TTLS}) AS ttl_days),
h AS (SELECT *, coalesce(fts > event_timestamp - to_hours(CAST(ttl_days * 24 AS BIGINT)), false) AS found FROM j CROSS JOIN t)
SELECT CAST(ttl_days AS DOUBLE) AS ttl_days, request_id, ticker, event_timestamp, CASE WHEN found THEN fts END AS feature_timestamp,
  CASE WHEN found THEN round(c, 6) END AS Close, found FROM h""", shared=True)
def q_asof_request_forms(spark, sf):
    """Requests without a timestamp are asked as of the newest feature row, repeated ones answered as often, at three TTLs."""
    v = view(spark, sf)
    now = v.select(F.max("event_timestamp")).scalar()
    out = None
    for ttl in TTLS:
        part = sv.asof_features(request_forms(spark, sf), v, ttl_days=ttl, fields=["Close"], as_of=now).withColumn("ttl_days", F.lit(ttl))
        out = part if out is None else out.unionByName(part)
    return out


def _ticker_predictions_sql() -> str:
    from tickerwise.plans.q_clean import FEAT_SPLIT
    from tickerwise.plans.q_model import LOGIT, STATS_SQL
    fields = FEATURE_VIEW_FIELDS
    fv = ("fv AS (SELECT ticker, CAST(Date AS TIMESTAMP) AS event_timestamp, "
          + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in fields) + " FROM fe)")
    z = ", ".join(f"(h.{c} - st.{c}__mean) / CASE WHEN st.{c}__std IS NULL OR st.{c}__std = 0 THEN 1.0 "
                  f"ELSE st.{c}__std END AS {c}" for c in fields)
    return f"""{FEAT_SPLIT}, {STATS_SQL}, {fv}, {REQ},
j AS (SELECT r.request_id, r.ticker, r.event_timestamp, f.event_timestamp AS fts, {', '.join(f'f.{c}' for c in fields)}
  FROM req r ASOF LEFT JOIN fv f ON r.ticker = f.ticker AND r.event_timestamp >= f.event_timestamp),
hit AS (SELECT *, coalesce(fts > event_timestamp - INTERVAL 1 DAY, false) AS found FROM j),
zs AS (SELECT h.request_id, h.ticker, h.event_timestamp, h.found, st.ticker IS NOT NULL AS known, {z}
  FROM hit h LEFT JOIN st ON h.ticker = st.ticker),
pr AS (SELECT *, 1.0 / (1.0 + exp(-({LOGIT}))) AS p FROM zs)
SELECT request_id, ticker, event_timestamp,
  CASE WHEN found AND known THEN 'success' ELSE 'error' END AS status,
  CASE WHEN found AND known THEN CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INTEGER) END AS prediction,
  CASE WHEN found AND known THEN round(p, 6) END AS probability,
  CASE WHEN found AND known THEN 'linear-fixed' END AS model_version,
  CASE WHEN NOT known THEN 'No model for ticker ' || ticker
       WHEN NOT found THEN 'No features found for ticker ' || ticker END AS detail
FROM pr"""


@register("ticker_predictions", _ticker_predictions_sql())
def q_ticker_predictions(spark, sf):
    """J1 + M4: each order-derived ticker request gets its point-in-time features (TTL 1 day), then a score."""
    from tickerwise.operators import models as md
    from tickerwise.plans.q_clean import split_features
    from tickerwise.plans.q_model import FEATS
    sp = split_features(spark, sf)
    stats = md.fit_scaler(sp.filter(F.col("split") == "train"), FEATS)
    found = sv.asof_features(entity_requests(spark, sf), view(spark, sf), ttl_days=1)
    return md.score_lookups(found, stats, FEATS, ["request_id", "ticker", "event_timestamp"])


WINDOWS = [(dt.datetime(1997, 1, 1), dt.datetime(1997, 4, 30)), (dt.datetime(1997, 3, 1), dt.datetime(1997, 7, 31))]


@register("feature_view_materialized", f"""{FV}
SELECT ticker, event_timestamp, {', '.join(f'round({c}, 6) AS {c}' for c in FEATURE_VIEW_FIELDS)} FROM fv
WHERE event_timestamp >= TIMESTAMP '1997-01-01' AND event_timestamp < TIMESTAMP '1997-08-01'""", shared=True)
def q_feature_view_materialized(spark, sf):
    """Two overlapping windows materialised later one first, the first one again, then read back."""
    from tickerwise.sources import feature_store as fs
    from tickerwise.streaming.jobs import run_dir
    v, path = view(spark, sf), run_dir(spark, "feature-store")
    for start, end in (WINDOWS[1], WINDOWS[0], WINDOWS[1]):
        fs.materialize_window(v, path, start, end)
    return fs.stored_features(spark, path, v).select("ticker", "event_timestamp", *FEATURE_VIEW_FIELDS)
