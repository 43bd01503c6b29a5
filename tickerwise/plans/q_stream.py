"""Structured Streaming twins (ST1-ST6), each checked against a batch SQL statement.

Every stream runs with ``trigger(availableNow=True)`` over a file source and
is read back from its sink.  Windowed streams publish updates, so their result holds every window of the input.
"""

from __future__ import annotations

from tickerwise.plans import sql_blocks as S
from tickerwise.plans.q_clean import DEDUP_SQL, DIRTY
from tickerwise.plans.q_model import BASE, FEATS, scaled
from tickerwise.plans.q_serving import FIELDS, FV, view
from tickerwise.plans.registry import ORACLE_SQL, register
from tickerwise.schema import FEATURE_VIEW_FIELDS, LATENCY_BUCKETS
from tickerwise.sources import bars_daily, dirty_bars, entity_requests
from tickerwise.streaming import dedup, jobs, lookup


@register("stream_bars", f"WITH bars AS ({S.BARS_HOURLY}) SELECT * FROM bars")
def q_stream_bars(spark, sf):
    """ST1: hourly OHLCV bars from the events stream, 1-hour watermark, all hours."""
    return jobs.run_stream_bars(spark, sf)


@register("stream_request_counts", """WITH log AS (SELECT ts, event_type AS endpoint, value / 100.0 AS latency,
  CASE WHEN coalesce(value > 0, false) THEN 'success' ELSE 'error' END AS status FROM events)
SELECT date_trunc('hour', ts) AS hour, endpoint, status, CAST(count(*) AS BIGINT) AS requests,
  round(sum(latency), 6) AS latency_sum
FROM log GROUP BY 1, 2, 3""")
def q_stream_request_counts(spark, sf):
    """ST3: request counter per hour, endpoint and status."""
    return jobs.run_stream_request_counts(spark, sf)


@register("stream_latency_histogram", f"""WITH le AS (SELECT unnest([{', '.join(map(str, LATENCY_BUCKETS))}, 1e300]) AS le),
log AS (SELECT date_trunc('hour', ts) AS hour, event_type AS endpoint, value / 100.0 AS latency FROM events),
s AS (SELECT hour, endpoint, round(sum(latency), 6) AS latency_sum, count(*) AS latency_count FROM log GROUP BY hour, endpoint)
SELECT s.hour, s.endpoint, s.latency_sum, s.latency_count, CASE WHEN le = 1e300 THEN '+Inf' ELSE CAST(le AS VARCHAR) END AS le,
  CASE WHEN le = 1e300 THEN s.latency_count ELSE count(l.latency) FILTER (WHERE l.latency <= le) END AS count
FROM s JOIN log l ON l.hour = s.hour AND l.endpoint = s.endpoint CROSS JOIN le GROUP BY s.hour, s.endpoint, s.latency_sum, s.latency_count, le""")
def q_stream_latency_histogram(spark, sf):
    """ST3: cumulative latency buckets per hour and endpoint."""
    return jobs.run_stream_latency_histogram(spark, sf)


@register("stream_scores", f"{BASE} SELECT ticker, Date, round(probability, 6) AS probability, "
          "CAST(prediction AS INTEGER) AS prediction, round(confidence, 6) AS confidence FROM scored")
def q_stream_scores(spark, sf):
    """ST2: stateless scoring of standardized feature rows arriving as files."""
    return jobs.run_stream_scores(spark, scaled(spark, sf), FEATS)


@register("stream_online_snapshot", f"""{FV},
latest AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY event_timestamp DESC) AS _r FROM fv)
SELECT ticker, event_timestamp, {FIELDS} FROM latest WHERE _r = 1""")
def q_stream_online_snapshot(spark, sf):
    """ST4: continuously materialized latest feature row per ticker (foreachBatch upsert)."""
    return jobs.run_stream_online_snapshot(spark, view(spark, sf)).select(
        "ticker", "event_timestamp", *FEATURE_VIEW_FIELDS)


@register("stream_dedup", f"""WITH bars AS ({S.BARS_DAILY}), {S.dirty()}
SELECT ticker, Date, Open, High, Low, Close, Volume, seq FROM dirty WHERE seq % 2 = 0""")
def q_stream_dedup(spark, sf):
    """ST5: re-sent (ticker, Date) rows are dropped; the first one sent (lowest seq) is kept."""
    return dedup.run_stream_dedup(spark, dirty_bars(spark, sf), "first").select(
        "ticker", "Date", "Open", "High", "Low", "Close", "Volume", "seq")


@register("stream_features", f"""WITH bars AS ({S.BARS_DAILY}), {S.features('bars')}
SELECT ticker, Date, Close, {S.r6(['returns', 'ma_5', 'ma_10', 'ma_20', 'volatility_5', 'volatility_10',
                                    'volatility_20'])} FROM feat_all""")
def q_stream_features(spark, sf):
    """ST6: incremental returns and rolling features per ticker from a bar stream (stateful)."""
    return jobs.run_stream_features(spark, bars_daily(spark, sf))


@register("stream_dedup_last", f"""{DIRTY}, {DEDUP_SQL}
SELECT ticker, Date, Open, High, Low, Close, Volume, seq FROM dedup""")
def q_stream_dedup_last(spark, sf):
    """ST5 keep-last: the highest seq per (ticker, Date) replaces what was published before."""
    return dedup.run_stream_dedup(spark, dirty_bars(spark, sf), "last").select(
        "ticker", "Date", "Open", "High", "Low", "Close", "Volume", "seq")


@register("stream_lookup", ORACLE_SQL["asof_features"], shared=True)
def q_stream_lookup(spark, sf):
    """J1, ST2: a stream of requests joined with the stream of feature rows, TTL 1 day, misses included."""
    return lookup.run_stream_lookup(spark, entity_requests(spark, sf), view(spark, sf), ttl_days=1)
