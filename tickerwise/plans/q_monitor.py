"""Monitoring and alert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerwise.operators import drift as dr
from tickerwise.operators import metrics as mt
from tickerwise.operators import monitoring as mon
from tickerwise.plans.q_drift import SUMMARY_SQL, drift_input, FEATS as DFEATS
from tickerwise.plans.q_model import BASE, CM_COLS, METRIC_COLS, predictions
from tickerwise.plans.registry import register
from tickerwise.schema import LATENCY_BUCKETS, STORE_LATENCY_BUCKETS
from tickerwise.sources import request_log

LOG = """log AS (SELECT event_id, ts, event_type AS endpoint, value / 100.0 AS latency,
  CASE WHEN coalesce(value > 0, false) THEN 'success' ELSE 'error' END AS status,
  CASE WHEN user_id % 2 = 0 THEN 'UP' ELSE 'DOWN' END AS prediction_class FROM events)"""


@register("request_counts", f"WITH {LOG} SELECT endpoint, status, CAST(count(*) AS BIGINT) AS requests "
          "FROM log GROUP BY endpoint, status")
def q_request_counts(spark, sf):
    """Request counter by endpoint and status."""
    return mon.request_counts(request_log(spark, sf))


@register("prediction_counts", f"WITH {LOG} SELECT prediction_class, CAST(count(*) AS BIGINT) AS predictions "
          "FROM log GROUP BY prediction_class")
def q_prediction_counts(spark, sf):
    """Prediction counter by class."""
    return mon.prediction_counts(request_log(spark, sf))


HIST_ROWS = " UNION ALL ".join(
    [f"SELECT endpoint, latency_sum, latency_count, '{b}' AS le, b{i} AS count FROM w" for i, b in enumerate(LATENCY_BUCKETS)]
    + ["SELECT endpoint, latency_sum, latency_count, '+Inf' AS le, latency_count AS count FROM w"])


@register("latency_histogram", f"""WITH {LOG},
w AS (SELECT endpoint, {', '.join(f'CAST(count(*) FILTER (WHERE latency <= {b}) AS BIGINT) AS b{i}' for i, b in enumerate(LATENCY_BUCKETS))},
  round(sum(latency), 6) AS latency_sum, CAST(count(*) AS BIGINT) AS latency_count FROM log GROUP BY endpoint)
{HIST_ROWS}""")
def q_latency_histogram(spark, sf):
    """Cumulative latency buckets per endpoint (Prometheus le semantics)."""
    return mon.latency_histogram(request_log(spark, sf))


@register("store_latency_histogram", f"""WITH lg AS (SELECT event_type AS endpoint, value / 1000.0 AS latency FROM events),
le AS (SELECT unnest([{', '.join(map(str, STORE_LATENCY_BUCKETS))}, 1e300]) AS le)
SELECT endpoint, round(any_value(s), 6) AS latency_sum, any_value(n) AS latency_count,
  CASE WHEN le = 1e300 THEN '+Inf' ELSE CAST(le AS VARCHAR) END AS le,
  CASE WHEN le = 1e300 THEN any_value(n) ELSE count(latency) FILTER (WHERE latency <= le) END AS count
FROM lg JOIN (SELECT endpoint, sum(latency) AS s, count(*) AS n FROM lg GROUP BY endpoint) USING (endpoint) CROSS JOIN le GROUP BY endpoint, le""")
def q_store_latency_histogram(spark, sf):
    """The feature store's own, finer buckets (latency = value / 1000 s)."""
    log = request_log(spark, sf).withColumn("latency", F.col("latency") / 10.0)
    return mon.latency_histogram(log, buckets=STORE_LATENCY_BUCKETS)


def _json_field(name, value, inline):
    return f"{{'name': '{name}', 'value': {value}, 'inline': {str(inline).lower()}}}"


ALERT_SQL = f"""{SUMMARY_SQL},
asof_t AS (SELECT strftime(CAST(max(Date) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS t FROM ds)
SELECT ticker,
  CASE WHEN dataset_drift_detected OR target_drift_detected THEN 'warning' ELSE 'success' END AS color,
  CASE WHEN dataset_drift_detected OR target_drift_detected THEN 'DRIFT DETECTED - ' || ticker
       ELSE 'No Drift Detected - ' || ticker END AS title,
  '**Drift Detection Results**' || chr(10) || chr(10) ||
  CASE WHEN dataset_drift_detected THEN printf('- Data Drift: YES (%.1f%% of features, %d columns)', drift_share * 100, num_drifted_columns) || chr(10)
       ELSE '- Data Drift: NO' || chr(10) END ||
  CASE WHEN target_drift_detected THEN printf('- Target Drift: YES (score: %.3f)', target_drift_score) || chr(10)
       ELSE '- Target Drift: NO' || chr(10) END AS message,
  to_json(CASE WHEN dataset_drift_detected OR target_drift_detected THEN
    [{_json_field('Ticker', 'ticker', True)}, {_json_field('Timestamp', '(SELECT t FROM asof_t)', True)},
     {_json_field('Action Required', "'Review drift report and consider model retraining'", False)}]
  ELSE [{_json_field('Ticker', 'ticker', True)}, {_json_field('Timestamp', '(SELECT t FROM asof_t)', True)}] END)::VARCHAR AS fields
FROM sm"""


@register("drift_alerts", ALERT_SQL)
def q_drift_alerts(spark, sf):
    """Drift alert row per ticker (warning / success), timestamp = last bar date."""
    ds = drift_input(spark, sf)
    as_of = ds.select(F.max("Date")).scalar()
    alerts = mon.drift_alerts(dr.drift_summary(ds, DFEATS), as_of)
    return alerts.withColumn("fields", F.to_json("fields"))


REPORT_JSON = _json_field("Report", "'Check `' || ticker || '_drift_report.html` for details'", False)


@register("drift_alerts_sent", ALERT_SQL.replace("::VARCHAR AS fields\nFROM sm", "::VARCHAR AS fields\nFROM sm WHERE drift_share > 0.5 OR target_drift_detected")
          .replace("retraining', 'inline': false}]", f"retraining', 'inline': false}}, {REPORT_JSON}]"))
def q_drift_alerts_sent(spark, sf):
    """N1 + D7: the alerts that leave, with the report named."""
    ds = drift_input(spark, sf)
    data, target = dr.dataset_drift(dr.ks_drift(ds, DFEATS)), dr.target_drift(ds)
    as_of = ds.select(F.max("Date")).scalar()
    name = F.concat(F.col("ticker"), F.lit("_drift_report.html"))
    alerts = mon.drift_alerts(dr.drift_summary(ds, DFEATS), as_of, report=name)
    return mon.alerts_to_send(alerts, dr.drift_gate(data, target)).withColumn("fields", F.to_json("fields"))


@register("performance_alerts", f"""{BASE},
cm AS (SELECT ticker, split, {CM_COLS} FROM pred GROUP BY ticker, split),
m AS (SELECT ticker, split, {METRIC_COLS} FROM cm),
wd AS (SELECT ticker,
  max(accuracy) FILTER (WHERE split = 'test') AS ac, max(accuracy) FILTER (WHERE split = 'train') AS ab,
  max(precision) FILTER (WHERE split = 'test') AS pc, max(precision) FILTER (WHERE split = 'train') AS pb,
  max(recall) FILTER (WHERE split = 'test') AS rc, max(recall) FILTER (WHERE split = 'train') AS rb,
  max(f1) FILTER (WHERE split = 'test') AS fc, max(f1) FILTER (WHERE split = 'train') AS fb FROM m GROUP BY ticker),
dg AS (SELECT *, CASE WHEN ab <> 0 THEN (ab - ac) * 100.0 / ab END AS degradation_pct FROM wd)
SELECT ticker, 'error' AS color, 'PERFORMANCE DEGRADATION - ' || ticker AS title,
  printf('**Model performance has degraded by %.1f%%**', degradation_pct) || chr(10) || chr(10) || 'Current vs Baseline:' || chr(10) AS message,
  round(degradation_pct, 6) AS degradation_pct,
  to_json([{_json_field('Accuracy', "printf('%.3f (was %.3f)', ac, ab)", True)},
           {_json_field('Precision', "printf('%.3f (was %.3f)', pc, pb)", True)},
           {_json_field('Recall', "printf('%.3f (was %.3f)', rc, rb)", True)},
           {_json_field('F1', "printf('%.3f (was %.3f)', fc, fb)", True)},
           {_json_field('Action Required', "'Model should be retrained with recent data'", False)}])::VARCHAR AS fields
FROM dg WHERE degradation_pct > 0""")
def q_performance_alerts(spark, sf):
    """Degradation alert per ticker whose test accuracy fell below train accuracy."""
    m = mt.round_metrics(mt.classification_metrics(predictions(spark, sf), ("ticker", "split")))
    lm = mt.metrics_long(m, ("ticker", "split"))
    cmp = mt.metric_compare(lm.filter(F.col("split") == "test").drop("split"),
                            lm.filter(F.col("split") == "train").drop("split"))
    return mon.performance_alerts(cmp).withColumn("fields", F.to_json("fields"))
