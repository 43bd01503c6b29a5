"""Monitoring tables and alert rows.

Counters and histograms are plain aggregations over a request log.  The
histogram is cumulative like Prometheus ``le`` buckets: one pass computes
every bucket with conditional counts (no per-bucket explode of the log),
then the few bucket columns are stacked into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerwise.schema import KEY, LATENCY_BUCKETS

FIELD = "struct<name:string,value:string,inline:boolean>"


# ---- fixed values: alert texts and formats (drift, performance, training complete), as the alerts read ----
DRIFT_TITLE = "DRIFT DETECTED - "
NO_DRIFT_TITLE = "No Drift Detected - "
DRIFT_HEADER = "**Drift Detection Results**\n\n"
DATA_DRIFT_YES = "- Data Drift: YES (%.1f%% of features, %d columns)\n"
DATA_DRIFT_NO = "- Data Drift: NO\n"
TARGET_DRIFT_YES = "- Target Drift: YES (score: %.3f)\n"
TARGET_DRIFT_NO = "- Target Drift: NO\n"
DRIFT_ACTION = "Review drift report and consider model retraining"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
PERFORMANCE_TITLE = "PERFORMANCE DEGRADATION - "
PERFORMANCE_MESSAGE = "**Model performance has degraded by %.1f%%**\n\nCurrent vs Baseline:\n"
PERFORMANCE_FIELD = "%.3f (was %.3f)"
PERFORMANCE_ACTION = "Model should be retrained with recent data"
REPORT_FIELD = "Check `%s` for details"
TRAINING_TITLE = "Training Complete - "
TRAINING_MESSAGE = "**Model training finished successfully**\n\nDuration: "
# ---- end of fixed values ----


def request_counts(log: DataFrame) -> DataFrame:
    """Requests by endpoint and status."""
    return log.groupBy("endpoint", "status").agg(F.count(F.lit(1)).alias("requests"))


def prediction_counts(log: DataFrame) -> DataFrame:
    """Predictions by class."""
    return log.groupBy("prediction_class").agg(F.count(F.lit(1)).alias("predictions"))


def latency_histogram(log: DataFrame, buckets=LATENCY_BUCKETS, by: str = "endpoint",
                      value: str = "latency") -> DataFrame:
    """Cumulative bucket counts per endpoint, plus +Inf, sum and count."""
    aggs = [F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(buckets)]
    aggs += [F.count(F.lit(1)).alias("b_inf"), F.sum(value).alias("latency_sum")]
    wide = log.groupBy(by).agg(*aggs)
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(buckets)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("b_inf").alias("count")))
    return wide.select(by, "latency_sum", F.col("b_inf").alias("latency_count"), F.inline(F.array(*rows)))


def _field(name: str, value: Column, inline: bool) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"), F.lit(inline).alias("inline"))


def drift_alerts(summary: DataFrame, as_of: Column, key: str = KEY, report: Column | None = None) -> DataFrame:
    """One alert row per ticker: colour, title, message and fields.

    ``as_of`` stands in for the wall-clock timestamp so results are
    reproducible.  ``report`` names the report file; where it is not NULL the alert has a report field.
    """
    data, tgt = F.col("dataset_drift_detected"), F.col("target_drift_detected")
    any_drift = data | tgt
    msg = F.concat(
        F.lit(DRIFT_HEADER),
        F.when(data, F.format_string(DATA_DRIFT_YES,
                                     F.col("drift_share") * 100, F.col("num_drifted_columns")))
        .otherwise(F.lit(DATA_DRIFT_NO)),
        F.when(tgt, F.format_string(TARGET_DRIFT_YES, F.col("target_drift_score")))
        .otherwise(F.lit(TARGET_DRIFT_NO)))
    fields = F.array(_field("Ticker", F.col(key), True),
                     _field("Timestamp", F.date_format(as_of, TIMESTAMP_FORMAT), True))
    action = F.array(_field("Action Required", F.lit(DRIFT_ACTION), False))
    return summary.select(
        key,
        F.when(any_drift, F.lit("warning")).otherwise(F.lit("success")).alias("color"),
        F.when(any_drift, F.concat(F.lit(DRIFT_TITLE), F.col(key)))
        .otherwise(F.concat(F.lit(NO_DRIFT_TITLE), F.col(key))).alias("title"),
        msg.alias("message"),
        F.concat(F.when(any_drift, F.concat(fields, action)).otherwise(fields), _report_field(report)).alias("fields"))


def _report_field(report: Column | None) -> Column:
    name = F.lit(None).cast("string") if report is None else report
    return F.filter(F.array(_field("Report", F.format_string(REPORT_FIELD, name), False)), lambda f: name.isNotNull())


def alerts_to_send(alerts: DataFrame, gate: DataFrame, key: str = KEY) -> DataFrame:
    """An alert leaves only when the significance gate (D7) fires for its ticker."""
    return alerts.join(gate.filter("significant").select(key), key, "left_semi")


def performance_alerts(compare: DataFrame, key: str = KEY) -> DataFrame:
    """One alert per ticker whose accuracy degraded against the baseline.

    ``compare`` is the long (ticker, metric, current, baseline) table of
    :func:`tickerwise.operators.metrics.metric_compare`.
    """
    wide = (compare.groupBy(key).pivot("metric", ["accuracy", "precision", "recall", "f1"])
            .agg(F.first(F.struct("current", "baseline"))))
    acc_deg = F.when(F.col("accuracy.baseline") != 0, (F.col("accuracy.baseline") - F.col("accuracy.current"))
                     * 100.0 / F.col("accuracy.baseline"))
    fields = F.array(*[_field(m.capitalize(), F.format_string(PERFORMANCE_FIELD, F.col(f"{m}.current"),
                                                              F.col(f"{m}.baseline")), True)
                       for m in ["accuracy", "precision", "recall", "f1"]],
                     _field("Action Required", F.lit(PERFORMANCE_ACTION), False))
    return (wide.withColumn("degradation_pct", acc_deg).filter(F.col("degradation_pct") > 0)
            .select(key, F.lit("error").alias("color"),
                    F.concat(F.lit(PERFORMANCE_TITLE), F.col(key)).alias("title"),
                    F.format_string(PERFORMANCE_MESSAGE,
                                    F.col("degradation_pct")).alias("message"),
                    "degradation_pct", fields.alias("fields")))


def training_complete_alerts(metrics: DataFrame, training_time: Column, key: str = KEY) -> DataFrame:
    """One 'Training Complete' row per ticker from its metrics row."""
    fields = F.array(_field("Accuracy", F.format_string("%.3f", F.col("accuracy")), True),
                     _field("F1-Score", F.format_string("%.3f", F.col("f1")), True),
                     _field("Ticker", F.col(key), True))
    return metrics.select(key, F.lit("success").alias("color"),
                          F.concat(F.lit(TRAINING_TITLE), F.col(key)).alias("title"),
                          F.concat(F.lit(TRAINING_MESSAGE),
                                   F.format_string("%.1f", training_time), F.lit("s")).alias("message"),
                          fields.alias("fields"))
