"""Counters, cumulative histograms and alert rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerwise.operators import metrics as mt
from tickerwise.operators import monitoring as mon


@pytest.fixture
def log(spark):
    lat = [0.005, 0.02, 0.02, 0.3, 7.0, None]
    rows = [(i, "predict", v, "success" if v else "error", "UP" if i % 2 else "DOWN") for i, v in enumerate(lat)]
    return spark.createDataFrame(rows, "event_id long, endpoint string, latency double, status string, "
                                       "prediction_class string")


def test_counters(log):
    got = {(r["endpoint"], r["status"]): r["requests"] for r in mon.request_counts(log).collect()}
    assert got == {("predict", "success"): 5, ("predict", "error"): 1}
    pc = {r["prediction_class"]: r["predictions"] for r in mon.prediction_counts(log).collect()}
    assert pc == {"UP": 3, "DOWN": 3}


def test_histogram_is_cumulative(log):
    h = {r["le"]: r["count"] for r in mon.latency_histogram(log).collect()}
    assert h["0.01"] == 1 and h["0.025"] == 3 and h["0.25"] == 3 and h["0.5"] == 4 and h["5.0"] == 4
    assert h["+Inf"] == 6  # +Inf counts every request, like the count series
    counts = [h[k] for k in ["0.01", "0.025", "0.05", "0.075", "0.1", "0.25", "0.5", "0.75", "1.0", "2.5", "5.0"]]
    assert counts == sorted(counts)


def test_performance_alert_rows(spark):
    cur = spark.createDataFrame([("T", "accuracy", 0.45), ("T", "f1", 0.4)], "ticker string, metric string, value double")
    base = spark.createDataFrame([("T", "accuracy", 0.60), ("T", "f1", 0.5), ("T", "recall", 0.3)],
                                 "ticker string, metric string, value double")
    cmp = {r["metric"]: r for r in mt.metric_compare(cur, base).collect()}
    assert cmp["accuracy"]["retrain"]            # 0.45 < 0.9 * 0.60
    assert cmp["recall"]["current"] == 0.0       # missing metric defaults to 0
    assert cmp["accuracy"]["degradation_pct"] == pytest.approx(25.0)


def test_training_complete_alert(spark):
    m = spark.createDataFrame([("BBCA.JK", 0.5234, 0.61)], "ticker string, accuracy double, f1 double")
    r = mon.training_complete_alerts(m, F.lit(12.34)).first()
    assert r["title"] == "Training Complete - BBCA.JK" and r["color"] == "success"
    assert r["message"] == "**Model training finished successfully**\n\nDuration: 12.3s"
    assert [(f["name"], f["value"]) for f in r["fields"]] == [("Accuracy", "0.523"), ("F1-Score", "0.610"),
                                                              ("Ticker", "BBCA.JK")]


def test_drift_alert_rows(spark):
    from tickerwise.operators import drift as dr
    rows = [("T", "ref", float(i), 1) for i in range(20)] + [("T", "cur", float(i + 100), 0) for i in range(10)]
    df = spark.createDataFrame(rows, "ticker string, sample string, x double, target int")
    a = mon.drift_alerts(dr.drift_summary(df, ["x"]), F.lit(dt.datetime(2021, 1, 1))).first()
    assert a["color"] == "warning" and a["title"] == "DRIFT DETECTED - T"
    assert "Data Drift: YES" in a["message"] and "Target Drift: YES" in a["message"]
