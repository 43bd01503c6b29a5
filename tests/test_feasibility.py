"""Feasibility checks C1-C7 at, below and above their thresholds."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.operators import feasibility as fe
from tickerwise.schema import BAR_SCHEMA
from tests.conftest import bar_rows


def walk(n, seed=7):
    """Deterministic bounded walk (no numpy RNG needed)."""
    out, x, s = [], 100.0, seed
    for _ in range(n):
        s = (s * 1103515245 + 12345) % (2 ** 31)
        x = max(50.0, x + ((s / 2 ** 31) - 0.5) * 0.8)
        out.append(round(x, 4))
    return out


@pytest.mark.parametrize("n,passed", [(99, False), (100, True), (150, True), (50, False)])
def test_min_samples(make_bars, n, passed):
    assert fe.min_samples(make_bars(walk(n))).first()["passed"] is passed


def test_completeness_threshold(spark):
    rows = bar_rows(walk(100))
    # 12 % of OHLCV cells missing -> fail; ~4 % -> pass
    heavy = [(t, d, None, None, lo, c, v) if i < 30 else (t, d, o, h, lo, c, v)
             for i, (t, d, o, h, lo, c, v) in enumerate(rows)]
    light = [(t, d, None, h, lo, c, v) if i < 20 else (t, d, o, h, lo, c, v)
             for i, (t, d, o, h, lo, c, v) in enumerate(rows)]
    h = fe.completeness(spark.createDataFrame(heavy, BAR_SCHEMA)).first()
    lt = fe.completeness(spark.createDataFrame(light, BAR_SCHEMA)).first()
    assert h["completeness_pct"] == pytest.approx(88.0) and not h["passed"]
    assert lt["completeness_pct"] == pytest.approx(96.0) and lt["passed"]


def test_continuity_calendar_days(spark):
    rows = bar_rows(walk(100))
    ok = fe.continuity(spark.createDataFrame(rows, BAR_SCHEMA)).first()
    assert ok["max_gap_days"] == 3 and ok["passed"]  # weekends count as 3-day gaps (Q13)
    shifted = [(t, d + dt.timedelta(days=15) if i >= 50 else d, o, h, lo, c, v)
               for i, (t, d, o, h, lo, c, v) in enumerate(rows)]
    bad = fe.continuity(spark.createDataFrame(shifted, BAR_SCHEMA)).first()
    assert bad["max_gap_days"] > 10 and bad["n_large_gaps"] == 1 and not bad["passed"]
    gl = fe.gap_list(spark.createDataFrame(shifted, BAR_SCHEMA)).collect()
    assert len(gl) == 1 and gl[0]["gap_days"] == bad["max_gap_days"]


def test_outliers_spikes_fail(spark):
    closes = walk(100)
    for i in (30, 60, 90):
        closes[i] *= 10
    r = fe.outliers(spark.createDataFrame(bar_rows(closes), BAR_SCHEMA)).first()
    assert r["n_outliers"] >= 3 and r["outlier_pct"] > 1.0 and not r["passed"]
    clean = fe.outliers(spark.createDataFrame(bar_rows(walk(100)), BAR_SCHEMA)).first()
    assert clean["passed"]


def test_outliers_skipped_on_constant_series(make_bars):
    r = fe.outliers(make_bars([10.0] * 30)).first()
    assert r["skipped"] and r["passed"] and r["outlier_pct"] == 0.0


def labelled(spark, ones, n):
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("target", T.IntegerType())])
    return spark.createDataFrame([("T", 1 if i < ones else 0) for i in range(n)], schema)


@pytest.mark.parametrize("ones,n,passed", [(5, 100, False), (30, 100, True), (20, 100, True),
                                           (80, 100, True), (100, 100, False)])
def test_label_balance(spark, ones, n, passed):
    r = fe.label_balance(labelled(spark, ones, n)).first()
    assert r["passed"] is passed


def test_single_class_ratio_is_one(spark):
    # Q12: minority = whole table -> 1.0 -> fails as too balanced
    r = fe.label_balance(labelled(spark, 0, 50)).first()
    assert r["minority_ratio"] == 1.0 and not r["passed"]


def test_lookahead_columns(make_bars):
    df = make_bars(walk(10)).withColumn("future_price", F.col("Close")).withColumn("target", F.lit(1)) \
        .withColumn("next_label_txt", F.lit("x")).withColumn("Tomorrow_ret", F.lit(0.1))
    names = dict(fe.lookahead_columns(df.schema))
    assert names == {"future_price": "future", "Tomorrow_ret": "tomorrow"}


def test_report_and_strict(spark):
    from tickerwise.operators.features import features_full
    df = features_full(spark.createDataFrame(bar_rows(walk(150)), BAR_SCHEMA))
    rep = fe.feasibility_report(df)
    checks = {r["check"]: r["passed"] for r in rep.collect()}
    assert set(checks) == set(fe.CHECK_ORDER)
    v = fe.feasibility_verdict(rep).first()
    assert v["n_checks"] == 6 and v["production_ready"] == all(checks.values())
    leaky = df.withColumn("future_price", F.lead("Close").over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("ticker").orderBy("Date")))
    with pytest.raises(fe.DataFeasibilityError):
        fe.feasibility_strict(leaky.filter(F.col("future_price").isNotNull()))


def test_missing_days_and_calendar(spark):
    rows = bar_rows(walk(10))
    df = spark.createDataFrame(rows[:3] + rows[4:], BAR_SCHEMA)
    miss = fe.missing_days(df).collect()
    assert [r["Date"] for r in miss] == [rows[3][1]]
    cal = fe.trading_calendar(df)
    assert cal.count() == 10 and cal.filter(~F.col("has_bar")).count() == 1
