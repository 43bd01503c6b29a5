"""Materialising windows of features; exact quantiles of any group; the chi-square tail."""

from __future__ import annotations

import datetime as dt
import math
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerwise.functions.exprs import chi2_tail
from tickerwise.operators import aggregates as agg
from tickerwise.sources import feature_store as fs

VIEW = "ticker string, event_timestamp timestamp_ntz, f double"
D = lambda d, h=0: dt.datetime(2021, 1, d, h)


def view(spark, changed=()):
    rows = [(t, D(d, h), float(d * 100 + h)) for t in ("A", "B") for d in range(1, 11) for h in (0, 9, 23) if (d, t) != (5, "B")]
    return spark.createDataFrame([(t, at, dict(changed).get(at.day, f)) for t, at, f in rows] + [("A", None, 1.0)], VIEW)


def stored(spark, path, v):
    return sorted(map(tuple, fs.stored_features(spark, path, v).collect()))


def files(path):
    return {os.path.join(a, f): os.stat(os.path.join(a, f)).st_mtime_ns for a, _, fl in os.walk(f"{path}/rows") for f in fl if f.endswith(".parquet")}


def test_windows_in_any_order_give_the_same_table(spark, tmp_path):
    v = view(spark)
    want = sorted(tuple(r) for r in v.collect() if r.event_timestamp is not None and 2 <= r.event_timestamp.day <= 8)
    windows = [(D(2), D(6, 12)), (D(4, 5), D(8))]
    for i, order in enumerate([windows, windows[::-1], [windows[0], windows[0], windows[1], windows[0]]]):
        path = str(tmp_path / str(i))
        assert fs.high_water_mark(spark, path) is None and stored(spark, path, v) == []
        for a, b in order:
            fs.materialize_window(v, path, a, b)
        assert stored(spark, path, v) == want and fs.high_water_mark(spark, path) == D(9)
    with pytest.raises(ValueError):
        fs.materialize_window(v, path, D(6), D(5))


def test_only_the_days_of_the_window_are_written(spark, tmp_path):
    path, v = str(tmp_path / "s"), view(spark)
    fs.materialize_window(v, path, D(1), D(10))
    before = files(path)
    later = view(spark, {3: -1.0}.items()).where("not (ticker = 'A' and day(event_timestamp) = 5)")
    fs.materialize_window(later, path, D(3), D(5))
    after = files(path)
    kept = {f for f in before if not any(f"2021-01-0{d}" in f for d in (3, 4, 5))}
    assert kept <= set(after) and all(before[f] == after[f] for f in kept)
    rows = stored(spark, path, v)
    assert {r[2] for r in rows if r[1].day == 3} == {-1.0} and not [r for r in rows if r[1].day == 5]  # a day that lost its rows is empty


def test_incremental_runs_go_on_from_the_mark(spark, tmp_path):
    path, v = str(tmp_path / "i"), view(spark)
    part = v.where(F.col("event_timestamp") < F.lit(D(4, 10)))  # the fourth day is still incomplete
    fs.materialize_incremental(part, path, D(4), start=D(1))
    assert fs.high_water_mark(spark, path) == D(5)
    fs.materialize_incremental(v, path, D(7), start=D(1))
    fs.materialize_incremental(v, path, D(3), start=D(1))
    want = sorted(tuple(r) for r in v.collect() if r.event_timestamp is not None and r.event_timestamp.day <= 7)
    assert stored(spark, path, v) == want and fs.high_water_mark(spark, path) == D(8)
    latest = sorted(map(tuple, fs.latest_rows(fs.stored_features(spark, path, v)).collect()))
    assert latest == [("A", D(7, 23), 723.0), ("B", D(7, 23), 723.0)]


@pytest.mark.parametrize("ranges", [256, 4])
def test_order_statistics_equal_pandas(spark, monkeypatch, ranges):
    monkeypatch.setattr(agg, "RANGES", ranges)
    rng = random.Random(1)
    groups = {"one": [3.5], "two": [1.0, 2.0], "same": [7.0] * 50, "hot": [rng.gauss(0, 1) for _ in range(4000)], "ties": [float(rng.randint(0, 5)) for _ in range(900)],
              "odd": [math.inf, -math.inf, 0.0], None: [1.0, 9.0, 4.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").repartition(6)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.k: [r[f"q{i}"] for i in range(len(shares))] for r in agg.order_statistics(df, ["k"], "v", shares).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        if k != "odd":
            assert got[k] == pytest.approx(list(np.quantile(vs, shares)))
    assert got["odd"][3] == 0.0


def test_describe_equals_pandas_and_has_no_percentile(spark):
    rng = random.Random(2)
    rows = [(t, *(rng.choice([None, float("nan"), rng.random(), 1.0]) for _ in range(4)), rng.randint(1, 9)) for t in ("A", "B") for _ in range(300)]
    rows += [("E", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "ticker string, Open double, High double, Low double, Close double, Volume long")
    want = pd.DataFrame(rows, columns=["ticker", "Open", "High", "Low", "Close", "Volume"])
    for r in agg.describe(df).collect():
        w = want[want.ticker == r.ticker][r.column].astype(float).describe()
        got = [r["count"], r.mean, r.std, r.min, r.p25, r.p50, r.p75, r.max]
        assert [x if x is not None else math.nan for x in got] == pytest.approx(list(w), nan_ok=True)
    plan = agg.describe(df)._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan


# fixed values: upper tail of the chi-square distribution from tables (x, degrees of freedom, probability)
TAILS = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (9.487729036781154, 4, 0.05), (18.307038053275146, 10, 0.05),
         (29.58829844507442, 10, 0.001), (24.99579013972863, 15, 0.05), (43.77297182574219, 30, 0.05), (124.34211340400407, 100, 0.05)]


def test_chi_square_tail(spark):
    df = spark.createDataFrame([(x, k, p) for x, k, p in TAILS], "x double, k long, p double").withColumn("q", chi2_tail(F.col("x"), F.col("k")))
    assert all(abs(r.p - r.q) < 1e-9 for r in df.collect())
    edge = spark.createDataFrame([(0.0, 3), (5.0, 0), (5000.0, 7), (5000.0, 8), (2000.0, 2001), (1e-9, 1)], "x double, k long").withColumn("q", chi2_tail(F.col("x"), F.col("k")))
    q = [r.q for r in edge.collect()]
    assert q[:2] == [1.0, 1.0] and q[2] < 1e-300 and q[3] < 1e-300 and 0.49 < q[4] < 0.52 and q[5] == pytest.approx(math.erfc(math.sqrt(5e-10)), abs=1e-9)
