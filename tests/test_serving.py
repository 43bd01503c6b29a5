"""Sources, sinks and point-in-time serving."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tickerwise.operators import serving as sv
from tickerwise.operators.features import add_target, features_full
from tickerwise.schema import BAR_SCHEMA, OHLCV
from tickerwise.sources import read_bars_csv, write_bars, write_json_report
from tests.conftest import bar_rows


def ts(d, h=0):
    return dt.datetime(d.year, d.month, d.day, h)


@pytest.fixture
def view(spark):
    d0 = dt.date(2021, 1, 4)
    rows = [("A", ts(d0 + dt.timedelta(days=i)), float(i)) for i in range(0, 10, 2)]  # A on days 0,2,4,6,8
    rows += [("B", ts(d0), 100.0)]
    return spark.createDataFrame(rows, "ticker string, event_timestamp timestamp_ntz, f double"), d0


def test_asof_latest_within_ttl(spark, view):
    v, d0 = view
    reqs = [(1, "A", ts(d0 + dt.timedelta(days=4), 12)),   # exact day 4 row is 12 h old -> hit f=4
            (2, "A", ts(d0 + dt.timedelta(days=5), 12)),   # day 4 row is 36 h old, TTL 1 day -> miss
            (3, "A", ts(d0 + dt.timedelta(days=6))),       # same instant -> hit f=6
            (4, "B", ts(d0 - dt.timedelta(days=1))),       # before any row -> miss
            (5, "C", ts(d0))]                              # unknown ticker -> miss
    r = spark.createDataFrame(reqs, "request_id long, ticker string, event_timestamp timestamp_ntz")
    out = {x["request_id"]: x for x in sv.asof_features(r, v).collect()}
    assert out[1]["found"] and out[1]["f"] == 4.0
    assert not out[2]["found"] and out[2]["f"] is None
    assert out[3]["found"] and out[3]["f"] == 6.0
    assert not out[4]["found"] and not out[5]["found"]
    assert len(out) == 5  # every request kept exactly once


def test_asof_longer_ttl(spark, view):
    v, d0 = view
    r = spark.createDataFrame([(2, "A", ts(d0 + dt.timedelta(days=5), 12))],
                              "request_id long, ticker string, event_timestamp timestamp_ntz")
    out = sv.asof_features(r, v, ttl_days=2).first()
    assert out["found"] and out["f"] == 4.0


def test_asof_answers_every_request(spark, view):
    v, d0 = view
    reqs = [(1, "A", None), (2, "A", None), (2, "A", None), (3, "A", ts(d0 + dt.timedelta(days=4), 6)), (3, "A", ts(d0 + dt.timedelta(days=4), 6)), (None, "A", ts(d0))]
    r = spark.createDataFrame(reqs, "request_id long, ticker string, event_timestamp timestamp_ntz")
    now = F.lit(ts(d0 + dt.timedelta(days=8), 12))
    for ttl, late, mid in ((0.25, None, None), (0.3, None, 4.0), (0.75, 8.0, 4.0), (1, 8.0, 4.0), (90, 8.0, 4.0)):
        out = sv.asof_features(r, v, ttl_days=ttl, as_of=now).collect()
        assert sorted(((x["request_id"] or 0), x["f"]) for x in out) == sorted([(1, late), (2, late), (2, late), (3, mid), (3, mid), (0, 0.0)], key=lambda x: x[0])
        assert all(x["event_timestamp"] is not None and x["found"] == (x["f"] is not None) for x in out)
    assert sv.asof_features(r, v).count() == len(reqs)  # without as_of: now


def test_online_snapshot_lookup_and_misses(spark, view):
    v, d0 = view
    snap = sv.online_snapshot(v, F.lit(ts(d0)), F.lit(ts(d0 + dt.timedelta(days=5))))
    got = {r["ticker"]: r["f"] for r in snap.collect()}
    assert got == {"A": 4.0, "B": 100.0}
    req = spark.createDataFrame([("A",), ("C",)], "ticker string")
    lk = {r["ticker"]: r["found"] for r in sv.online_lookup(req, snap).collect()}
    assert lk == {"A": True, "C": False}
    assert [r["ticker"] for r in sv.online_misses(req, snap).collect()] == ["C"]


def test_source_fallback_per_ticker(spark):
    prim = spark.createDataFrame(bar_rows([1.0, 2.0], ticker="A") + [("B", dt.date(2021, 1, 4)) + (None,) * 5],
                                 BAR_SCHEMA)
    snap = spark.createDataFrame(bar_rows([5.0], ticker="A") + bar_rows([7.0, 8.0, 9.0], ticker="B"), BAR_SCHEMA)
    out = sv.source_fallback(prim, snap)
    src = {r["ticker"]: r["data_source"] for r in out.collect()}
    assert src == {"A": "primary", "B": "snapshot"}
    assert out.filter("ticker = 'B'").count() == 3
    req = spark.createDataFrame([("A",), ("Z",)], "ticker string")
    with pytest.raises(sv.SourceError, match="Z"):
        sv.require_tickers(out, req)


def test_feature_view_casts_and_drops_nulls(spark):
    rows = bar_rows([float(100 + (i % 9)) for i in range(30)])
    fv = sv.feature_view_offline(features_full(spark.createDataFrame(rows, BAR_SCHEMA)))
    assert fv.count() == 10
    assert dict(fv.dtypes)["Volume"] == "double" and dict(fv.dtypes)["event_timestamp"] == "timestamp_ntz"


def test_csv_roundtrip_by_name(spark, tmp_path):
    rows = bar_rows([10.0, 11.0, 12.0], ticker="XY.Z")
    df = spark.createDataFrame(rows, BAR_SCHEMA)
    out = str(tmp_path / "csv")
    # write with a different column order and read it back by header names
    df.select("Date", "Open", "Close", "High", "Low", "Volume").coalesce(1).write.option("header", True).csv(out)
    part = [f for f in os.listdir(out) if f.endswith(".csv")][0]
    os.link(os.path.join(out, part), str(tmp_path / "XY.Z_raw.csv"))
    back = read_bars_csv(spark, str(tmp_path / "XY.Z_raw.csv"))
    assert back.columns[:7] == ["ticker", "Date", *OHLCV]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_partitioned_sink_and_json_report(spark, tmp_path):
    rows = bar_rows([1.0, 2.0], ticker="A") + bar_rows([3.0], ticker="B")
    df = spark.createDataFrame(rows, BAR_SCHEMA)
    write_bars(df, str(tmp_path / "bars"))
    assert sorted(d for d in os.listdir(tmp_path / "bars") if d.startswith("ticker=")) == ["ticker=A", "ticker=B"]
    back = spark.read.parquet(str(tmp_path / "bars")).filter("ticker = 'B'")
    assert back.count() == 1
    rep = spark.createDataFrame([("A", json.dumps({"x": 1}))], "ticker string, report string")
    write_json_report(rep, str(tmp_path / "rep"))
    assert json.loads(spark.read.text(str(tmp_path / "rep")).first()[0]) == {"x": 1}


def test_snapshot_file_summary(spark, tmp_path):
    """A snapshot file with another column order, text NaN and an empty cell, read by header and summarised."""
    from tickerwise.operators.aggregates import up_down_days
    from tickerwise.operators.validate import bar_summary, integrity_gate, missing_counts
    days = [dt.date(2021, 1, 4) + dt.timedelta(days=i) for i in range(60)]
    lines = ["Date,Close,Open,Low,High,Volume"]
    for i, d in enumerate(days):
        close = "NaN" if i == 10 else "" if i == 20 else str(100.0 + i % 7)
        lines.append(f"{d},{close},{100.0 + i % 7},{90.0},{120.0},{1000 + i}.0")
    (tmp_path / "XY_snapshot.csv").write_text("\n".join(lines))
    df = read_bars_csv(spark, str(tmp_path / "XY_snapshot.csv"))
    s = bar_summary(df).first()
    closes = [100.0 + i % 7 for i in range(60) if i not in (10, 20)]
    assert (s["ticker"], s["total_rows"], s["start_date"], s["end_date"]) == ("XY", 60, days[0], days[-1])
    assert (s["close_min"], s["close_max"], s["volume_min"], s["volume_max"]) == (100.0, 106.0, 1000, 1059)
    assert s["close_mean"] == pytest.approx(sum(closes) / len(closes))
    assert {r["column"]: r["n_missing"] for r in missing_counts(df).collect()} == {"Open": 0, "High": 0, "Low": 0, "Close": 2, "Volume": 0}
    assert integrity_gate(df).first()["rows_removed"] == 0  # a text NaN is missing, it breaks no rule
    assert up_down_days(df).first()["up_days"] > 0 and add_target(df).count() == 60


def test_feature_columns_and_required_projection(make_bars):
    from tickerwise.schema import MissingFeaturesError, feature_columns, feature_names, select_features
    full = features_full(make_bars([float(100 + i % 9) for i in range(30)]))
    assert feature_columns(full.columns) == feature_names()
    out = select_features(full, ["ma_5", "Close"])
    assert out.columns == ["ticker", "Date", "ma_5", "Close"]
    with pytest.raises(MissingFeaturesError, match="ma_50"):
        select_features(full, ["ma_5", "ma_50"])


def test_load_and_compare_golden_pair(spark, tmp_path):
    from tests.test_drift import COLS, CUR, GOLDEN_TARGET_P, REF
    from tickerwise.operators import drift as dr
    from tickerwise.sources import load_and_compare
    for name, rows in (("reference", REF), ("current", CUR)):
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(COLS)] + [",".join(map(str, r)) for r in rows]))
    pair = load_and_compare(spark, str(tmp_path / "reference.csv"), str(tmp_path / "current.csv"), ticker="T")
    s = dr.drift_summary(pair).first()
    assert (s["reference_size"], s["current_size"], s["feature_count"]) == (7, 3, 12)
    assert s["num_drifted_columns"] == 11
    assert s["target_drift_score"] == pytest.approx(GOLDEN_TARGET_P, abs=1e-6)


def test_checkpoint_dir_refuses_local_folder_on_cluster():
    from types import SimpleNamespace
    from tickerwise.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None)
    fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://cluster:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)
    shared = SimpleNamespace(get=lambda k, d=None: "/shared/ckpt", set=lambda k, v: None)
    calls = []
    ok = SimpleNamespace(conf=shared, sparkContext=SimpleNamespace(master="spark://cluster:7077",
                                                                     setCheckpointDir=calls.append))
    assert checkpoint_dir(ok) == "/shared/ckpt" and calls == ["/shared/ckpt"]


def test_load_and_compare_of_partitioned_samples(spark, make_bars, tmp_path):
    from tickerwise.sources import load_and_compare
    df = make_bars([1.0, 2.0, 3.0], ticker="0700").unionByName(make_bars([4.0, 5.0], ticker="12"))
    write_bars(df.select(*reversed(df.columns)), str(tmp_path / "a"), "csv")
    write_bars(df.filter("ticker = '0700'"), str(tmp_path / "b"), "csv")
    pair = load_and_compare(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    got = {(r["sample"], r["ticker"]): (r["n"], r["c"]) for r in pair.groupBy("sample", "ticker").agg(F.count("*").alias("n"), F.sum("Close").alias("c")).collect()}
    assert got == {("ref", "0700"): (3, 6.0), ("ref", "12"): (2, 9.0), ("cur", "0700"): (3, 6.0)}


def test_csv_two_sample_covers_every_ticker(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    from tickerwise.plans.q_clean import split_features
    want = split_features(spark, SF_SMALL).groupBy(F.expr("if(split = 'train', 'ref', 'cur')").alias("sample"), "ticker").agg(
        F.count("*").alias("n_rows"), F.sum("Volume").alias("v"), F.round(F.sum("ma_20"), 4).alias("m"))
    got = E.queries()["csv_two_sample"](spark, SF_SMALL).select("sample", "ticker", "n_rows", F.col("volume_sum").alias("v"), F.round("ma_20_sum", 4).alias("m"))
    want, got = sorted(map(tuple, want.collect())), sorted(map(tuple, got.collect()))
    assert got == want and len({r[1] for r in got}) > 1


def join_rows(node) -> int:
    """The most rows that a join of an executed plan gave out."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return join_rows(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return join_rows(node.plan())
    metric = node.metrics().get("numOutputRows")
    own = metric.get().value() if "Join" in name and metric.isDefined() else 0
    children = node.children()
    return max([own, *(join_rows(children.apply(i)) for i in range(children.size()))])


def test_asof_meets_one_row_per_request_at_any_ttl(spark):
    import random
    rng, t0 = random.Random(7), dt.datetime(2021, 1, 4)
    view = [(k, t0 + dt.timedelta(hours=h), float(h)) for k in "AB" for h in range(0, 2400, 5)]
    reqs = [(i, "A", None) for i in range(2000)] + [(i, None, t0) for i in range(2)]
    reqs += [(i, rng.choice("ABC"), t0 + dt.timedelta(microseconds=rng.randrange(-10**11, 10**13))) for i in range(300)]
    v = spark.createDataFrame(view, "ticker string, event_timestamp timestamp_ntz, f double")
    r = spark.createDataFrame(reqs, "request_id long, ticker string, event_timestamp timestamp_ntz")
    now = t0 + dt.timedelta(hours=2398)
    for ttl in (0.1, 1, 90):
        out = sv.asof_features(r, v, ttl_days=ttl, as_of=F.lit(now))
        got = sorted(((x["request_id"], x["ticker"], x["event_timestamp"], x["f"]) for x in out.collect()), key=str)
        want = []
        for i, k, t in reqs:
            t = t or now
            hits = [(s, f) for vk, s, f in view if vk == k and t - dt.timedelta(days=ttl) < s <= t]
            want.append((i, k, t, max(hits)[1] if hits else None))
        assert got == sorted(want, key=str)
        assert join_rows(out._jdf.queryExecution().executedPlan()) == len(reqs)
