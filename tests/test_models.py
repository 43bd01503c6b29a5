"""Metrics, baselines, scaling, scoring, attribution."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerwise.operators import attribution as at
from tickerwise.operators import metrics as mt
from tickerwise.operators import models as md


def preds(spark, pairs, ticker="T"):
    return spark.createDataFrame([(ticker, i, y, p) for i, (y, p) in enumerate(pairs)],
                                 "ticker string, i long, y_true int, y_pred int")


def test_confusion_and_metrics(spark):
    # tn=3, fp=1, fn=2, tp=4
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(1, 1)] * 4
    m = mt.classification_metrics(preds(spark, pairs)).first()
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (3, 1, 2, 4)
    assert m["accuracy"] == pytest.approx(0.7)
    assert m["precision"] == pytest.approx(0.8)
    assert m["recall"] == pytest.approx(4 / 6)
    assert m["f1"] == pytest.approx(2 * 0.8 * (4 / 6) / (0.8 + 4 / 6))


def test_zero_division_gives_zero(spark):
    m = mt.classification_metrics(preds(spark, [(0, 0), (0, 0)])).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0 and m["accuracy"] == 1.0


def test_classification_report_rows(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(1, 1)] * 4
    rep = {r["label"]: r for r in mt.classification_report(preds(spark, pairs)).collect()}
    assert set(rep) == {"0", "1", "macro avg", "weighted avg"}
    assert rep["0"]["precision"] == pytest.approx(3 / 5) and rep["0"]["support"] == 4
    assert rep["macro avg"]["recall"] == pytest.approx((0.75 + 4 / 6) / 2)
    assert rep["weighted avg"]["f1"] == pytest.approx((rep["0"]["f1"] * 4 + rep["1"]["f1"] * 6) / 10)


def test_majority_tie_goes_to_smaller_label(spark):
    train = preds(spark, [(0, 0), (1, 0)])
    test = preds(spark, [(1, 0), (0, 0), (1, 0)])
    out = mt.baseline_majority(train, test.drop("y_pred"))
    assert {r["y_pred"] for r in out.collect()} == {0}


def test_stratified_baseline_is_deterministic_and_follows_rate(spark):
    train = preds(spark, [(1, 0)] * 70 + [(0, 0)] * 30)
    test = spark.range(5000).select(F.lit("T").alias("ticker"), F.col("id").alias("i"), F.lit(1).alias("y_true"))
    a = mt.baseline_stratified(train, test, ["i"])
    b = mt.baseline_stratified(train, test.repartition(5), ["i"])
    rate = a.agg(F.avg("y_pred")).first()[0]
    assert 0.66 < rate < 0.74
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_leakage_flags_copy_of_target_only(spark):
    rows = [("T", float(i % 2), float(i % 2), float(i), 1.0, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "ticker string, leak double, also double, noise double, const double, target int")
    out = {r["feature"]: r for r in mt.leakage_corr(df, ["leak", "noise", "const"]).collect()}
    assert out["leak"]["suspicious"] and out["leak"]["corr"] == pytest.approx(1.0)
    assert not out["noise"]["suspicious"]
    assert out["const"]["corr"] is None and not out["const"]["suspicious"]  # Q14: no divide-by-zero error


def test_split_validity(spark):
    d = dt.date(2021, 1, 4)
    rows = [("T", d, "train"), ("T", d + dt.timedelta(days=3), "test")]
    ok = mt.split_validity(spark.createDataFrame(rows, "ticker string, Date date, split string")).first()
    assert ok["valid"] and ok["gap_days"] == 3
    rows.append(("T", d + dt.timedelta(days=5), "train"))
    bad = mt.split_validity(spark.createDataFrame(rows, "ticker string, Date date, split string")).first()
    assert not bad["valid"] and bad["gap_days"] is None


def test_scaler_uses_train_population_std(spark):
    rows = [("T", "train", 1.0), ("T", "train", 3.0), ("T", "test", 5.0), ("U", "train", 2.0), ("U", "test", 9.0)]
    df = spark.createDataFrame(rows, "ticker string, split string, x double")
    out = {(r["ticker"], r["split"], r["x"]) for r in md.standardize(df, ["x"]).collect()}
    # T: mean 2, pop std 1 ; U: std 0 -> divide by 1
    assert out == {("T", "train", -1.0), ("T", "train", 1.0), ("T", "test", 3.0), ("U", "train", 0.0),
                   ("U", "test", 7.0)}


def test_score_linear_probability(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, -1.0)], "a double, b double")
    out = md.score_linear(df, ["a", "b"], {"a": 1.0, "b": 0.5}, 0.0).collect()
    p = [r["probability"] for r in out]
    assert p[0] == pytest.approx(0.5) and p[1] == pytest.approx(1 / (1 + math.exp(-1.5)))
    assert out[0]["prediction"] == 1 and out[1]["confidence"] == pytest.approx(p[1])


def scaled_rows(spark, n=40):
    feats = ["a", "b", "c"]
    rows = [("T", dt.date(2021, 1, 1) + dt.timedelta(days=i), math.sin(i), math.cos(i), (i % 5) - 2.0)
            for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, Date date, a double, b double, c double"), feats


W = {"a": 0.8, "b": -0.4, "c": 0.3}


def test_linear_shap_additivity(spark):
    df, feats = scaled_rows(spark)
    bg = df.limit(10)
    contrib = at.linear_shap(df, bg, feats, W, 0.1)
    tot = contrib.groupBy("ticker", "Date").agg((F.sum("contribution") + F.first("base_value")).alias("s"))
    logit = df.select("ticker", "Date", (F.lit(0.1) + sum(F.lit(W[f]) * F.col(f) for f in feats)).alias("z"))
    bad = tot.join(logit, ["ticker", "Date"]).filter(F.abs(F.col("s") - F.col("z")) > 1e-9).count()
    assert bad == 0
    gi = at.global_importance(contrib).orderBy("rank").collect()
    assert [r["rank"] for r in gi] == [1, 2, 3]


def test_perm_shap_additivity(spark):
    df, feats = scaled_rows(spark, 25)
    bg = df.limit(8)
    contrib = at.perm_shap(df, bg, feats, W, 0.1, n_perm=3)
    tot = contrib.groupBy("ticker", "Date").agg(
        (F.sum("contribution") + F.first("base_value") - F.first("prediction")).alias("err"))
    assert tot.filter(F.abs("err") > 1e-9).count() == 0
    assert contrib.count() == 25 * 3


def test_perm_shap_is_the_mean_over_all_orders(spark):
    from itertools import permutations
    df, feats = scaled_rows(spark, 6)
    bg, big = df.limit(4).toPandas()[feats].to_numpy(), {f: 900.0 * W[f] for f in feats}
    for weights in (W, big):
        w = np.array([weights[f] for f in feats])
        score = lambda v: 1 / (1 + np.exp(-np.clip(v @ w + 0.1, -700, 700)))
        got = {(r["Date"], r["feature"]): r["contribution"] for r in at.perm_shap(df, df.limit(4), feats, weights, 0.1).collect()}
        for r in df.collect():
            want, x = dict.fromkeys(feats, 0.0), np.array([r[f] for f in feats])
            orders = list(permutations(range(len(feats))))
            for z in bg:
                for p in orders:
                    cur = z.copy()
                    for j in p:
                        before = score(cur)
                        cur[j] = x[j]
                        want[feats[j]] += (score(cur) - before) / len(orders) / len(bg)
            assert all(abs(got[r["Date"], f] - want[f]) < 1e-9 for f in feats)


def test_local_ranking(spark):
    df, feats = scaled_rows(spark, 5)
    r = at.local_ranking(at.linear_shap(df, df, feats, W, 0.0))
    top = r.filter("rank = 1").count()
    assert top == 5


def test_seeded_sample_exact_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r["k"] for r in at.seeded_sample(df, 100, ["k"], ["k"]).collect()]
    b = [r["k"] for r in at.seeded_sample(df.repartition(7), 100, ["k"], ["k"]).collect()]
    assert len(a) == 100 and sorted(a) == sorted(b)


def test_reproducibility_and_model_roundtrip(spark, tmp_path):
    from tests.conftest import bar_rows
    from tickerwise.operators import features as feat
    from tickerwise.schema import BAR_SCHEMA, feature_names
    closes = [100 + 5 * math.sin(i / 3.0) + (i % 7) * 0.3 for i in range(160)]
    df = feat.temporal_split(feat.features_full(spark.createDataFrame(bar_rows(closes), BAR_SCHEMA)))
    scaled = md.standardize(df)
    rep = md.reproducibility(scaled, n_runs=2).first()
    assert rep["predictions_identical"] and rep["accuracy_std"] == pytest.approx(0.0)
    model = md.fit_logistic(scaled.filter("split = 'train'"), feature_names())
    path = str(tmp_path / "lr")
    md.save_model(model, path, feature_names(), "logistic", spark)
    m, meta = md.load_model(path, "logistic", spark)
    assert meta["feature_names"] == feature_names() and meta["model_type"] == "logistic"
    assert "trained_at" in meta
    a = md.predict_model(model, scaled, feature_names()).select("Date", "prediction").collect()
    b = md.predict_model(m, scaled, feature_names()).select("Date", "prediction").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_score_requests_paths(spark):
    import json
    feats = ["a", "b"]
    stats = md.fit_scaler(spark.createDataFrame([("T", 1.0, 2.0), ("T", 3.0, 6.0)], "ticker string, a double, b double"),
                          feats)
    reqs = spark.createDataFrame([
        ("T", dt.date(2021, 1, 1), json.dumps({"a": 3.0, "b": 6.0})),
        ("T", dt.date(2021, 1, 2), json.dumps({"a": 3.0})),
        ("U", dt.date(2021, 1, 3), json.dumps({"a": 1.0, "b": 1.0})),
    ], "ticker string, Date date, body string")
    out = {r["Date"].day: r for r in md.score_requests(reqs, stats, feats, {"a": 1.0, "b": 1.0}, 0.0).collect()}
    assert out[1]["status"] == "success" and out[1]["probability"] == pytest.approx(1 / (1 + math.exp(-2.0)))
    assert out[1]["prediction"] == 1 and out[1]["detail"] is None
    assert out[2]["status"] == "error" and out[2]["detail"] == "Missing features: b" and out[2]["prediction"] is None
    assert out[3]["status"] == "error" and out[3]["detail"] == "No model for ticker U"
    assert len(out) == 3


def test_fit_and_prediction_derive_the_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def tick(parts):
        for p in parts:
            seen.add(len(p))
            yield p

    rows = [("T", i, "train" if i < 80 else "test", i % 2, float(i % 7 + i % 2)) for i in range(100)]
    df = spark.createDataFrame(rows, "ticker string, n int, split string, target int, x double")
    once = df.mapInPandas(tick, df.schema)
    assert md.train_and_predict(once, ["x"], "gbt", max_iter=2).count() == 100
    assert seen.value == 100
