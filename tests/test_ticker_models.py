"""One logistic model per ticker, tree ensembles as node tables, and attribution of any score."""

from __future__ import annotations

import datetime as dt
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerwise.operators import attribution as at
from tickerwise.operators import logistic as lg
from tickerwise.operators import models as md
from tickerwise.operators import trees as tr

FEATURES = ["a", "b", "c"]
SCHEMA = "ticker string, Date date, a double, b double, c double, target int"


def sample(seed=0, tickers=4, n=200):
    rng, out = np.random.default_rng(seed), []
    for t in range(tickers):
        x = rng.normal(size=(n, 3))
        x[:, 2] = x[:, 1] + 0.01 * x[:, 2]  # nearly collinear
        y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.5] * (t + 1) + 0.3)))).astype(int)
        if t == 3:
            y = (x[:, 0] > 0).astype(int)  # separable: only the penalty keeps the weights finite
        out += [(f"T{t}", dt.date(2020, 1, 1) + dt.timedelta(days=i), *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return out


def gradient(rows, coef):
    x = np.array([[1.0, *r[2:5]] for r in rows])
    y = np.array([r[5] for r in rows], float)
    s = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    return x.T @ (s * (1 / (1 + np.exp(-x @ coef)) - y)) + np.array([0.0, *coef[1:]])


def test_every_ticker_has_its_own_optimum(spark):
    rows = sample()
    extra = [("one", dt.date(2020, 1, 1), 1.0, 2.0, 3.0, 1)] * 5 + [(None, dt.date(2020, 1, 1 + i), float(i), float(i % 3), 1.0, i % 2) for i in range(20)]
    holes = [("T0", dt.date(2021, 1, 1), None, 1.0, 1.0, 1), ("T0", dt.date(2021, 1, 2), 1.0, float("nan"), 1.0, 0), ("T0", dt.date(2021, 1, 3), 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows + extra + holes, SCHEMA).repartition(7)
    models = {r.ticker: r for r in lg.fit_logistic_by(df, FEATURES).collect()}
    assert set(models) == {"T0", "T1", "T2", "T3", None}  # a ticker with one class has no model
    for t, m in models.items():
        own = [r for r in rows + extra if r[0] == t]
        assert m.n_rows == len(own) and m.converged and m.iterations <= 20
        assert np.abs(gradient(own, np.array(m.coef))).max() < 1e-6


def test_predictions_by_own_model_and_none_without(spark):
    rows = sample(1, 2, 80) + [("alone", dt.date(2020, 1, 1), 0.0, 0.0, 0.0, 1), ("T0", dt.date(2022, 1, 1), None, 0.0, 0.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    models = lg.fit_logistic_by(df, FEATURES)
    coef = {r.ticker: np.array(r.coef) for r in models.collect()}
    for r in lg.predict_logistic_by(df, models, FEATURES).collect():
        if r.ticker == "alone" or r.a is None:
            assert r.probability is None and r.prediction is None
        else:
            assert r.probability == pytest.approx(1 / (1 + np.exp(-coef[r.ticker] @ [1.0, r.a, r.b, r.c]))) and r.prediction == int(r.probability >= 0.5)
    assert {r.feature for r in lg.coefficients(models, FEATURES).collect()} == {"(intercept)", *FEATURES}
    assert lg.fit_logistic_by(df.where("false"), FEATURES).count() == 0


def test_start_far_from_the_optimum_halves_its_steps(spark):
    rows = [("T", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(v), 0.0, 0.0, int(v > 0)) for i, v in enumerate([-900, -800, 1, 2, 700, 1000, -1, -3])]
    m = lg.fit_logistic_by(spark.createDataFrame(rows, SCHEMA), FEATURES, c=1e6).first()
    assert m.converged


NODES = [(0, 0, 0, 0.5, 1, 2, None), (0, 1, 1, -0.2, 3, 4, None), (0, 2, None, None, None, None, 0.7), (0, 3, None, None, None, None, -0.4),
         (0, 4, 0, 0.1, 5, 6, None), (0, 5, None, None, None, None, 0.2), (0, 6, None, None, None, None, -0.9),
         (1, 0, 2, 0.0, 1, 2, None), (1, 1, None, None, None, None, 0.3), (1, 2, 0, -0.3, 3, 4, None), (1, 3, None, None, None, None, 0.05),
         (1, 4, None, None, None, None, -0.6), (2, 0, None, None, None, None, 0.125)]


def plain_score(x):
    """One row walked down every tree."""
    by, total = {(r[0], r[1]): r for r in NODES}, 0.0
    for t in (0, 1, 2):
        n = 0
        while by[t, n][2] is not None:
            r = by[t, n]
            n = r[4] if x[r[2]] is not None and x[r[2]] <= r[3] else r[5]
        total += by[t, n][6]
    return total


def test_descent_equals_a_walk_of_every_row(spark):
    rows = sample(2, 2, 60) + [("N", dt.date(2020, 1, 1), None, 0.0, float("nan"), 0), ("N", dt.date(2020, 1, 2), 0.5, -0.2, 0.0, 0), (None, None, 9.0, 9.0, 9.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = spark.createDataFrame(NODES, tr.NODES)
    got = tr.score_trees(df, nodes, FEATURES).collect()
    assert len(got) == len(rows)
    for r in got:
        x = [None if v is None or v != v else v for v in (r.a, r.b, r.c)]
        assert r.score == pytest.approx(plain_score(x)) and r.prediction == int(r.score > 0) and r.probability == pytest.approx(1 / (1 + np.exp(-r.score)))


def brute_shapley(x, z, score):
    """Mean change when a feature switches from background to row, over all orders and background rows."""
    phi = np.zeros(len(x))
    orders = list(permutations(range(len(x))))
    for back in z:
        for order in orders:
            cur = list(back)
            before = score(cur)
            for j in order:
                cur[j] = x[j]
                now = score(cur)
                phi[j] += now - before
                before = now
    return phi / len(orders) / len(z)


def test_tree_contributions_equal_all_orders(spark):
    rows, back = sample(3, 1, 25), sample(4, 1, 12)
    nodes = spark.createDataFrame(NODES, tr.NODES)
    out = tr.tree_shap(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(back, SCHEMA), nodes, FEATURES).collect()
    z = [list(r[2:5]) for r in back]
    for r in rows:
        mine = {o.feature: o for o in out if o.Date == r[1]}
        want = brute_shapley(list(r[2:5]), z, plain_score)
        assert [mine[f].contribution for f in FEATURES] == pytest.approx(list(want))
        o = mine["a"]
        assert o.base_value == pytest.approx(np.mean([plain_score(b) for b in z])) and o.prediction == pytest.approx(plain_score(r[2:5]))
        assert sum(m.contribution for m in mine.values()) + o.base_value == pytest.approx(o.prediction)


def test_any_score_is_explained_and_too_many_features_are_refused(spark):
    rows, back = sample(5, 1, 6), sample(6, 1, 5)
    df, bg = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(back, SCHEMA)
    score = lambda m: np.tanh(m[:, 0] * m[:, 1]) + np.maximum(m[:, 2], m[:, 0])
    one = lambda x: float(score(np.array([x]))[0])
    out = at.perm_shap(df, bg, FEATURES, score=score).collect()
    for r in rows:
        mine = {o.feature: o for o in out if o.Date == r[1]}
        assert [mine[f].contribution for f in FEATURES] == pytest.approx(list(brute_shapley(list(r[2:5]), [list(b[2:5]) for b in back], one)))
    linear = {"a": 0.4, "b": -0.3, "c": 0.8}
    exact = at.perm_shap(df, bg, FEATURES, weights=linear, intercept=0.1).orderBy("Date", "feature").collect()
    same = at.perm_shap(df, bg, FEATURES, score=lambda m: 1 / (1 + np.exp(-(m @ np.array([0.4, -0.3, 0.8]) + 0.1)))).orderBy("Date", "feature").collect()
    assert [r.contribution for r in exact] == pytest.approx([r.contribution for r in same])
    for r in rows[:2]:
        want = brute_shapley(list(r[2:5]), [list(b[2:5]) for b in back], lambda x: 1 / (1 + np.exp(-(np.dot(x, [0.4, -0.3, 0.8]) + 0.1))))
        assert [o.contribution for o in exact if o.Date == r[1]] == pytest.approx(list(want))
    with pytest.raises(ValueError, match="n_perm"):
        at.perm_shap(df, bg, [f"f{i}" for i in range(30)])
    with pytest.raises(ValueError, match="empty"):
        at.perm_shap(df, bg.where("false"), FEATURES, weights=linear)


def test_exported_ensemble_scores_like_the_library(spark, tmp_path):
    df = spark.createDataFrame(sample(7, 2, 150), SCHEMA)
    model = md.fit_gbt(df, FEATURES, max_iter=8, depth=4)
    nodes = tr.node_table(model, str(tmp_path / "gbt"), spark)
    assert nodes.select("tree").distinct().count() == 8 and nodes.where("(feature is null) = (value is null)").count() == 0
    own = md.predict_model(model, df, FEATURES).select("ticker", "Date", F.col("probability").alias("p"), F.col("prediction").alias("q"))
    both = tr.score_trees(df, nodes, FEATURES, scale=2.0).join(own, ["ticker", "Date"])
    assert both.count() == 300 and both.where("abs(p - probability) > 1e-12 or q <> prediction").count() == 0
    phi = tr.tree_shap(df.limit(5), df.orderBy("Date").limit(10), nodes, FEATURES)
    sums = phi.groupBy("ticker", "Date").agg((F.sum("contribution") + F.max("base_value") - F.max("prediction")).alias("gap")).collect()
    assert all(abs(r.gap) < 1e-9 for r in sums)
