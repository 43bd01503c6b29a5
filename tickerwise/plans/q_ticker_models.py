"""One model per ticker (M2) and tree ensembles as node tables (M3, M4, E2): queries with SQL twins that work by another way."""

from __future__ import annotations

from math import factorial

from pyspark.sql import functions as F

from tickerwise.operators import attribution as at
from tickerwise.operators import logistic as lg
from tickerwise.operators import metrics as mt
from tickerwise.operators import models as md
from tickerwise.operators import trees as tr
from tickerwise.plans.q_attr import BG_SQL, scaled_keyed
from tickerwise.plans.q_model import BASE, CM_COLS, FEATS, METRIC_COLS, scaled
from tickerwise.plans.q_clean import FEAT_SPLIT
from tickerwise.plans.registry import register

# ---- M2: the SQL takes ten full Newton steps, every 13 x 13 system solved by elimination over lists
W = len(FEATS) + 1
_X = ["CAST(1 AS DOUBLE)", *FEATS]
_ROWS = ", ".join("[" + ", ".join(f"sum(s * p * (1 - p) * x[{min(j, k)}] * x[{max(j, k)}])" + (" + 1.0" if j == k > 1 else "") for k in range(1, W + 1))
                  + f", -sum(s * (p - y) * x[{j}])" + (f" - any_value(w)[{j}]" if j > 1 else "") + "]" for j in range(1, W + 1))
_SOLVE = f"""list_reduce([a] || list_transform(range(1, {W + 1}), lambda k: [[CAST(k AS DOUBLE)]]), lambda m, e:
  list_transform(range(1, {W + 1}), lambda r: CASE WHEN r = CAST(e[1][1] AS INT)
    THEN list_transform(m[r], lambda v: v / m[r][r])
    ELSE list_transform(range(1, {W + 2}), lambda c: m[r][c] - m[r][CAST(e[1][1] AS INT)] / m[CAST(e[1][1] AS INT)][CAST(e[1][1] AS INT)] * m[CAST(e[1][1] AS INT)][c]) END))"""
NEWTON = f"""{BASE.replace('WITH ', 'WITH RECURSIVE ', 1)},
cw AS (SELECT ticker, target, nc, sum(nc) OVER (PARTITION BY ticker) AS n, count(*) OVER (PARTITION BY ticker) AS k
  FROM (SELECT ticker, target, count(*) AS nc FROM sc WHERE split = 'train' GROUP BY ticker, target)),
tr AS MATERIALIZED (SELECT sc.ticker, CAST(sc.target AS DOUBLE) AS y, n, n / (2.0 * nc) AS s, [{', '.join(_X)}] AS x
  FROM sc JOIN cw ON cw.ticker = sc.ticker AND cw.target = sc.target WHERE split = 'train' AND k = 2),
newton(i, ticker, w) AS (
  SELECT 0, ticker, list_transform(range({W}), lambda v: CAST(0 AS DOUBLE)) FROM (SELECT DISTINCT ticker FROM tr)
  UNION ALL
  SELECT i + 1, ticker, list_transform(range(1, {W + 1}), lambda r: w[r] + ({_SOLVE})[r][{W + 1}]) FROM (
    SELECT i, ticker, any_value(w) AS w, [{_ROWS}] AS a
    FROM (SELECT newton.i, tr.*, newton.w, 1.0 / (1.0 + exp(-list_dot_product(newton.w, tr.x))) AS p FROM newton JOIN tr ON newton.ticker = tr.ticker WHERE newton.i < 10)
    GROUP BY i, ticker)),
own AS (SELECT ticker, w FROM newton WHERE i = 10)"""


def ticker_models(spark, sf, rows):
    return lg.fit_logistic_by(rows.filter(F.col("split") == "train"), FEATS)


@register("lr_ticker_models", f"""{NEWTON}, names AS (SELECT unnest(['(intercept)', {', '.join(f"'{f}'" for f in FEATS)}]) AS feature, unnest(range(1, {W + 1})) AS j)
SELECT own.ticker, feature, round(w[j], 6) + 0.0 AS weight, (SELECT CAST(any_value(n) AS BIGINT) FROM tr WHERE tr.ticker = own.ticker) AS n_rows,
  true AS converged, true AS gradient_small FROM own, names""", shared=True)
def q_lr_ticker_models(spark, sf):
    """M2: a logistic model for every ticker alone; weights, convergence and the penalised gradient (under 1e-6) of each."""
    models = ticker_models(spark, sf, scaled(spark, sf))
    flags = models.select("ticker", "n_rows", "converged", (F.col("gradient") < 1e-6).alias("gradient_small"))
    return lg.coefficients(models, FEATS).join(flags, "ticker").withColumn("weight", F.col("weight") + 0.0)


@register("lr_ticker_metrics", f"""{NEWTON},
lp AS (SELECT sc.ticker, sc.split, sc.target AS y_true, CAST(list_dot_product(own.w, [{', '.join(_X)}]) >= 0 AS INT) AS y_pred FROM sc JOIN own ON own.ticker = sc.ticker),
cm AS (SELECT ticker, split, {CM_COLS} FROM lp GROUP BY ticker, split)
SELECT ticker, split, tn, fp, fn, tp, {METRIC_COLS} FROM cm""", shared=True)
def q_lr_ticker_metrics(spark, sf):
    """M2, M4, M5: every ticker scored by its own model."""
    rows = scaled(spark, sf)
    out = lg.predict_logistic_by(rows, ticker_models(spark, sf, rows), FEATS)
    return mt.classification_metrics(out.select("ticker", "split", F.col("target").alias("y_true"), F.col("prediction").alias("y_pred")), ("ticker", "split"))


# ---- the fixed ensemble: the SQL is one nested CASE per tree
def _case(tree: int, node: int = 0, column=lambda f: f) -> str:
    _, _, f, h, left, right, v = next(r for r in tr.FIXED_TREES if r[:2] == (tree, node))
    if f is None:
        return f"CAST({v} AS DOUBLE)"
    return f"CASE WHEN coalesce({column(f)} <= {h}, false) THEN {_case(tree, left, column)} ELSE {_case(tree, right, column)} END"


TREES = sorted({r[0] for r in tr.FIXED_TREES})
USED = sorted({r[2] for r in tr.FIXED_TREES if r[2]}, key=FEATS.index)
SCORE_SQL = " + ".join(f"({_case(t)})" for t in TREES)


@register("tree_scores", f"""{BASE}, ts AS (SELECT ticker, Date, split, {SCORE_SQL} AS score FROM sc)
SELECT ticker, Date, split, round(score, 6) + 0.0 AS score, round(1.0 / (1.0 + exp(-score)), 6) AS probability, CAST(score > 1e-12 AS INTEGER) AS prediction FROM ts""", shared=True)
def q_tree_scores(spark, sf):
    """M4: a fixed small ensemble, held as a node table, scored level by level."""
    out = tr.score_trees(scaled(spark, sf), tr.fixed_ensemble(spark, FEATS), FEATS)
    return out.select("ticker", "Date", "split", (F.round("score", 6) + 0.0).alias("score"), "probability", (F.col("score") > 1e-12).cast("int").alias("prediction"))


N_BACKGROUND = 13  # no contribution is then half way between two roundings


def _credit() -> str:
    """(subset, feature, weight): what the score of each subset of the features used adds to each feature's contribution."""
    n, rows = len(USED), []
    for s in range(1 << n):
        k = bin(s).count("1")
        for j, f in enumerate(USED):
            w = factorial(k - 1) * factorial(n - k) / factorial(n) if s >> j & 1 else -factorial(k) * factorial(n - 1 - k) / factorial(n)
            rows.append(f"({s}, '{f}', {w!r})")
    return ", ".join(rows + [f"(0, '{f}', 0.0)" for f in FEATS if f not in USED])


def _mixed(f: str) -> str:
    return f"(CASE WHEN s & {1 << USED.index(f)} <> 0 THEN x.{f} ELSE z.{f} END)"


@register("tree_shap", f"""{BASE}, {BG_SQL.replace('LIMIT 100', f'LIMIT {N_BACKGROUND}')},
v AS (SELECT x.ticker, x.Date, s, avg({' + '.join(f'({_case(t, 0, _mixed)})' for t in TREES)}) AS v
  FROM sc x, bg z, (SELECT unnest(range({1 << len(USED)})) AS s) GROUP BY x.ticker, x.Date, s),
credit(s, feature, weight) AS (VALUES {_credit()})
SELECT ticker, Date, feature, round(sum(weight * v), 6) + 0.0 AS contribution, round(any_value(b), 6) AS base_value, round(any_value(p), 6) + 0.0 AS prediction
FROM (SELECT *, first_value(v) OVER (PARTITION BY ticker, Date ORDER BY s) AS b, last_value(v) OVER (PARTITION BY ticker, Date ORDER BY s
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS p FROM v) JOIN credit USING (s) GROUP BY ticker, Date, feature""", shared=True)
def q_tree_shap(spark, sf):
    """E2(b): exact contributions of the fixed ensemble's score for every row; the SQL scores all subsets of the features used."""
    sc = scaled_keyed(spark, sf)
    bg = at.seeded_sample(sc.filter(F.col("split") == "train"), N_BACKGROUND, ["_day", "_vol"], ["ticker", "Date"])
    out = tr.tree_shap(sc, bg, tr.fixed_ensemble(spark, FEATS), FEATS)
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in ("contribution", "prediction")})


@register("gbt_node_table", f"""{FEAT_SPLIT} SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_prediction_diff, CAST(0 AS BIGINT) AS n_probability_diff,
  CAST(20 AS BIGINT) AS n_trees, true AS leaves_complete FROM sp""", shared=True)
def q_gbt_node_table(spark, sf):
    """M3, M4: a fitted ensemble exported to its node table scores every row as the library's own transform does."""
    from tickerwise.streaming.jobs import run_dir
    rows = scaled(spark, sf)
    model = md.fit_gbt(rows.filter(F.col("split") == "train"), FEATS, max_iter=20)
    nodes = tr.node_table(model, run_dir(spark, "gbt"), spark)
    own = md.predict_model(model, rows, FEATS).select("ticker", "Date", F.col("prediction").alias("a"), F.col("probability").alias("pa"))
    table = tr.score_trees(rows, nodes, FEATS, scale=2.0).select("ticker", "Date", F.col("prediction").alias("b"), F.col("probability").alias("pb"))
    shape = nodes.agg(F.count_distinct("tree").alias("n_trees"), F.bool_and(F.col("feature").isNull() == F.col("value").isNotNull()).alias("leaves_complete"))
    diff = own.join(table, ["ticker", "Date"]).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("a") != F.col("b")).alias("n_prediction_diff"),
                                                   F.count_if(F.abs(F.col("pa") - F.col("pb")) > 1e-9).alias("n_probability_diff"))
    return diff.withColumn("n_trees", shape.select("n_trees").scalar()).withColumn("leaves_complete", shape.select("leaves_complete").scalar())
