"""Feature attribution as DataFrame jobs.

* Linear model, log-odds space: exact Shapley values phi_i = w_i (x_i - E_bg[x_i]),
  base = b + sum_i w_i E_bg[x_i] (Lundberg & Lee 2017, linear case).
* Any scoring function (``score``: rows of features -> scores): permutation Shapley,
  exact over all orders (a sum over feature subsets) or over sampled orders
  (Strumbelj & Kononenko 2014) in ``mapInPandas``; the background (at most
  100 rows, a proven bound) travels as a broadcast variable, rows stay
  distributed and are processed in Arrow batches.  Tree ensembles have an
  exact form of their own (``trees.tree_shap``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.functions.exprs import int_mix
from tickerwise.operators.aggregates import unpivot
from tickerwise.operators.models import LINEAR_INTERCEPT, LINEAR_WEIGHTS
from tickerwise.schema import KEY, ORDER, SEED

MAX_BACKGROUND = 100
MAX_EXACT = 16          # features up to which all 2^F subsets are scored; more need n_perm
BLOCK = 1 << 20         # coalitions scored at once


def seeded_sample(df: DataFrame, n: int, hash_cols: list[str], tiebreak: list[str], seed: int = SEED) -> DataFrame:
    """Exactly min(n, rows) rows chosen by a seeded integer hash of the key.

    Stable under repartitioning (unlike ``sample``), and planned as a
    per-partition top-n followed by a merge (TakeOrderedAndProject).
    """
    return df.withColumn("_h", int_mix(*hash_cols, seed=seed)).orderBy("_h", *tiebreak).limit(n).drop("_h")


def background_means(background: DataFrame, features: list[str]) -> DataFrame:
    """One row: mean of every feature over the background sample."""
    return background.agg(*[F.avg(f).alias(f"{f}__bg") for f in features])


def linear_shap(scaled: DataFrame, background: DataFrame, features: list[str], weights: dict | None = None,
                intercept: float = LINEAR_INTERCEPT, row_key=(KEY, ORDER)) -> DataFrame:
    """E2(a): exact linear Shapley contributions in log-odds, long form.

    Output (row_key..., feature, contribution, base_value).  The one-row
    background mean table is broadcast (size fixed at one row).
    """
    weights = weights or LINEAR_WEIGHTS
    bg = background_means(background, features)
    base = F.lit(float(intercept))
    for f in features:
        base = base + F.lit(float(weights[f])) * F.col(f"{f}__bg")
    bg = bg.withColumn("base_value", base).withColumn("_one", F.lit(1))
    j = (scaled.select(*row_key, *features).withColumn("_one", F.lit(1))
         .join(F.broadcast(bg), "_one").drop("_one"))
    contrib = j.select(*row_key, "base_value",
                       *[(F.lit(float(weights[f])) * (F.col(f) - F.col(f"{f}__bg"))).alias(f) for f in features])
    return unpivot(contrib, list(row_key) + ["base_value"], features, "feature", "contribution")


def global_importance(contrib: DataFrame, by=()) -> DataFrame:
    """Mean |phi| per feature, ranked (all features are displayed)."""
    imp = contrib.groupBy(*by, "feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    w = Window.partitionBy(*by).orderBy(F.col("importance").desc(), F.col("feature")) if by else \
        Window.orderBy(F.col("importance").desc(), F.col("feature"))
    return imp.withColumn("rank", F.row_number().over(w).cast("bigint"))


def local_ranking(contrib: DataFrame, row_key=(KEY, ORDER)) -> DataFrame:
    """Per-row rank of features by |phi| (ties by name) and the push direction."""
    w = Window.partitionBy(*row_key).orderBy(F.abs("contribution").desc(), F.col("feature"))
    return (contrib.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .withColumn("direction", F.when(F.col("contribution") > 0, F.lit("UP")).otherwise(F.lit("DOWN"))))


# ------------------------------------------------------- permutation Shapley
def background_rows(background: DataFrame, features: list[str], max_background: int = MAX_BACKGROUND) -> np.ndarray:
    """The background as a matrix on the driver; an error beyond its bound, as a cut would be arbitrary."""
    rows = background.select(*features).limit(max_background + 1).toPandas().to_numpy(dtype=float)
    if len(rows) > max_background:  # every row is compared with every background row
        raise ValueError(f"background has more than {max_background} rows; sample it or raise max_background")
    if not len(rows):
        raise ValueError("the background is empty")
    return rows


def _score_subsets(x: np.ndarray, z: np.ndarray, score: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """(R, 2^F): mean score over the background where the features of each subset come from x, the others from z, in blocks of subsets."""
    nf = x.shape[1]
    out = np.empty((len(x), 1 << nf))
    step = max(1, BLOCK // len(z))
    for i, row in enumerate(x):
        for s in range(0, 1 << nf, step):
            inside = (np.arange(s, min(s + step, 1 << nf))[:, None] >> np.arange(nf)) & 1 == 1
            mixed = np.where(inside[:, None, :], row, z[None])
            out[i, s:s + len(inside)] = score(mixed.reshape(-1, nf)).reshape(len(inside), len(z)).mean(axis=1)
    return out


def _sigmoid_linear(x: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-(x @ w + b)))


def _subset_credit(nf: int) -> np.ndarray:
    """(2^F, F): weight of each subset's score in each feature's contribution; bit j of a row's number = feature j is in."""
    subset = np.arange(1 << nf)
    inside = (subset[:, None] >> np.arange(nf)) & 1 == 1
    size = inside.sum(axis=1)
    orders = np.array([factorial(n) * factorial(nf - 1 - n) / factorial(nf) for n in range(nf)])
    return np.where(inside, orders[np.maximum(size - 1, 0)][:, None], -orders[np.minimum(size, nf - 1)][:, None])


def _mean_over_subsets(x: np.ndarray, z: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    """(R, 2^F): mean P(up) over the background where the features of each subset come from x, the others from z."""
    half = len(w) // 2
    sums = lambda start, steps: reduce(lambda t, s: np.concatenate([t, t + s[:, None]], axis=1), steps, start)
    out = np.empty((len(x), 1 << len(w)))
    for i, row in enumerate(x):
        steps = ((row - z) * w).T
        low = sums((z @ w + b)[:, None], steps[:half])[:, None, :]         # logits of the first features' subsets
        high = sums(np.zeros((len(z), 1)), steps[half:])[:, :, None]       # what the others add
        with np.errstate(over="ignore"):
            # two small tables of exponentials; beyond their range the sums are taken first
            e = np.exp(-high) * np.exp(-low) if max(abs(low).max(), abs(high).max()) < 700 else np.exp(-(high + low))
        e += 1.0
        out[i] = np.reciprocal(e, out=e).mean(axis=0).reshape(-1)
    return out


def perm_shap(scaled: DataFrame, background: DataFrame, features: list[str], weights: dict | None = None,
              intercept: float = LINEAR_INTERCEPT, n_perm: int | None = None, seed: int = SEED, row_key=(KEY, ORDER),
              chunk: int = 256, max_background: int = MAX_BACKGROUND, score: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """E2(b): permutation Shapley of a score against the background: of ``score``, or of the linear model's P(up).

    ``score`` takes a matrix of rows x features (rows of x and of the background mixed feature by feature) and returns one
    number a row; it is called with blocks of about a million rows.  More than MAX_EXACT features need ``n_perm``.

    For each row x, each background row z and each feature order, features
    switch from z to x one at a time; the change in P(up) is credited to the
    switched feature.  Without ``n_perm`` all orders count, exactly: an order
    only decides which subset has switched before, so the mean over orders is a
    weighted sum over the 2^F subsets (F = 12: 4,096).  With ``n_perm`` that
    many orders are sampled.  Sum over features + base_value equals P(up)(x)
    (base_value = mean P(up) over the background).
    """
    if n_perm is None and len(features) > MAX_EXACT:
        raise ValueError(f"all orders of {len(features)} features need 2^{len(features)} scores a row (at most 2^{MAX_EXACT}); pass n_perm to sample orders")
    spark = scaled.sparkSession
    bc = spark.sparkContext.broadcast(background_rows(background, features, max_background))
    if score is None:
        weights = weights or LINEAR_WEIGHTS
        w = np.array([weights[f] for f in features], dtype=float)
        value, subsets = (lambda m: _sigmoid_linear(m, w, intercept)), (lambda x, z: _mean_over_subsets(x, z, w, intercept))
    else:
        value, subsets = score, (lambda x, z: _score_subsets(x, z, score))
    rng = np.random.default_rng(seed)
    perms = [rng.permutation(len(features)) for _ in range(n_perm or 0)]
    credit = _subset_credit(len(features)) if n_perm is None else None
    key_fields = [scaled.schema[k] for k in row_key]
    out_schema = T.StructType(key_fields + [
        T.StructField("feature", T.StringType()), T.StructField("contribution", T.DoubleType()),
        T.StructField("base_value", T.DoubleType()), T.StructField("prediction", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z = bc.value                       # (B, F)
        base = float(value(z).mean())
        nf = len(features)
        for pdf in batches:
            for s in range(0, len(pdf), chunk):
                part = pdf.iloc[s:s + chunk]
                x = part[features].to_numpy(dtype=float)      # (R, F)
                phi = np.zeros_like(x) if credit is None else subsets(x, z) @ credit
                for p in perms:
                    cur = np.broadcast_to(z, (len(x),) + z.shape).copy()   # (R, B, F)
                    mixed = lambda: value(cur.reshape(-1, nf)).reshape(cur.shape[:2])  # noqa: B023, E731
                    prev = mixed()                                        # (R, B)
                    for j in p:
                        cur[:, :, j] = x[:, None, j]
                        now = mixed()
                        phi[:, j] += (now - prev).mean(axis=1)
                        prev = now
                phi /= len(perms) or 1
                pred = value(x)
                long = pd.DataFrame({
                    **{k: np.repeat(part[k].to_numpy(), nf) for k in row_key},
                    "feature": np.tile(np.array(features, dtype=object), len(x)),
                    "contribution": phi.reshape(-1),
                    "base_value": base,
                    "prediction": np.repeat(pred, nf),
                })
                yield long

    return scaled.select(*row_key, *features).mapInPandas(run, out_schema)
