"""M2, one model per ticker: penalised logistic regressions of all tickers at once, by Newton steps as grouped aggregates.

A step is one pass over the rows of the tickers still open: the loss, gradient and Hessian at a ticker's current weights are
sums by ticker with map-side combine, so a hot ticker's rows are added up where they are; the small system of each
ticker is solved where its sums arrive.  Converged tickers leave; only the number of open ones reaches the driver.
The objective is that of the single-ticker fit: 1/2 |w|^2 + C * sum_i s_i * logloss_i, intercept not penalised, class weights
s = n / (2 n_class) within the ticker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.schema import KEY, TARGET
from tickerwise.sources.reuse import materialize

MODEL = [T.StructField("n_rows", T.LongType()), T.StructField("iterations", T.IntegerType()), T.StructField("converged", T.BooleanType()),
         T.StructField("gradient", T.DoubleType()), T.StructField("coef", T.ArrayType(T.DoubleType()))]


def weighted_rows(train: DataFrame, features: list[str], label: str = TARGET, by: str = KEY) -> DataFrame:
    """(by, y, s, n, x0, x1, ...): complete rows with their balanced class weight; tickers with one class only have no model and no rows here."""
    rows = train.select(F.col(by).alias("_by"), F.col(label).cast("double").alias("y"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    rows = rows.dropna("any", subset=["y", *[f"x{i}" for i in range(len(features))]])
    classes = rows.groupBy("_by", "y").agg(F.count(F.lit(1)).alias("_n"))
    totals = classes.groupBy(F.col("_by").alias("_t")).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("_k")).where("_k = 2")
    weights = classes.join(totals, F.col("_by").eqNullSafe(F.col("_t"))).select(
        F.col("_by").alias("_w"), F.col("y").alias("_wy"), "n", (F.col("n") / (2.0 * F.col("_n"))).alias("s"))
    weights = materialize(weights, "class-weights")  # a written right side, so that the join can split a hot ticker
    return rows.join(weights, F.col("_by").eqNullSafe(F.col("_w")) & (F.col("y") == F.col("_wy"))).drop("_w", "_wy")


def _sums(width: int) -> list[Column]:
    """Loss, gradient and upper Hessian at the weights ``w`` as sums over rows; x_0 is the constant 1."""
    x = [F.lit(1.0), *[F.col(f"x{i}") for i in range(width)]]
    pairs = [(j, k) for j in range(width + 1) for k in range(j, width + 1)]
    return [F.sum("_loss").alias("loss"), F.array(*[F.sum(F.col("_r") * v) for v in x]).alias("grad"),
            F.array(*[F.sum(F.col("_q") * x[j] * x[k]) for j, k in pairs]).alias("hess"), F.max("n").alias("n")]


def _advance(width: int, c: float, tol: float):
    """Sums at base + step * move -> the next state: the step taken and a new Newton move, or half the step where the loss has not fallen."""
    upper = np.triu_indices(width + 1)
    ridge = np.array([0.0] + [1.0] * width)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                base, move, w = np.array(r.base), np.array(r.move), np.array(r.base) + r.step * np.array(r.move)
                loss = c * r.loss + 0.5 * float((ridge * w) @ w)
                grad = c * np.array(r.grad) + ridge * w
                size = float(np.abs(grad).max())
                if loss <= r.best + 1e-4 * r.step * r.slope or size <= tol * r.n:  # slope: of the loss along the move, negative
                    hess = np.zeros((width + 1, width + 1))
                    hess[upper] = c * np.array(r.hess)
                    hess = hess + np.triu(hess, 1).T + np.diag(ridge)
                    new = -np.linalg.lstsq(hess, grad, rcond=None)[0]
                    out.append((r._0, r.n, r.iterations + 1, size <= tol * r.n, size, w, new, 1.0, loss, float(grad @ new)))
                else:
                    out.append((r._0, r.n, r.iterations + 1, False, r.gradient, base, move, r.step / 2, r.best, r.slope))
            yield pd.DataFrame(out, columns=["_by", "n", "iterations", "converged", "gradient", "base", "move", "step", "best", "slope"])
    return run


def fit_logistic_by(train: DataFrame, features: list[str], label: str = TARGET, by: str = KEY, c: float = 1.0, tol: float = 1e-11,
                    max_iter: int = 1000) -> DataFrame:
    """One model per ticker: (by, n_rows, iterations, converged, gradient, coef); coef[0] is the intercept, then the weights of ``features``.

    ``gradient`` is the largest absolute component of the penalised gradient at ``coef``; a ticker has converged when it is at
    most ``tol`` a row.  Rows with a missing feature or label are left out.  A ticker whose rows have one class has no model
    (no row here): the fit would be unbounded.
    """
    width, spark = len(features), train.sparkSession
    rows = materialize(weighted_rows(train, features, label, by), "logistic-rows")
    zero = F.array(*[F.lit(0.0)] * (width + 1))
    state = rows.groupBy("_by").agg(F.max("n").alias("n")).select(
        "_by", "n", F.lit(0).alias("iterations"), F.lit(False).alias("converged"), F.lit(float("inf")).alias("gradient"), zero.alias("base"), zero.alias("move"),
        F.lit(1.0).alias("step"), F.lit(float("inf")).alias("best"), F.lit(0.0).alias("slope"))
    state = materialize(state, "logistic-state")
    names, done = state.columns, []
    z = F.col("w")[0]
    for i in range(width):
        z = z + F.col("w")[i + 1] * F.col(f"x{i}")
    p = 1.0 / (1.0 + F.exp(-F.col("_z")))
    while True:
        at = F.transform(F.arrays_zip("base", "move"), lambda v: v["base"] + F.col("step") * v["move"])
        now = state.select(F.col("_by").alias("_k"), at.alias("w"))
        met = rows.join(now, F.col("_by").eqNullSafe(F.col("_k"))).drop("_k").withColumn("_z", z)
        met = met.withColumns({"_r": F.col("s") * (p - F.col("y")), "_q": F.col("s") * p * (1.0 - p),
                               "_loss": F.col("s") * (F.log1p(F.exp(-F.abs("_z"))) + F.greatest(F.col("_z"), F.lit(0.0)) - F.col("y") * F.col("_z"))})
        sums = met.groupBy(F.col("_by").alias("_0")).agg(*_sums(width)).drop("n")
        joined = sums.join(state, F.col("_0").eqNullSafe(F.col("_by"))).drop("_by")
        state = materialize(joined.mapInPandas(_advance(width, c, tol), state.select(names).schema), "logistic-state")
        over = F.col("converged") | (F.col("iterations") >= max_iter) | (F.col("step") < 1e-12)
        done.append(state.where(over))
        state = state.where(~over)
        if state.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(F.col("_by").alias(by), F.col("n").alias("n_rows"), "iterations", "converged", "gradient", F.col("base").alias("coef"))


def predict_logistic_by(df: DataFrame, models: DataFrame, features: list[str], by: str = KEY) -> DataFrame:
    """``df`` with probability and prediction of each row's own ticker's model; both are NULL without a model or with a missing feature."""
    known = models.select(F.col(by).alias("_k"), "coef")
    z = F.col("coef")[0]
    for i, f in enumerate(features):
        z = z + F.col("coef")[i + 1] * F.col(f)
    out = df.join(known, F.col(by).eqNullSafe(F.col("_k")), "left").withColumn("probability", 1.0 / (1.0 + F.exp(-z)))
    return out.withColumn("prediction", (F.col("probability") >= 0.5).cast("int")).drop("_k", "coef")


def coefficients(models: DataFrame, features: list[str], by: str = KEY) -> DataFrame:
    """Models in long form: (by, feature, weight), the intercept as feature '(intercept)'."""
    names = F.array(F.lit("(intercept)"), *[F.lit(f) for f in features])
    zipped = F.arrays_zip(names.alias("feature"), F.col("coef").alias("weight"))
    return models.select(by, F.inline(zipped))
