"""Scaling, scoring and classifiers.

Models are pooled over tickers: every ticker's features are standardized
with that ticker's own train statistics, then one ``pyspark.ml`` estimator
is fitted on all train rows.  Nothing loops over tickers on the driver.
"""

from __future__ import annotations

import datetime
import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.schema import KEY, ORDER, SEED, TARGET, feature_names
from tickerwise.sources.reuse import materialize

# ---- fixed values: the linear model scored by score_linear / linear_shap ----
LINEAR_INTERCEPT = 0.05
LINEAR_WEIGHTS = {
    "Open": 0.10, "High": -0.05, "Low": 0.05, "Close": -0.20, "Volume": 0.03, "returns": -0.25,
    "ma_5": 0.15, "ma_10": 0.05, "ma_20": 0.08, "volatility_5": 0.04, "volatility_10": -0.03,
    "volatility_20": 0.02,
}
# ---- end of fixed values ----


def fit_scaler(train: DataFrame, features: list[str], by=(KEY,)) -> DataFrame:
    """M1 fit: per-group mean and population std of each feature on train rows."""
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"{f}__mean"), F.stddev_pop(f).alias(f"{f}__std")]
    return train.groupBy(*by).agg(*aggs)


def apply_scaler(df: DataFrame, stats: DataFrame, features: list[str], by=(KEY,), suffix: str = "") -> DataFrame:
    """M1 transform: (x - mean) / std, a zero or missing std divides by 1.

    A group without statistics (no train rows) keeps its rows, unshifted and unscaled, and ``scaler_known`` is false
    for them.  ``stats`` has one row per group; the planner broadcasts it while it is under the broadcast threshold
    and shuffles otherwise.
    """
    j = df.join(stats.withColumn("scaler_known", F.lit(True)), list(by), "left")
    cols = {}
    for f in features:
        sd = F.col(f"{f}__std")
        cols[f + suffix] = ((F.col(f) - F.coalesce(F.col(f"{f}__mean"), F.lit(0.0)))
                            / F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd))
    cols["scaler_known"] = F.coalesce("scaler_known", F.lit(False))
    return j.withColumns(cols).drop(*[c for c in stats.columns if c not in by])


def standardize(df: DataFrame, features: list[str] | None = None, by=(KEY,), split: str = "split") -> DataFrame:
    """M1: scale every row with the train-only statistics of its group."""
    features = features or feature_names()
    stats = fit_scaler(df.filter(F.col(split) == "train"), features, by)
    return apply_scaler(df, stats, features, by)


def linear_logit(features: list[str] | None = None, weights: dict | None = None,
                 intercept: float = LINEAR_INTERCEPT) -> Column:
    weights = weights or LINEAR_WEIGHTS
    features = features or list(weights)
    z = F.lit(float(intercept))
    for f in features:
        z = z + F.lit(float(weights[f])) * F.col(f)
    return z


def score_linear(scaled: DataFrame, features: list[str] | None = None, weights: dict | None = None,
                 intercept: float = LINEAR_INTERCEPT) -> DataFrame:
    """M4 twin: P(up) = 1 / (1 + exp(-(b + sum w*z))) on standardized features."""
    logit = linear_logit(features, weights, intercept)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return (scaled.withColumn("probability", p)
            .withColumn("prediction", F.when(F.col("probability") >= 0.5, 1).otherwise(0).cast("int"))
            .withColumn("confidence", F.greatest(F.col("probability"), F.lit(1.0) - F.col("probability"))))


# ------------------------------------------------------------ pyspark.ml
def _assembled(df: DataFrame, features: list[str]):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=features, outputCol="features_vec").transform(df)


def balanced_weights(train: DataFrame, label: str = TARGET) -> DataFrame:
    """w = n / (2 * n_class) over all train rows, as sklearn's class_weight='balanced'.

    The class-count table has two rows; n is a scalar subquery over it.
    """
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = counts.select(F.sum("_nc").cast("double")).scalar()
    return (train.join(counts, label)
            .withColumn("class_weight", n / (F.lit(2.0) * F.col("_nc"))).drop("_nc"))


def fit_logistic(train: DataFrame, features: list[str], label: str = TARGET, max_iter: int = 1000):
    """M2: balanced-class logistic regression; C = 1 maps to regParam = 1 / sum(w) = 1 / n."""
    return fit_weighted(balanced_weights(train, label), features, label, max_iter)


def fit_weighted(weighted: DataFrame, features: list[str], label: str = TARGET, max_iter: int = 1000):
    """The fit of :func:`fit_logistic` on rows that carry their ``class_weight``."""
    from pyspark.ml.classification import LogisticRegression
    n = weighted.count()
    lr = LogisticRegression(featuresCol="features_vec", labelCol=label, weightCol="class_weight",
                            maxIter=max_iter, regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                            standardization=False, tol=1e-6)
    return lr.fit(_assembled(weighted, features))


def fit_gbt(train: DataFrame, features: list[str], label: str = TARGET, max_iter: int = 100, depth: int = 5,
            step: float = 0.1, seed: int = SEED):
    """M3: gradient-boosted trees, 100 trees of depth 5, learning rate 0.1."""
    from pyspark.ml.classification import GBTClassifier
    gbt = GBTClassifier(featuresCol="features_vec", labelCol=label, maxIter=max_iter, maxDepth=depth,
                        stepSize=step, seed=seed)
    return gbt.fit(_assembled(train, features))


def predict_model(model, df: DataFrame, features: list[str]) -> DataFrame:
    """M4: class and P(up) from a fitted ml model."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(_assembled(df, features))
    return (out.withColumn("probability", vector_to_array("probability")[1])
            .withColumn("prediction", F.col("prediction").cast("int"))
            .drop("features_vec", "rawPrediction"))


def train_and_predict(scaled: DataFrame, features: list[str] | None = None, kind: str = "logistic",
                      split: str = "split", label: str = TARGET, **kw) -> DataFrame:
    """M2 - M4: fit on the train rows, predict every row.

    The scaled rows are written once: the fit passes over them several times and the prediction once more, and none of
    these passes derives them again or takes over the partitions they were derived in.
    """
    features = features or feature_names()
    scaled = materialize(scaled, "model-rows")
    train = scaled.filter(F.col(split) == "train")
    model = fit_logistic(train, features, label, **kw) if kind == "logistic" else fit_gbt(train, features, label, **kw)
    return predict_model(model, scaled, features)


def reproducibility(scaled: DataFrame, features: list[str] | None = None, kind: str = "logistic", n_runs: int = 3,
                    key=(KEY, ORDER), split: str = "split", label: str = TARGET, tolerance: float = 0.01, **kw):
    """Refit a fresh model n times; accuracy spread and identical predictions.

    The train rows with their weights and the test rows are written once; every run fits on that table and writes
    its predictions.  "Identical" is a per-row comparison of run 0 against every other run (a join on the row key).
    """
    features = features or feature_names()
    train = scaled.filter(F.col(split) == "train").select(label, *features)
    train = materialize(balanced_weights(train, label) if kind == "logistic" else train, "train-rows")
    test = materialize(scaled.filter(F.col(split) == "test").select(*key, label, *features), "test-rows")
    runs = []
    for i in range(n_runs):
        model = fit_weighted(train, features, label, **kw) if kind == "logistic" else fit_gbt(train, features, label, **kw)
        p = predict_model(model, test, features).select(*key, label, "prediction").withColumn("run", F.lit(i))
        runs.append(materialize(p, f"run-{i}"))
    allp = runs[0]
    for r in runs[1:]:
        allp = allp.unionByName(r)
    acc = allp.groupBy("run").agg(F.avg((F.col(label) == F.col("prediction")).cast("double")).alias("accuracy"))
    first = allp.filter(F.col("run") == 0).select(*key, F.col("prediction").alias("_p0"))
    diffs = (allp.filter(F.col("run") > 0).join(first, list(key))
             .agg(F.count_if(F.col("prediction") != F.col("_p0")).alias("n_diff")))
    summary = acc.agg(F.avg("accuracy").alias("accuracy_mean"), F.stddev_pop("accuracy").alias("accuracy_std"),
                      (F.max("accuracy") - F.min("accuracy")).alias("accuracy_range"),
                      F.count(F.lit(1)).alias("n_runs"))
    out = summary.withColumn("n_diff", diffs.select("n_diff").scalar())
    return (out.withColumn("within_tolerance", F.col("accuracy_range") <= tolerance)
            .withColumn("predictions_identical", F.col("n_diff") == 0)
            .withColumn("deterministic", F.col("predictions_identical") & (F.col("accuracy_range") == 0)))


def save_model(model, path: str, features: list[str], kind: str, spark=None) -> None:
    """Write the ml model plus a one-row metadata JSON next to it."""
    model.write().overwrite().save(os.path.join(path, "model"))
    meta = {"feature_names": features, "model_type": kind,
            "trained_at": datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")}
    spark = spark or SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").text(
        os.path.join(path, "metadata"))


def load_model(path: str, kind: str = "logistic", spark=None):
    """Read back the model and its metadata."""
    from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
    cls = LogisticRegressionModel if kind == "logistic" else GBTClassificationModel
    model = cls.load(os.path.join(path, "model"))
    spark = spark or SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(os.path.join(path, "metadata")).first()[0])
    return model, meta


# ------------------------------------------------------- request scoring (M4)
def request_bodies(df: DataFrame, fields: list[str], key: str = KEY, order: str = ORDER,
                   omit_every: int = 7) -> DataFrame:
    """JSON request bodies from feature rows; on every ``omit_every``-th day the last field is left out."""
    day = F.datediff(F.col(order), F.lit("1970-01-01").cast("date"))
    body = (F.when(day % omit_every == 0, F.to_json(F.struct(*fields[:-1])))
            .otherwise(F.to_json(F.struct(*fields))))
    return df.select(key, order, body.alias("body"))


def respond(rows: DataFrame, stats: DataFrame, features: list[str], problem: Column, keep: list[str],
            weights: dict | None = None, intercept: float = LINEAR_INTERCEPT, key: str = KEY,
            model_version: str = "linear-fixed") -> DataFrame:
    """Answer one prediction request per row: scale with the model's train statistics, score, set status.

    ``problem`` is NULL for a servable row, else the error text.  The join to
    ``stats`` is a left join: a request for a ticker without a model is
    answered with an error, never dropped.
    """
    j = rows.withColumn("_problem", problem).join(stats.withColumn("_known", F.lit(True)), key, "left")
    scaled = j.withColumns({
        f: (F.col(f) - F.col(f"{f}__mean")) / F.when(F.col(f"{f}__std").isNull() | (F.col(f"{f}__std") == 0),
                                                     F.lit(1.0)).otherwise(F.col(f"{f}__std"))
        for f in features})
    scored = score_linear(scaled, features, weights, intercept)
    known = F.coalesce(F.col("_known"), F.lit(False))
    ok = known & F.col("_problem").isNull()
    detail = F.when(~known, F.concat(F.lit("No model for ticker "), F.col(key))).otherwise(F.col("_problem"))
    return scored.select(
        *keep,
        F.when(ok, F.lit("success")).otherwise(F.lit("error")).alias("status"),
        F.when(ok, F.col("prediction")).alias("prediction"),
        F.when(ok, F.col("probability")).alias("probability"),
        F.when(ok, F.lit(model_version)).alias("model_version"),
        detail.alias("detail"))


def score_requests(requests: DataFrame, stats: DataFrame, features: list[str], weights: dict | None = None,
                   intercept: float = LINEAR_INTERCEPT, key: str = KEY, order: str = ORDER,
                   model_version: str = "linear-fixed") -> DataFrame:
    """M4 / prediction request -> response, per row.

    Bodies are parsed with ``from_json`` against the request schema (every
    feature a required DOUBLE).  A request missing any feature gets
    ``status = 'error'`` and names the missing ones; the others are scaled
    with the model's train statistics (``stats`` from :func:`fit_scaler`),
    scored, and answered with prediction, P(up) and the model version.
    """
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in features])
    parsed = requests.withColumn("_in", F.from_json("body", schema))
    missing = F.filter(F.array(*[F.when(F.col(f"_in.{f}").isNull(), F.lit(f)) for f in features]),
                       lambda x: x.isNotNull())
    flat = parsed.select(key, order, missing.alias("_missing"), *[F.col(f"_in.{f}").alias(f) for f in features])
    problem = F.when(F.size("_missing") > 0, F.concat(F.lit("Missing features: "), F.array_join("_missing", ", ")))
    return respond(flat, stats, features, problem, [key, order], weights, intercept, key, model_version)


def score_lookups(found_rows: DataFrame, stats: DataFrame, features: list[str], keep: list[str],
                  found: str = "found", weights: dict | None = None, intercept: float = LINEAR_INTERCEPT,
                  key: str = KEY, model_version: str = "linear-fixed") -> DataFrame:
    """Ticker requests answered from point-in-time feature lookups (J1 + M4); a miss is an error."""
    problem = F.when(~F.col(found), F.concat(F.lit("No features found for ticker "), F.col(key)))
    return respond(found_rows, stats, features, problem, keep, weights, intercept, key, model_version)
