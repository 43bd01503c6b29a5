"""Classification metrics, baselines and model checks.

Inputs are prediction tables with a true label and a predicted label column
and any grouping keys (ticker, split).  Every metric is a conditional count
aggregated per group, so it partial-aggregates before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.functions.exprs import unit_uniform
from tickerwise.operators.aggregates import pearson, unpivot
from tickerwise.schema import KEY, LEAKAGE_CORR, ORDER, SUSPICIOUS_ACCURACY, TRIVIAL_PREDICTION_SHARE


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den is 0 (sklearn zero_division=0)."""
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, by=(KEY,), y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """M6: TN / FP / FN / TP per group."""
    return df.groupBy(*by).agg(
        F.count_if((F.col(y) == 0) & (F.col(p) == 0)).alias("tn"),
        F.count_if((F.col(y) == 0) & (F.col(p) == 1)).alias("fp"),
        F.count_if((F.col(y) == 1) & (F.col(p) == 0)).alias("fn"),
        F.count_if((F.col(y) == 1) & (F.col(p) == 1)).alias("tp"),
    )


def metrics_from_counts(cm: DataFrame) -> DataFrame:
    """M5: accuracy, precision, recall, f1 from confusion counts (0 when undefined)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    prec = _ratio(tp, tp + fp)
    rec = _ratio(tp, tp + fn)
    return (cm.withColumn("n", n)
            .withColumn("accuracy", _ratio(tp + tn, n))
            .withColumn("precision", prec)
            .withColumn("recall", rec)
            .withColumn("f1", _ratio(2 * tp, 2 * tp + fp + fn)))


def classification_metrics(df: DataFrame, by=(KEY,), y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return metrics_from_counts(confusion_counts(df, by, y, p))


def classification_report(df: DataFrame, by=(KEY,), y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """M7: per-class precision / recall / f1 / support plus macro and weighted averages."""
    cm = confusion_counts(df, by, y, p)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def cls(name, t_p, f_p, f_n, support):
        pr, rc = _ratio(t_p, t_p + f_p), _ratio(t_p, t_p + f_n)
        return F.struct(F.lit(name).alias("label"), pr.alias("precision"), rc.alias("recall"),
                        _ratio(2 * t_p, 2 * t_p + f_p + f_n).alias("f1"), support.cast("bigint").alias("support"))

    down = cls("0", tn, fn, fp, tn + fp)
    up = cls("1", tp, fp, fn, tp + fn)
    n = tn + fp + fn + tp
    macro = F.struct(F.lit("macro avg").alias("label"),
                     ((down.precision + up.precision) / 2).alias("precision"),
                     ((down.recall + up.recall) / 2).alias("recall"),
                     ((down.f1 + up.f1) / 2).alias("f1"), n.cast("bigint").alias("support"))
    wavg = lambda a, b: _ratio(a * (tn + fp) + b * (tp + fn), n)
    weighted = F.struct(F.lit("weighted avg").alias("label"),
                        wavg(down.precision, up.precision).alias("precision"),
                        wavg(down.recall, up.recall).alias("recall"),
                        wavg(down.f1, up.f1).alias("f1"), n.cast("bigint").alias("support"))
    return cm.select(*by, F.inline(F.array(down, up, macro, weighted)))


def majority_labels(train: DataFrame, by=(KEY,), y: str = "y_true") -> DataFrame:
    """M8 fit: most frequent train label per group; a tie goes to the smaller label."""
    counts = train.groupBy(*by, y).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy(F.col("_n").desc(), F.col(y).asc())
    return (counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
            .select(*by, F.col(y).alias("majority_label")))


def baseline_majority(train: DataFrame, test: DataFrame, by=(KEY,), y: str = "y_true") -> DataFrame:
    """M8: predict the train majority label for every test row (NULL for a group without train rows)."""
    return test.join(majority_labels(train, by, y), list(by), "left").withColumn("y_pred", F.col("majority_label")).drop(
        "majority_label")


def baseline_stratified(train: DataFrame, test: DataFrame, row_key: list[str], by=(KEY,), y: str = "y_true",
                        seed: int = 42) -> DataFrame:
    """M9: predict 1 with the train positive rate, from a deterministic hash of the row key (NULL without train rows)."""
    rate = train.groupBy(*by).agg(F.avg(F.col(y).cast("double")).alias("_rate"))
    u = unit_uniform(*row_key, seed=seed)
    return (test.join(rate, list(by), "left")
            .withColumn("y_pred", F.when(u < F.col("_rate"), 1).when(F.col("_rate").isNotNull(), 0).cast("int")).drop("_rate"))


def baseline_comparison(model: DataFrame, random: DataFrame, majority: DataFrame, by=(KEY,)) -> DataFrame:
    """Model test accuracy against both baselines; > 0.70 is suspicious."""
    m = model.select(*by, F.col("accuracy").alias("test_accuracy"))
    r = random.select(*by, F.col("accuracy").alias("random_accuracy"))
    j = majority.select(*by, F.col("accuracy").alias("majority_accuracy"))
    return (m.join(r, list(by)).join(j, list(by))
            .withColumn("beats_random", F.col("test_accuracy") > F.col("random_accuracy"))
            .withColumn("beats_majority", F.col("test_accuracy") > F.col("majority_accuracy"))
            .withColumn("improvement_over_random", F.col("test_accuracy") - F.col("random_accuracy"))
            .withColumn("improvement_over_majority", F.col("test_accuracy") - F.col("majority_accuracy"))
            .withColumn("suspicious_high_accuracy", F.col("test_accuracy") > SUSPICIOUS_ACCURACY))


def class_imbalance(pred: DataFrame, by=(KEY,), y: str = "y_true", p: str = "y_pred",
                    split: str = "split") -> DataFrame:
    """Class shares of train / test labels and of test predictions; trivial if one class > 95 %."""
    tr, te = F.col(split) == "train", F.col(split) == "test"

    def share(cond, col, v):
        return _ratio(F.count_if(cond & (F.col(col) == v)), F.count_if(cond))

    out = pred.groupBy(*by).agg(
        share(tr, y, 0).alias("train_class_0_pct"), share(tr, y, 1).alias("train_class_1_pct"),
        share(te, y, 0).alias("test_class_0_pct"), share(te, y, 1).alias("test_class_1_pct"),
        share(te, p, 0).alias("pred_class_0_pct"), share(te, p, 1).alias("pred_class_1_pct"))
    return out.withColumn("trivial_prediction",
                          F.greatest("pred_class_0_pct", "pred_class_1_pct") > TRIVIAL_PREDICTION_SHARE)


def leakage_corr(df: DataFrame, features: list[str], target: str = "target", by=(KEY,),
                 limit: float = LEAKAGE_CORR) -> DataFrame:
    """Pearson r of every feature with the target; |r| > 0.99 is flagged.

    Zero-variance features give NULL and are not flagged.
    """
    long = unpivot(df.withColumn("_y", F.col(target).cast("double")), list(by) + ["_y"], features, "feature")
    return (long.groupBy(*by, "feature").agg(pearson("value", "_y").alias("corr"))
            .withColumn("suspicious", F.coalesce(F.abs("corr") > limit, F.lit(False))))


def split_validity(df: DataFrame, by=(KEY,), order: str = ORDER, split: str = "split") -> DataFrame:
    """The last train date precedes the first test date; gap in days when valid."""
    out = df.groupBy(*by).agg(F.max(F.when(F.col(split) == "train", F.col(order))).alias("train_max_date"),
                              F.min(F.when(F.col(split) == "test", F.col(order))).alias("test_min_date"))
    valid = F.coalesce(F.col("train_max_date") < F.col("test_min_date"), F.lit(False))
    return (out.withColumn("valid", valid)
            .withColumn("gap_days", F.when(valid, F.datediff("test_min_date", "train_max_date"))))


def metric_compare(current: DataFrame, baseline: DataFrame, by=(KEY,), factor: float = 0.9) -> DataFrame:
    """Current vs baseline metrics by name (full outer, missing = 0).

    ``retrain`` flags accuracy below factor x the baseline accuracy.
    """
    c = current.select(*by, "metric", F.col("value").alias("current"))
    b = baseline.select(*by, "metric", F.col("value").alias("baseline"))
    j = c.join(b, list(by) + ["metric"], "full")
    return (j.withColumn("current", F.coalesce("current", F.lit(0.0)))
            .withColumn("baseline", F.coalesce("baseline", F.lit(0.0)))
            .withColumn("delta", F.col("current") - F.col("baseline"))
            .withColumn("degradation_pct", F.when(F.col("baseline") != 0,
                                                  (F.col("baseline") - F.col("current")) * 100.0 / F.col("baseline")))
            .withColumn("retrain", (F.col("metric") == "accuracy") & (F.col("current") < F.col("baseline") * factor)))


def metrics_long(m: DataFrame, by=(KEY,), names=("accuracy", "precision", "recall", "f1")) -> DataFrame:
    """Wide metric row -> (keys, metric, value)."""
    return unpivot(m.select(*by, *names), list(by), list(names), "metric", "value")


def round_metrics(m: DataFrame, digits: int = 6, names=("accuracy", "precision", "recall", "f1")) -> DataFrame:
    """Round metric columns (used before comparing metrics across engines)."""
    return m.withColumns({c: F.round(c, digits) for c in names})


def prediction_diff(df: DataFrame, a: str, b: str, by=(KEY,)) -> DataFrame:
    """Do two prediction columns agree row by row?  (rows, differing rows, identical).

    Both predictions sit on the same rows, so this is one aggregate, no join;
    a NULL on either side counts as a difference.
    """
    differs = ~F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return (df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("n_diff"))
            .withColumn("identical", F.col("n_diff") == 0))
