"""Split, scaling, scoring, metrics and baseline queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerwise.operators import metrics as mt
from tickerwise.operators import models as md
from tickerwise.operators import validate
from tickerwise.plans.q_clean import FEAT_SPLIT, RULE_SQL, split_features
from tickerwise.plans.registry import register
from tickerwise.schema import feature_names
from tickerwise.functions.exprs import int_mix_sql
from tickerwise.plans import sql_blocks as S
from tickerwise.sources import bars_daily, dirty_bars, label_predictions

FEATS = feature_names()

STATS_SQL = "st AS (SELECT ticker, " + ", ".join(
    f"avg({f}) AS {f}__mean, stddev_pop({f}) AS {f}__std" for f in FEATS) + \
    " FROM sp WHERE split = 'train' GROUP BY ticker)"
SCALED_SQL = "sc AS (SELECT sp.ticker, sp.Date, sp.split, sp.target, " + ", ".join(
    f"(sp.{f} - coalesce(st.{f}__mean, 0.0)) / CASE WHEN st.{f}__std IS NULL OR st.{f}__std = 0 THEN 1.0 ELSE st.{f}__std END AS {f}"
    for f in FEATS) + ", st.ticker IS NOT NULL AS scaler_known FROM sp LEFT JOIN st ON sp.ticker = st.ticker)"
LOGIT = f"CAST({md.LINEAR_INTERCEPT} AS DOUBLE)" + "".join(
    f" + CAST({md.LINEAR_WEIGHTS[f]} AS DOUBLE) * {f}" for f in FEATS)
SCORED_SQL = f"""scored AS (SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction,
  greatest(probability, 1.0 - probability) AS confidence FROM (
  SELECT *, 1.0 / (1.0 + exp(-({LOGIT}))) AS probability FROM sc)),
pred AS (SELECT ticker, Date, split, target AS y_true, CAST(prediction AS INTEGER) AS y_pred FROM scored)"""
BASE = f"{FEAT_SPLIT}, {STATS_SQL}, {SCALED_SQL}, {SCORED_SQL}"

CM_COLS = """CAST(count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS BIGINT) AS tp"""


def _z(num, den):
    return f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / ({den}) ELSE 0.0 END"


METRIC_COLS = (f"tn + fp + fn + tp AS n, round({_z('tp + tn', 'tn + fp + fn + tp')}, 6) AS accuracy, "
               f"round({_z('tp', 'tp + fp')}, 6) AS precision, round({_z('tp', 'tp + fn')}, 6) AS recall, "
               f"round({_z('2 * tp', '2 * tp + fp + fn')}, 6) AS f1")


def scaled(spark, sf):
    return md.standardize(split_features(spark, sf), FEATS)


def predictions(spark, sf):
    """Linear-model predictions as (ticker, Date, split, y_true, y_pred)."""
    s = md.score_linear(scaled(spark, sf), FEATS)
    return s.select("ticker", "Date", "split", F.col("target").alias("y_true"), F.col("prediction").alias("y_pred"))


THIN_SQL = ("sp AS (SELECT * FROM sp0 UNION ALL SELECT * REPLACE ('Thin' AS ticker, 'test' AS split) FROM sp0 "
            "WHERE ticker = 'Brand#11' QUALIFY row_number() OVER (ORDER BY Date) = 1)")


def with_thin(sp):
    """Plus a ticker of one row, which has no train rows and hence no scaler."""
    first = F.row_number().over(Window.partitionBy("ticker").orderBy("Date"))
    thin = sp.where("ticker = 'Brand#11'").withColumn("_r", first).where("_r = 1").drop("_r")
    return sp.unionByName(thin.withColumn("ticker", F.lit("Thin")).withColumn("split", F.lit("test")))


@register("standardize", f"{FEAT_SPLIT.replace('sp AS (', 'sp0 AS (')}, {THIN_SQL}, {STATS_SQL}, {SCALED_SQL} SELECT ticker, Date, split, scaler_known, "
          + ", ".join(f"round({f}, 6) AS {f}" for f in FEATS) + " FROM sc")
def q_standardize(spark, sf):
    """M1: features scaled with train-only mean and population std per ticker; one ticker has no train rows."""
    return md.standardize(with_thin(split_features(spark, sf)), FEATS).select("ticker", "Date", "split", "scaler_known", *FEATS)


@register("score_linear", f"{BASE} SELECT ticker, Date, split, target, round(probability, 6) AS probability, "
          "CAST(prediction AS INTEGER) AS prediction, round(confidence, 6) AS confidence FROM scored")
def q_score_linear(spark, sf):
    """M4 twin: logistic score of a fixed linear model on standardized features."""
    return md.score_linear(scaled(spark, sf), FEATS).select(
        "ticker", "Date", "split", "target", "probability", "prediction", "confidence")


@register("confusion_matrix", f"{BASE} SELECT ticker, split, {CM_COLS} FROM pred GROUP BY ticker, split")
def q_confusion_matrix(spark, sf):
    """M6: TN/FP/FN/TP per ticker and split."""
    return mt.confusion_counts(predictions(spark, sf), ("ticker", "split"))


@register("classification_metrics", f"{BASE}, cm AS (SELECT ticker, split, {CM_COLS} FROM pred GROUP BY ticker, split) "
          f"SELECT ticker, split, tn, fp, fn, tp, {METRIC_COLS} FROM cm")
def q_classification_metrics(spark, sf):
    """M5: accuracy, precision, recall, f1 per ticker and split."""
    return mt.classification_metrics(predictions(spark, sf), ("ticker", "split"))


@register("classification_report", f"""{BASE},
cm AS (SELECT ticker, {CM_COLS} FROM pred WHERE split = 'test' GROUP BY ticker),
pc AS (SELECT ticker, tn, fp, fn, tp,
  {_z('tn', 'tn + fn')} AS p0, {_z('tn', 'tn + fp')} AS r0, {_z('2 * tn', '2 * tn + fn + fp')} AS f0,
  {_z('tp', 'tp + fp')} AS p1, {_z('tp', 'tp + fn')} AS r1, {_z('2 * tp', '2 * tp + fp + fn')} AS f1,
  tn + fp + fn + tp AS n FROM cm)
SELECT ticker, '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, tn + fp AS support FROM pc
UNION ALL SELECT ticker, '1', round(p1, 6), round(r1, 6), round(f1, 6), tp + fn FROM pc
UNION ALL SELECT ticker, 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM pc
UNION ALL SELECT ticker, 'weighted avg', round({_z('p0 * (tn + fp) + p1 * (tp + fn)', 'n')}, 6),
  round({_z('r0 * (tn + fp) + r1 * (tp + fn)', 'n')}, 6), round({_z('f0 * (tn + fp) + f1 * (tp + fn)', 'n')}, 6), n FROM pc""")
def q_classification_report(spark, sf):
    """M7: per-class and averaged precision / recall / f1 on the test split."""
    p = predictions(spark, sf).filter(F.col("split") == "test")
    return mt.classification_report(p, ("ticker",))


MAJ_SQL = """maj AS (SELECT ticker, y_true AS majority_label FROM (
  SELECT ticker, y_true, row_number() OVER (PARTITION BY ticker ORDER BY n DESC, y_true ASC) AS r
  FROM (SELECT ticker, y_true, count(*) AS n FROM pred WHERE split = 'train' GROUP BY ticker, y_true)) WHERE r = 1),
majp AS (SELECT p.ticker, p.y_true, m.majority_label AS y_pred FROM pred p JOIN maj m ON p.ticker = m.ticker
  WHERE p.split = 'test')"""
STRAT_SQL = f"""rate AS (SELECT ticker, avg(CAST(y_true AS DOUBLE)) AS _rate FROM pred WHERE split = 'train' GROUP BY ticker),
strp AS (SELECT p.ticker, p.y_true, CASE WHEN CAST({int_mix_sql(["date_diff('day', DATE '1970-01-01', p.Date)", 'b.Volume'])} AS DOUBLE)
  / {float((1 << 31) - 1)} < r._rate THEN 1 ELSE 0 END AS y_pred
  FROM pred p JOIN rate r ON p.ticker = r.ticker JOIN sp b ON p.ticker = b.ticker AND p.Date = b.Date WHERE p.split = 'test')"""


def _test_train(spark, sf):
    p = predictions(spark, sf)
    return p.filter(F.col("split") == "train"), p.filter(F.col("split") == "test")


def majority_metrics(spark, sf):
    train, test = _test_train(spark, sf)
    return mt.classification_metrics(mt.baseline_majority(train.drop("y_pred"), test.drop("y_pred")), ("ticker",))


def stratified_metrics(spark, sf):
    train, test = _test_train(spark, sf)
    vol = split_features(spark, sf).select("ticker", "Date", "Volume")
    test = test.join(vol, ["ticker", "Date"]).withColumn("_day", F.datediff("Date", F.lit("1970-01-01").cast("date")))
    return mt.classification_metrics(mt.baseline_stratified(train, test, ["_day", "Volume"]), ("ticker",))


@register("baseline_majority", f"""{BASE}, {MAJ_SQL}, cm AS (SELECT ticker, {CM_COLS} FROM majp GROUP BY ticker)
SELECT ticker, tn, fp, fn, tp, {METRIC_COLS} FROM cm""")
def q_baseline_majority(spark, sf):
    """M8: always predict the train majority label (tie -> 0); test metrics per ticker."""
    return majority_metrics(spark, sf)


@register("baseline_stratified", f"""{BASE}, {STRAT_SQL}, cm AS (SELECT ticker, {CM_COLS} FROM strp GROUP BY ticker)
SELECT ticker, tn, fp, fn, tp, {METRIC_COLS} FROM cm""")
def q_baseline_stratified(spark, sf):
    """M9: predict 1 at the train positive rate from a hash of (day, volume); test metrics."""
    return stratified_metrics(spark, sf)


COMPARE_SQL = f"""{BASE}, {MAJ_SQL}, {STRAT_SQL},
mm AS (SELECT ticker, {_z("count(*) FILTER (WHERE y_true = y_pred)", "count(*)")} AS test_accuracy FROM pred WHERE split = 'test' GROUP BY ticker),
rm AS (SELECT ticker, {_z("count(*) FILTER (WHERE y_true = y_pred)", "count(*)")} AS random_accuracy FROM strp GROUP BY ticker),
jm AS (SELECT ticker, {_z("count(*) FILTER (WHERE y_true = y_pred)", "count(*)")} AS majority_accuracy FROM majp GROUP BY ticker),
cmp AS (SELECT mm.ticker, test_accuracy, random_accuracy, majority_accuracy,
  test_accuracy > random_accuracy AS beats_random, test_accuracy > majority_accuracy AS beats_majority,
  test_accuracy - random_accuracy AS improvement_over_random, test_accuracy - majority_accuracy AS improvement_over_majority,
  test_accuracy > 0.70 AS suspicious_high_accuracy
  FROM mm JOIN rm ON mm.ticker = rm.ticker JOIN jm ON mm.ticker = jm.ticker)"""


@register("baseline_comparison", f"""{COMPARE_SQL}
SELECT ticker, round(test_accuracy, 6) AS test_accuracy, round(random_accuracy, 6) AS random_accuracy,
  round(majority_accuracy, 6) AS majority_accuracy, beats_random, beats_majority,
  round(improvement_over_random, 6) AS improvement_over_random,
  round(improvement_over_majority, 6) AS improvement_over_majority, suspicious_high_accuracy FROM cmp""")
def q_baseline_comparison(spark, sf):
    """Model vs random vs majority test accuracy per ticker."""
    model = mt.classification_metrics(predictions(spark, sf).filter(F.col("split") == "test"), ("ticker",))
    return mt.baseline_comparison(model, stratified_metrics(spark, sf), majority_metrics(spark, sf))


CI_SQL = f"""ci AS (SELECT ticker,
  {_z("count(*) FILTER (WHERE split = 'train' AND y_true = 0)", "count(*) FILTER (WHERE split = 'train')")} AS train_class_0_pct,
  {_z("count(*) FILTER (WHERE split = 'train' AND y_true = 1)", "count(*) FILTER (WHERE split = 'train')")} AS train_class_1_pct,
  {_z("count(*) FILTER (WHERE split = 'test' AND y_true = 0)", "count(*) FILTER (WHERE split = 'test')")} AS test_class_0_pct,
  {_z("count(*) FILTER (WHERE split = 'test' AND y_true = 1)", "count(*) FILTER (WHERE split = 'test')")} AS test_class_1_pct,
  {_z("count(*) FILTER (WHERE split = 'test' AND y_pred = 0)", "count(*) FILTER (WHERE split = 'test')")} AS pred_class_0_pct,
  {_z("count(*) FILTER (WHERE split = 'test' AND y_pred = 1)", "count(*) FILTER (WHERE split = 'test')")} AS pred_class_1_pct
  FROM pred GROUP BY ticker)"""


@register("class_imbalance", f"""{BASE}, {CI_SQL}
SELECT ticker, round(train_class_0_pct, 6) AS train_class_0_pct, round(train_class_1_pct, 6) AS train_class_1_pct,
  round(test_class_0_pct, 6) AS test_class_0_pct, round(test_class_1_pct, 6) AS test_class_1_pct,
  round(pred_class_0_pct, 6) AS pred_class_0_pct, round(pred_class_1_pct, 6) AS pred_class_1_pct,
  greatest(pred_class_0_pct, pred_class_1_pct) > 0.95 AS trivial_prediction FROM ci""")
def q_class_imbalance(spark, sf):
    """Label / prediction class shares; trivial when one class > 95 % of predictions."""
    return mt.class_imbalance(predictions(spark, sf), ("ticker",))


LEAK_FEATS = FEATS + ["close_next_up"]


@register("leakage_corr", f"""{FEAT_SPLIT},
lk AS (SELECT *, CAST(coalesce(lead(Close) OVER (PARTITION BY ticker ORDER BY Date) > Close, false) AS INTEGER) AS close_next_up FROM sp),
lg AS (SELECT ticker, CAST(target AS DOUBLE) AS _y, feature, value FROM
  (SELECT ticker, target, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in LEAK_FEATS)} FROM lk)
  UNPIVOT (value FOR feature IN ({', '.join(LEAK_FEATS)}))),
c AS (SELECT ticker, feature, CASE WHEN stddev_pop(value) * stddev_pop(_y) > 0
  THEN covar_pop(value, _y) / (stddev_pop(value) * stddev_pop(_y)) END AS corr FROM lg GROUP BY ticker, feature)
SELECT ticker, feature, round(corr, 6) AS corr, coalesce(abs(corr) > 0.99, false) AS suspicious FROM c""")
def q_leakage_corr(spark, sf):
    """|corr(feature, target)| > 0.99 per ticker; close_next_up is a planted look-ahead column."""
    from tickerwise.functions.exprs import by_ticker
    df = split_features(spark, sf).withColumn(
        "close_next_up", F.coalesce(F.lead("Close").over(by_ticker()) > F.col("Close"), F.lit(False)).cast("int"))
    return mt.leakage_corr(df, LEAK_FEATS)


@register("split_validity", f"""{FEAT_SPLIT},
v AS (SELECT ticker, max(Date) FILTER (WHERE split = 'train') AS train_max_date,
  min(Date) FILTER (WHERE split = 'test') AS test_min_date FROM sp GROUP BY ticker)
SELECT ticker, train_max_date, test_min_date, coalesce(train_max_date < test_min_date, false) AS valid,
  CASE WHEN coalesce(train_max_date < test_min_date, false) THEN CAST(date_diff('day', train_max_date, test_min_date) AS INTEGER) END AS gap_days
FROM v""")
def q_split_validity(spark, sf):
    """Train ends strictly before test starts, per ticker."""
    return mt.split_validity(split_features(spark, sf))


@register("metric_compare", f"""{BASE},
cm AS (SELECT ticker, split, {CM_COLS} FROM pred GROUP BY ticker, split),
m AS (SELECT ticker, split, {METRIC_COLS} FROM cm),
lm AS (SELECT ticker, split, metric, value FROM (SELECT ticker, split, accuracy, precision, recall, f1 FROM m)
  UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1))),
j AS (SELECT coalesce(c.ticker, b.ticker) AS ticker, coalesce(c.metric, b.metric) AS metric,
  coalesce(c.value, 0.0) AS current, coalesce(b.value, 0.0) AS baseline
  FROM (SELECT * FROM lm WHERE split = 'test') c FULL JOIN (SELECT * FROM lm WHERE split = 'train') b
  ON c.ticker = b.ticker AND c.metric = b.metric)
SELECT ticker, metric, current, baseline, round(current - baseline, 6) AS delta,
  round(CASE WHEN baseline <> 0 THEN (baseline - current) * 100.0 / baseline END, 6) AS degradation_pct,
  metric = 'accuracy' AND current < baseline * 0.9 AS retrain FROM j""")
def q_metric_compare(spark, sf):
    """Test metrics against train metrics; retrain when accuracy < 0.9 x train."""
    m = mt.round_metrics(mt.classification_metrics(predictions(spark, sf), ("ticker", "split")))
    lm = mt.metrics_long(m, ("ticker", "split"))
    cur = lm.filter(F.col("split") == "test").drop("split")
    base = lm.filter(F.col("split") == "train").drop("split")
    return mt.metric_compare(cur, base)


GATE_CLEAN = "right(ticker, 1) IN ('1', '3', '5')"  # these tickers arrive clean, the others as dirty bars


def gate_bars(spark, sf):
    """What the validator sees before a retraining: clean and broken tickers, and one with a single bar."""
    dirty, bars = dirty_bars(spark, sf), bars_daily(spark, sf)
    nth = F.row_number().over(Window.partitionBy("ticker").orderBy("Date"))
    clean = bars.where(GATE_CLEAN).withColumn("seq", nth.cast("bigint") * 2)
    thin = clean.where("ticker = 'Brand#11' and seq = 2").withColumn("ticker", F.lit("Thin"))
    return dirty.where(f"not ({GATE_CLEAN})").unionByName(clean).unionByName(thin)


def leak_features(spark, sf):
    """Model features and ``probe``: a look-ahead column in tickers ending in 4, the return elsewhere."""
    ahead = F.coalesce(F.lead("Close").over(Window.partitionBy("ticker").orderBy("Date")) > F.col("Close"), F.lit(False)).cast("double")
    return split_features(spark, sf).withColumn("probe", F.when(F.col("ticker").endswith("4"), ahead).otherwise(F.col("returns")))


@register("retrain_gate", f"""{COMPARE_SQL}, {S.dirty()},
gb AS (SELECT ticker, Date, Open, High, Low, Close, Volume, seq FROM dirty WHERE NOT ({GATE_CLEAN})
  UNION ALL SELECT ticker, Date, Open, High, Low, Close, Volume, r * 2 FROM numbered WHERE {GATE_CLEAN}
  UNION ALL SELECT 'Thin', Date, Open, High, Low, Close, Volume, 2 FROM numbered WHERE ticker = 'Brand#11' AND r = 1),
fl AS (SELECT *, {RULE_SQL} AS v, lag(Date) OVER (PARTITION BY ticker ORDER BY seq) > Date AS down FROM gb),
vg AS (SELECT ticker, count(*) = count(DISTINCT Date) AND count(*) FILTER (WHERE down) = 0
    AND CAST(count(*) FILTER (WHERE v IS NOT NULL) AS DOUBLE) * 100.0 / count(*) <= 10.0
    AND count(*) FILTER (WHERE v IS NULL AND (Open IS NULL OR High IS NULL OR Low IS NULL OR Close IS NULL OR Volume IS NULL)) = 0 AS validation_passed
  FROM fl GROUP BY ticker),
sp1 AS (SELECT ticker, Date, split FROM sp UNION ALL SELECT 'Thin', min(Date), 'test' FROM sp WHERE ticker = 'Brand#11'),
sv AS (SELECT ticker, coalesce(max(Date) FILTER (WHERE split = 'train') < min(Date) FILTER (WHERE split = 'test'), false) AS split_valid
  FROM sp1 GROUP BY ticker),
pb AS (SELECT *, CASE WHEN right(ticker, 1) = '4' THEN CAST(coalesce(lead(Close) OVER (PARTITION BY ticker ORDER BY Date) > Close, false) AS DOUBLE) ELSE returns END AS probe FROM sp),
lg AS (SELECT ticker, CAST(target AS DOUBLE) AS _y, feature, value FROM
  (SELECT ticker, target, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in FEATS + ['probe'])} FROM pb)
  UNPIVOT (value FOR feature IN ({', '.join(FEATS + ['probe'])}))),
lc0 AS (SELECT ticker, feature, corr(value, _y) AS corr FROM lg GROUP BY ticker, feature HAVING stddev_pop(value) * stddev_pop(_y) > 0),
lc AS (SELECT ticker, max(abs(corr)) <= 0.99 AS no_leakage FROM lc0 GROUP BY ticker)
SELECT vg.ticker, vg.validation_passed, coalesce(sv.split_valid, false) AS split_valid, coalesce(cmp.beats_random, false) AS beats_random,
  coalesce(l.no_leakage, false) AS no_leakage, true AS reproducible,
  vg.validation_passed AND coalesce(sv.split_valid, false) AND coalesce(cmp.beats_random, false) AND coalesce(l.no_leakage, false) AS retrain_approved
FROM vg LEFT JOIN sv ON vg.ticker = sv.ticker LEFT JOIN cmp ON vg.ticker = cmp.ticker LEFT JOIN lc l ON vg.ticker = l.ticker""")
def q_retrain_gate(spark, sf):
    """Full validator (V8), split (M15), beats random (M10), no leakage (M14), reproducible (M12); a missing leg fails."""
    _, stats = validate.validate_bars(gate_bars(spark, sf))
    gate = stats.select("ticker", F.col("passed").alias("validation_passed"))
    sv = mt.split_validity(with_thin(split_features(spark, sf))).select("ticker", F.col("valid").alias("split_valid"))
    model = mt.classification_metrics(predictions(spark, sf).filter(F.col("split") == "test"), ("ticker",))
    cmp = mt.baseline_comparison(model, stratified_metrics(spark, sf), majority_metrics(spark, sf)).select(
        "ticker", "beats_random")
    leak = (mt.leakage_corr(leak_features(spark, sf), FEATS + ["probe"]).groupBy("ticker")
            .agg((~F.bool_or("suspicious")).alias("no_leakage")))
    repro = md.reproducibility(scaled(spark, sf), FEATS, "logistic", n_runs=3).select("deterministic").scalar()
    legs = ["validation_passed", "split_valid", "beats_random", "no_leakage", "reproducible"]
    out = (gate.join(sv, "ticker", "left").join(cmp, "ticker", "left").join(leak, "ticker", "left").withColumn("reproducible", repro)
           .withColumns({c: F.coalesce(c, F.lit(False)) for c in legs}))
    passed = F.lit(True)
    for c in legs:
        passed = passed & F.col(c)
    return out.withColumn("retrain_approved", passed)


# ------------------------------------------------------- pyspark.ml (rows-only checks)
@register("lr_predictions")
def q_lr_predictions(spark, sf):
    """M2 + M4: pooled balanced logistic regression on per-ticker scaled features."""
    out = md.train_and_predict(scaled(spark, sf), FEATS, "logistic")
    return out.select("ticker", "Date", "split", "target", "prediction", "probability")


@register("gbt_predictions")
def q_gbt_predictions(spark, sf):
    """M3 + M4: gradient-boosted trees (100 x depth 5, rate 0.1) on the same features."""
    out = md.train_and_predict(scaled(spark, sf), FEATS, "gbt")
    return out.select("ticker", "Date", "split", "target", "prediction", "probability")


@register("reproducibility", "SELECT CAST(3 AS BIGINT) AS n_runs, CAST(0 AS BIGINT) AS n_diff, true AS within_tolerance, "
          "true AS predictions_identical, true AS deterministic")
def q_reproducibility(spark, sf):
    """Three fresh logistic fits of the full 1,000 iterations: identical predictions, no accuracy spread."""
    out = md.reproducibility(scaled(spark, sf), FEATS, "logistic", n_runs=3)
    return out.select("n_runs", "n_diff", "within_tolerance", "predictions_identical", "deterministic")


M4 = "accuracy, precision, recall, f1"
CMP_VALUES = ["test_accuracy", "random_accuracy", "majority_accuracy", "improvement_over_random", "improvement_over_majority",
              "beats_random", "beats_majority", "suspicious_high_accuracy"]
CI_VALUES = ["train_class_0_pct", "train_class_1_pct", "test_class_0_pct", "test_class_1_pct", "pred_class_0_pct", "pred_class_1_pct",
             "trivial_prediction"]
MODEL_REPORT_SQL = f"""{COMPARE_SQL}, {CI_SQL},
mcm AS (SELECT ticker, split, {CM_COLS} FROM pred GROUP BY ticker, split),
mm2 AS (SELECT ticker, split, {METRIC_COLS} FROM mcm),
rcm AS (SELECT ticker, {CM_COLS} FROM strp GROUP BY ticker),
rm2 AS (SELECT ticker, {METRIC_COLS} FROM rcm),
jcm AS (SELECT ticker, {CM_COLS} FROM majp GROUP BY ticker),
jm2 AS (SELECT ticker, {METRIC_COLS} FROM jcm)
SELECT ticker, 'model_' || split AS section, metric, value
  FROM (SELECT ticker, split, {M4} FROM mm2) UNPIVOT (value FOR metric IN ({M4}))
UNION ALL SELECT ticker, 'baseline_random' AS section, metric, value
  FROM (SELECT ticker, {M4} FROM rm2) UNPIVOT (value FOR metric IN ({M4}))
UNION ALL SELECT ticker, 'baseline_majority' AS section, metric, value
  FROM (SELECT ticker, {M4} FROM jm2) UNPIVOT (value FOR metric IN ({M4}))
UNION ALL SELECT ticker, 'dataset_info' AS section, metric, value FROM (
  SELECT ticker, CAST(sum(n) FILTER (WHERE split = 'train') AS DOUBLE) AS train_size,
    CAST(sum(n) FILTER (WHERE split = 'test') AS DOUBLE) AS test_size, CAST({len(FEATS)} AS DOUBLE) AS n_features FROM mm2 GROUP BY ticker)
  UNPIVOT (value FOR metric IN (train_size, test_size, n_features))
UNION ALL SELECT ticker, 'comparison' AS section, metric, round(value, 6)
  FROM (SELECT ticker, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in CMP_VALUES)} FROM cmp) UNPIVOT (value FOR metric IN ({', '.join(CMP_VALUES)}))
UNION ALL SELECT ticker, 'class_imbalance' AS section, metric, round(value, 6)
  FROM (SELECT ticker, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in CI_VALUES[:-1])},
    CAST(greatest(pred_class_0_pct, pred_class_1_pct) > 0.95 AS DOUBLE) AS trivial_prediction FROM ci) UNPIVOT (value FOR metric IN ({', '.join(CI_VALUES)}))"""


@register("model_report", MODEL_REPORT_SQL)
def q_model_report(spark, sf):
    """Long (ticker, section, metric, value) table: metrics, baselines, comparison, class imbalance, sizes (flags as 0 / 1)."""
    p = predictions(spark, sf)
    model = mt.classification_metrics(p, ("ticker", "split"))
    random, majority = stratified_metrics(spark, sf), majority_metrics(spark, sf)
    compare = mt.baseline_comparison(model.filter(F.col("split") == "test"), random, majority)

    def section(df, name, values):
        wide = df.select("ticker", *[F.col(c).cast("double").alias(c) for c in values])
        return wide.unpivot(["ticker"], values, "metric", "value").select("ticker", F.lit(name).alias("section"), "metric", "value")

    parts = [
        mt.metrics_long(model, ("ticker", "split")).select(
            "ticker", F.concat(F.lit("model_"), F.col("split")).alias("section"), "metric", "value"),
        mt.metrics_long(random).select(
            "ticker", F.lit("baseline_random").alias("section"), "metric", "value"),
        mt.metrics_long(majority).select(
            "ticker", F.lit("baseline_majority").alias("section"), "metric", "value"),
        section(model.groupBy("ticker").agg(F.sum(F.when(F.col("split") == "train", F.col("n"))).alias("train_size"),
                                            F.sum(F.when(F.col("split") == "test", F.col("n"))).alias("test_size"))
                .withColumn("n_features", F.lit(len(FEATS))), "dataset_info", ["train_size", "test_size", "n_features"]),
        section(compare, "comparison", CMP_VALUES),
        section(mt.class_imbalance(p, ("ticker",)), "class_imbalance", CI_VALUES),
    ]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@register("prediction_diff", f"""{BASE},
rp AS (SELECT ticker, Date, CASE WHEN returns > 0 THEN 1 ELSE 0 END AS rule_pred FROM sp)
SELECT p.ticker, p.split, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE NOT coalesce(p.y_pred = r.rule_pred, false)) AS BIGINT) AS n_diff,
  count(*) FILTER (WHERE NOT coalesce(p.y_pred = r.rule_pred, false)) = 0 AS identical
FROM pred p JOIN rp r ON p.ticker = r.ticker AND p.Date = r.Date GROUP BY p.ticker, p.split""")
def q_prediction_diff(spark, sf):
    """Linear-model predictions vs the momentum rule (returns > 0), row by row, per ticker and split."""
    sp = split_features(spark, sf).withColumn("rule_pred", F.when(F.col("returns") > 0, 1).otherwise(0))
    scored = md.score_linear(md.standardize(sp, FEATS), FEATS)
    return mt.prediction_diff(scored, "prediction", "rule_pred", ("ticker", "split"))


LABEL_SQL = """lp AS (SELECT l.doc_id, l.quality AS y_true, CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS y_pred
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


@register("label_metrics", f"""WITH {LABEL_SQL}, cm AS (SELECT 'quality' AS task, {CM_COLS} FROM lp)
SELECT task, tn, fp, fn, tp, {METRIC_COLS} FROM cm""")
def q_label_metrics(spark, sf):
    """M5/M6 on real labels: labels.quality as truth, a document-length rule (n_chars >= 1000) as prediction."""
    return mt.round_metrics(mt.classification_metrics(
        label_predictions(spark, sf).withColumn("task", F.lit("quality")), ("task",)))


@register("score_requests", f"""{BASE},
rq AS (SELECT ticker, Date, date_diff('day', DATE '1970-01-01', Date) % 7 = 0 AS broken FROM sp)
SELECT r.ticker, r.Date, CASE WHEN r.broken THEN 'error' ELSE 'success' END AS status,
  CASE WHEN r.broken THEN NULL ELSE CAST(s.prediction AS INTEGER) END AS prediction,
  CASE WHEN r.broken THEN NULL ELSE round(s.probability, 6) END AS probability,
  CASE WHEN r.broken THEN NULL ELSE 'linear-fixed' END AS model_version,
  CASE WHEN r.broken THEN 'Missing features: volatility_20' END AS detail
FROM rq r JOIN scored s ON r.ticker = s.ticker AND r.Date = s.Date""")
def q_score_requests(spark, sf):
    """M4 request/response: JSON bodies of all rows (every 7th day omits a field) parsed, checked, scored."""
    sp = split_features(spark, sf)
    stats = md.fit_scaler(sp.filter(F.col("split") == "train"), FEATS)
    bodies = md.request_bodies(sp, FEATS)
    return md.score_requests(bodies, stats, FEATS)


SUMMARY_BANDS = """SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT ticker) AS BIGINT) AS n_tickers,
  CAST(sum(target) AS BIGINT) AS n_up, true AS labels_valid, true AS probabilities_valid, true AS accuracy_plausible FROM sp GROUP BY split"""


def model_summary(pred, train_max: float = 0.80):
    """What a fitted model's output must satisfy whatever the optimiser: one row per input row, labels 0 / 1, P(up) in
    [0, 1] and on the side of the label, pooled accuracy within the plausible bounds (0.40 to ``train_max``, test 0.75)."""
    right = F.avg((F.col("prediction") == F.col("target")).cast("double"))
    side = (F.col("probability") > 0.5) == (F.col("prediction") == 1)
    return pred.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ticker").alias("n_tickers"), F.sum("target").alias("n_up"),
        F.bool_and(F.col("prediction").isin(0, 1)).alias("labels_valid"),
        F.bool_and((F.col("probability") >= 0) & (F.col("probability") <= 1) & (side | (F.abs(F.col("probability") - 0.5) < 1e-9))).alias("probabilities_valid"),
        right.between(0.40, train_max).alias("_wide"), right.between(0.40, 0.75).alias("_narrow")).select(
            "split", "n_rows", "n_tickers", "n_up", "labels_valid", "probabilities_valid",
            F.when(F.col("split") == "test", F.col("_narrow")).otherwise(F.col("_wide")).alias("accuracy_plausible"))


@register("lr_summary", f"{FEAT_SPLIT} {SUMMARY_BANDS}", shared=True)
def q_lr_summary(spark, sf):
    """M2: the logistic model's predictions, checked for what holds of any fit."""
    return model_summary(md.train_and_predict(scaled(spark, sf), FEATS, "logistic"))


@register("gbt_summary", f"{FEAT_SPLIT} {SUMMARY_BANDS}", shared=True)
def q_gbt_summary(spark, sf):
    """M3: the boosted trees' predictions, checked for what holds of any fit.

    The train bound of 0.80 is a linear model's: a hundred trees of depth five learn a few thousand train rows by heart (accuracy 0.889
    at sf0.001), so no upper bound is set on their train accuracy; the test bound stays.
    """
    return model_summary(md.train_and_predict(scaled(spark, sf), FEATS, "gbt"), train_max=1.0)


@register("model_round_trip", f"""{FEAT_SPLIT} SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_diff, 'logistic' AS model_type,
  '{','.join(FEATS)}' AS feature_names FROM sp""", shared=True)
def q_model_round_trip(spark, sf):
    """A model saved with its metadata and loaded again predicts the same from its named features."""
    from tickerwise.schema import select_features
    from tickerwise.streaming.jobs import run_dir
    rows = scaled(spark, sf)
    path = run_dir(spark, "model")
    model = md.fit_logistic(rows.filter(F.col("split") == "train"), FEATS)
    md.save_model(model, path, FEATS, "logistic", spark)
    loaded, meta = md.load_model(path, "logistic", spark)
    before = md.predict_model(model, rows, FEATS).select("ticker", "Date", F.col("probability").alias("a"))
    after = md.predict_model(loaded, select_features(rows, meta["feature_names"]), meta["feature_names"]).select("ticker", "Date", F.col("probability").alias("b"))
    return (before.join(after, ["ticker", "Date"]).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("a") != F.col("b")).alias("n_diff"))
            .withColumn("model_type", F.lit(meta["model_type"])).withColumn("feature_names", F.lit(",".join(meta["feature_names"]))))


@register("training_alerts", f"""{BASE}, cm AS (SELECT ticker, {CM_COLS} FROM pred WHERE split = 'test' GROUP BY ticker),
m AS (SELECT ticker, {METRIC_COLS} FROM cm)
SELECT ticker, 'success' AS color, 'Training Complete - ' || ticker AS title,
  '**Model training finished successfully**' || chr(10) || chr(10) || 'Duration: 12.5s' AS message,
  printf('%.3f', round(accuracy, 3)) AS accuracy, printf('%.3f', round(f1, 3)) AS f1 FROM m""", shared=True)
def q_training_alerts(spark, sf):
    """One alert per trained ticker, with its test accuracy and f1."""
    from tickerwise.operators import monitoring as mon
    m = mt.round_metrics(mt.classification_metrics(predictions(spark, sf).filter(F.col("split") == "test"), ("ticker",)))
    a = mon.training_complete_alerts(m, F.lit(12.5))
    return a.select("ticker", "color", "title", "message", F.col("fields")[0]["value"].alias("accuracy"), F.col("fields")[1]["value"].alias("f1"))


@register("csv_two_sample", f"""{FEAT_SPLIT}
SELECT CASE split WHEN 'train' THEN 'ref' ELSE 'cur' END AS sample, ticker, CAST(count(*) AS BIGINT) AS n_rows, min(Date) AS first_date,
  round(sum(Close), 4) AS close_sum, CAST(sum(Volume) AS BIGINT) AS volume_sum, round(sum(ma_20), 4) AS ma_20_sum, CAST(sum(target) AS BIGINT) AS n_up
FROM sp GROUP BY split, ticker""", digits=4, shared=True)
def q_csv_two_sample(spark, sf):
    """Both samples of every ticker written as CSV in another column order and loaded by header as one table."""
    from tickerwise.sources import load_and_compare, write_bars
    from tickerwise.streaming.jobs import run_dir
    path, sp = run_dir(spark, "two-sample"), split_features(spark, sf)
    cols = ["ticker", "Date", "target", *reversed(FEATS)]
    for split in ("train", "test"):
        write_bars(sp.filter(F.col("split") == split).select(cols), f"{path}/{split}", "csv")
    both = load_and_compare(spark, f"{path}/train", f"{path}/test")
    return both.groupBy("sample", "ticker").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("Date").alias("first_date"), F.sum("Close").alias("close_sum"), F.sum("Volume").alias("volume_sum"),
        F.sum("ma_20").alias("ma_20_sum"), F.sum("target").alias("n_up"))
