"""Drift between a reference and a current sample.

Input is ONE DataFrame with a ``sample`` column ('ref' / 'cur') so each
statistic is a single aggregation over a single scan.  Groups are
(ticker, feature); the feature axis comes from an ``unpivot``.

* D1 KS and D2's Wasserstein-1 read the exact empirical CDFs of ``value_cdf``:
  values are first counted per (group, value, sample) — a map-side combined
  aggregate, so a hot value or ticker collapses before the shuffle — then
  summed in two levels, without a whole-group window.
* D2 PSI / Jensen-Shannon use reference-quantile bins plus one below and one
  above the reference range.
* D3 target: two-proportion z-test, two-sided p = erfc(|z| / sqrt 2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.functions.exprs import chi2_tail, erfc_expr, ks_pvalue_expr, safe_div
from tickerwise.operators.aggregates import unpivot
from tickerwise.operators.features import temporal_split
from tickerwise.schema import (
    DATA_DRIFT_THRESHOLD, DRIFT_P_VALUE, DRIFT_SPLIT_RATIO, KEY, ORDER, TARGET, TARGET_DRIFT_THRESHOLD,
)

SQRT2 = 2.0 ** 0.5


def autosplit(df: DataFrame, ratio: float = DRIFT_SPLIT_RATIO, key: str = KEY, order: str = ORDER) -> DataFrame:
    """First floor(n * 0.7) rows of each ticker are the reference, the rest current."""
    return temporal_split(df, ratio, key, order, names=("ref", "cur")).withColumnRenamed("split", "sample")


def drift_features(df: DataFrame, target: str = TARGET, order: str = ORDER, key: str = KEY) -> list[str]:
    """Every numeric column except the target, the date, the key and the sample tag."""
    skip = {target, order, key, "sample", "date"}
    return [f.name for f in df.schema.fields
            if f.name not in skip and f.dataType.typeName() in ("double", "float", "long", "integer", "short")]


def value_cdf(df: DataFrame, features: list[str], key: str = KEY, bins: int = 64) -> DataFrame:
    """Empirical CDFs of both samples at every distinct value of each (ticker, feature).

    Rows (key, feature, value, a, b, ca, cb, n_ref, n_cur, next_value): counts at the value, running counts up to
    and with it, sample sizes, next larger value (NULL at the last).  Values are counted first (map-side combine).  The
    running sums are a two-level prefix sum over ``bins`` value ranges of about equal row counts (approximate
    percentiles of the group), so no window holds a whole group and one far value does not put all rows in one
    range; the ranges only balance the work, the sums are exact.
    """
    long = unpivot(df, [key, "sample"], features, "feature").filter(F.col("value").isNotNull())
    ref, cur = F.count_if(F.col("sample") == "ref"), F.count_if(F.col("sample") == "cur")
    grp = [key, "feature"]
    counts = long.groupBy(*grp, "value").agg(ref.alias("a"), cur.alias("b"))
    cuts = [k / bins for k in range(1, bins)] or [0.5]
    sizes = long.groupBy(*grp).agg(F.approx_percentile("value", cuts, 1000).alias("_cuts"), ref.alias("n_ref"), cur.alias("n_cur"))
    # repartition: after the join rows may lie by group only, which would satisfy the window and keep a hot group in one task
    binned = (counts.join(sizes, grp).withColumn("_bin", F.size(F.filter("_cuts", lambda c: c < F.col("value")))).drop("_cuts")
              .repartition(*grp, "_bin"))
    inner = Window.partitionBy(*grp, "_bin").orderBy("value")
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    local = (binned.withColumn("_ca", F.sum("a").over(upto)).withColumn("_cb", F.sum("b").over(upto))
             .withColumn("_next", F.lead("value").over(inner)))
    totals = binned.groupBy(*grp, "_bin").agg(F.sum("a").alias("_ta"), F.sum("b").alias("_tb"), F.min("value").alias("_first"))
    order = Window.partitionBy(*grp).orderBy("_bin")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*grp, "_bin", F.coalesce(F.sum("_ta").over(before), F.lit(0)).alias("_oa"),
                            F.coalesce(F.sum("_tb").over(before), F.lit(0)).alias("_ob"), F.lead("_first").over(order).alias("_after"))
    return local.join(offsets, grp + ["_bin"]).select(
        *grp, "value", "a", "b", (F.col("_oa") + F.col("_ca")).alias("ca"), (F.col("_ob") + F.col("_cb")).alias("cb"),
        "n_ref", "n_cur", F.coalesce("_next", "_after").alias("next_value"))


def _gap() -> Column:
    """|F_ref - F_cur| at a value; NULL where a sample is empty."""
    return F.abs(F.try_divide(F.col("ca"), F.col("n_ref")) - F.try_divide(F.col("cb"), F.col("n_cur")))


def ks_drift(df: DataFrame, features: list[str], key: str = KEY, p_value: float = DRIFT_P_VALUE,
             bins: int = 64) -> DataFrame:
    """Per (ticker, feature) KS statistic D, asymptotic p, drifted = p < 0.05.

    Exact D at any size (see :func:`value_cdf`).  A group without reference or without current rows keeps its row with
    NULL statistics and is not drifted.
    """
    out = (value_cdf(df, features, key, bins).groupBy(key, "feature")
           .agg(F.max(_gap()).alias("ks_stat"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur")))
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    p = ks_pvalue_expr(F.col("ks_stat"), F.greatest("n_ref", F.lit(1)), F.greatest("n_cur", F.lit(1)))
    return (out.withColumn("p_value", F.when(both, p))
            .withColumn("drifted", F.coalesce(F.col("p_value") < p_value, F.lit(False))))


def binned_drift(df: DataFrame, features: list[str], key: str = KEY, bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """PSI and Jensen-Shannon distance on reference-quantile bins, exact Wasserstein-1.

    The bins are the reference sample's ``bins`` quantile ranges (upper edges included) plus one below its minimum and
    one above its maximum, so nothing is clamped; in PSI an empty share counts as ``eps``.  Wasserstein-1 is the area
    between the two CDFs over all distinct values.  Without rows in one of the samples the figures are NULL.
    """
    cdf = value_cdf(df, features, key)
    below = F.col("ca") - F.col("a")
    bin_ = (F.when(F.col("ca") == 0, -1).when(below == F.col("n_ref"), bins)
            .otherwise(F.least(F.lit(bins - 1), F.expr(f"try_divide(({bins} * (ca - a)), n_ref)").cast("int"))))
    rows = cdf.withColumn("bin", bin_.cast("int")).withColumn("area", _gap() * F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0)))
    per_bin = rows.groupBy(key, "feature", "bin").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.max("n_ref").alias("n_ref"),
                                                      F.max("n_cur").alias("n_cur"), F.sum("area").alias("area"))
    p, q = F.try_divide(F.col("a"), F.col("n_ref")), F.try_divide(F.col("b"), F.col("n_cur"))
    t = per_bin.withColumn("p", p).withColumn("q", q).withColumn("m", (F.col("p") + F.col("q")) / 2)
    kl = lambda x, y: F.when(x > 0, x * F.log(F.try_divide(x, y))).otherwise(F.lit(0.0))
    pe, qe = F.greatest("p", F.lit(eps)), F.greatest("q", F.lit(eps))
    both = (F.max("n_ref") > 0) & (F.max("n_cur") > 0)
    return t.groupBy(key, "feature").agg(
        F.when(both, F.sum((qe - pe) * F.log(qe / pe))).alias("psi"),
        F.when(both, F.sqrt(F.greatest(F.lit(0.0), (F.sum(kl(F.col("p"), F.col("m"))) + F.sum(kl(F.col("q"), F.col("m")))) / 2
                                       / F.log(F.lit(2.0))))).alias("js_distance"),
        F.when(both, F.sum("area")).alias("wasserstein"))


def two_proportion_z(x1: Column, n1: Column, x2: Column, n2: Column) -> Column:
    """z of two proportions; NULL when a sample is empty or the pooled rate is 0 or 1."""
    p1, p2 = F.try_divide(x1.cast("double"), n1), F.try_divide(x2.cast("double"), n2)
    pool = F.try_divide((x1 + x2).cast("double"), n1 + n2)
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return safe_div(p1 - p2, se)


def target_drift(df: DataFrame, key: str = KEY, target: str = TARGET, p_value: float = DRIFT_P_VALUE,
                 compat_threshold: float = TARGET_DRIFT_THRESHOLD) -> DataFrame:
    """D3: two-proportion z-test of the positive rate, ref vs cur.

    ``target_drift_detected`` uses p < 0.05; ``target_drift_compat`` repeats
    the reference's literal gate (the p-value compared as a score > 0.3).
    """
    ref, cur = F.col("sample") == "ref", F.col("sample") == "cur"
    pos = F.col(target) == 1
    out = df.groupBy(key).agg(F.count_if(ref).alias("n_ref"), F.count_if(ref & pos).alias("pos_ref"),
                              F.count_if(cur).alias("n_cur"), F.count_if(cur & pos).alias("pos_cur"))
    z = two_proportion_z(F.col("pos_ref"), F.col("n_ref"), F.col("pos_cur"), F.col("n_cur"))
    p = F.when(F.col("z").isNotNull(), erfc_expr(F.abs(F.col("z")) / F.lit(SQRT2)))
    return (out.withColumn("z", z).withColumn("target_drift_score", p)
            .withColumn("target_drift_detected", F.coalesce(F.col("target_drift_score") < p_value, F.lit(False)))
            .withColumn("target_drift_compat", F.coalesce(F.col("target_drift_score") > compat_threshold, F.lit(False))))


def chi2_drift(df: DataFrame, columns: list[str], key: str = KEY, p_value: float = DRIFT_P_VALUE) -> DataFrame:
    """Chi-square test of category counts, ref vs cur, per (ticker, column).

    p is the exact chi-square tail for any number of categories (``chi2_tail``).
    """
    long = (df.select(key, "sample", *[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot([key, "sample"], columns, "feature", "category").filter(F.col("category").isNotNull()))
    cnt = (long.groupBy(key, "feature", "category")
           .agg(F.count_if(F.col("sample") == "ref").alias("a"), F.count_if(F.col("sample") == "cur").alias("b")))
    g = Window.partitionBy(key, "feature")
    na, nb = F.sum("a").over(g), F.sum("b").over(g)
    t = cnt.withColumn("na", na).withColumn("nb", nb).withColumn("n", F.col("na") + F.col("nb"))
    ea = (F.col("a") + F.col("b")) * F.col("na") / F.col("n")
    eb = (F.col("a") + F.col("b")) * F.col("nb") / F.col("n")
    cell = safe_div((F.col("a") - ea) ** 2, ea) + safe_div((F.col("b") - eb) ** 2, eb)
    out = (t.withColumn("cell", cell).groupBy(key, "feature")
           .agg(F.sum("cell").alias("chi2"), (F.count(F.lit(1)) - 1).alias("dof")))
    p = chi2_tail(F.col("chi2"), F.col("dof"))
    return out.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < p_value)


def dataset_drift(ks: DataFrame, key: str = KEY, threshold: float = DATA_DRIFT_THRESHOLD) -> DataFrame:
    """Share of drifted features per ticker; dataset drift when share >= 0.5.

    The drifted column names are listed (sorted) — the reference's summary
    left this list empty and echoed the threshold as the share.
    """
    return (ks.groupBy(key).agg(F.count(F.lit(1)).alias("n_features"),
                                F.count_if("drifted").alias("num_drifted_columns"),
                                F.array_join(F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))),
                                             ",").alias("drifted_columns"))
            .withColumn("drift_share", F.col("num_drifted_columns") / F.col("n_features"))
            .withColumn("dataset_drift_detected", F.col("drift_share") >= threshold))


def drift_gate(data: DataFrame, target: DataFrame, key: str = KEY,
               threshold: float = DATA_DRIFT_THRESHOLD) -> DataFrame:
    """Significant when the data share exceeds 0.5 or the target test rejects.

    ``significant_compat`` is the reference's literal rule: its data leg compares the library's echoed threshold with
    itself and never fires, so only the target leg (p-value read as a score) is left.
    """
    j = data.join(target, key)
    echoed = F.lit(threshold)
    return j.select(
        key, "drift_share", "target_drift_score",
        ((F.col("drift_share") > threshold) | F.col("target_drift_detected")).alias("significant"),
        ((echoed > threshold) | F.col("target_drift_compat")).alias("significant_compat"))


def drift_summary(df: DataFrame, features: list[str] | None = None, key: str = KEY, target: str = TARGET) -> DataFrame:
    """Sizes, feature count, data drift and target drift per ticker (one row)."""
    features = features or drift_features(df, target, key=key)
    ks = ks_drift(df, features, key)
    data = dataset_drift(ks, key)
    tgt = target_drift(df, key, target)
    return (data.join(tgt, key)
            .withColumn("reference_size", F.col("n_ref")).withColumn("current_size", F.col("n_cur"))
            .select(key, "reference_size", "current_size", F.col("n_features").alias("feature_count"),
                    "dataset_drift_detected", "drift_share", "num_drifted_columns", "drifted_columns",
                    "target_drift_detected", "target_drift_score", "target_drift_compat", "z"))


def drift_report_json(summary: DataFrame, key: str = KEY) -> DataFrame:
    """One JSON document per ticker in the reference's report layout."""
    doc = F.struct(
        F.struct("reference_size", "current_size", "feature_count").alias("metadata"),
        F.struct("dataset_drift_detected", "drift_share", "num_drifted_columns",
                 F.when(F.col("drifted_columns") == "", F.array().cast("array<string>"))
                 .otherwise(F.split(F.col("drifted_columns"), ",")).alias("drifted_columns")).alias("data_drift"),
        F.struct("target_drift_detected", "target_drift_score").alias("target_drift"))
    return summary.select(key, F.to_json(doc).alias("report"))
