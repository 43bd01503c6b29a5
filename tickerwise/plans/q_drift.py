"""Drift queries on a 70/30 chronological split of each ticker's features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerwise.functions.exprs import erfc_sql, ks_pvalue_sql
from tickerwise.operators import drift as dr
from tickerwise.operators import features as feat
from tickerwise.plans import sql_blocks as S
from tickerwise.plans.registry import register
from tickerwise.sources.reuse import reuse
from tickerwise.schema import feature_names
from tickerwise.sources import bars_daily

FEATS = feature_names()
SQ2 = repr(2.0 ** 0.5)

DS = (f"WITH bars AS ({S.BARS_DAILY}), {S.features('bars')}, "
      f"fe AS (SELECT * FROM feat_all WHERE {S.not_null(S.FEATURE_COLS)}), "
      f"ds AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY ticker ORDER BY Date) <= "
      f"floor(CAST(count(*) OVER (PARTITION BY ticker) AS DOUBLE) * CAST(0.7 AS DOUBLE)) "
      f"THEN 'ref' ELSE 'cur' END AS sample FROM fe UNION ALL "
      "SELECT * REPLACE ('Thin' AS ticker), 'cur' AS sample FROM fe WHERE ticker = 'Brand#11' QUALIFY row_number() OVER (ORDER BY Date) = 1 "
      "UNION ALL SELECT * REPLACE ('Past' AS ticker), 'ref' AS sample FROM fe WHERE ticker = 'Brand#12' "
      "QUALIFY row_number() OVER (ORDER BY Date) <= 3)")
LONG = (f"lg AS (SELECT ticker, sample, feature, value FROM (SELECT ticker, sample, "
        + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATS)
        + f" FROM ds) UNPIVOT (value FOR feature IN ({', '.join(FEATS)})) WHERE value IS NOT NULL)")
KS = f"""{DS}, {LONG},
cnt AS (SELECT ticker, feature, value, count(*) FILTER (WHERE sample = 'ref') AS a,
  count(*) FILTER (WHERE sample = 'cur') AS b FROM lg GROUP BY ticker, feature, value),
cdf AS (SELECT *, sum(a) OVER (PARTITION BY ticker, feature) AS n_ref, sum(b) OVER (PARTITION BY ticker, feature) AS n_cur,
  abs(sum(a) OVER (PARTITION BY ticker, feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        / nullif(sum(a) OVER (PARTITION BY ticker, feature), 0)
      - sum(b) OVER (PARTITION BY ticker, feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        / nullif(sum(b) OVER (PARTITION BY ticker, feature), 0)) AS gap,
  lead(value) OVER (PARTITION BY ticker, feature ORDER BY value) - value AS width FROM cnt),
ks0 AS (SELECT ticker, feature, max(gap) AS ks_stat, CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur
  FROM cdf GROUP BY ticker, feature),
ks AS (SELECT *, CASE WHEN n_ref > 0 AND n_cur > 0 THEN {ks_pvalue_sql('ks_stat', 'n_ref', 'n_cur')} END AS p_value FROM ks0),
ksd AS (SELECT *, coalesce(p_value < 0.05, false) AS drifted FROM ks)"""
TGT = f"""tc AS (SELECT ticker, CAST(count(*) FILTER (WHERE sample = 'ref') AS BIGINT) AS n_ref,
  CAST(count(*) FILTER (WHERE sample = 'ref' AND target = 1) AS BIGINT) AS pos_ref,
  CAST(count(*) FILTER (WHERE sample = 'cur') AS BIGINT) AS n_cur,
  CAST(count(*) FILTER (WHERE sample = 'cur' AND target = 1) AS BIGINT) AS pos_cur FROM ds GROUP BY ticker),
tz AS (SELECT *, CASE WHEN se <> 0 THEN (CAST(pos_ref AS DOUBLE) / nullif(n_ref, 0) - CAST(pos_cur AS DOUBLE) / nullif(n_cur, 0)) / se END AS z
  FROM (SELECT *, sqrt(pool * (1.0 - pool) * (1.0 / nullif(n_ref, 0) + 1.0 / nullif(n_cur, 0))) AS se FROM (
    SELECT *, CAST(pos_ref + pos_cur AS DOUBLE) / (n_ref + n_cur) AS pool FROM tc))),
td AS (SELECT *, CASE WHEN z IS NOT NULL THEN {erfc_sql(f'abs(z) / {SQ2}')} END AS target_drift_score FROM tz)"""
DATA = """dd AS (SELECT ticker, CAST(count(*) AS BIGINT) AS n_features, CAST(count(*) FILTER (WHERE drifted) AS BIGINT) AS num_drifted_columns,
  coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE drifted)), ','), '') AS drifted_columns,
  CAST(count(*) FILTER (WHERE drifted) AS DOUBLE) / count(*) AS drift_share FROM ksd GROUP BY ticker)"""


def drift_input(spark, sf):
    """Features with the 70/30 ref/cur split; written once per run inside ``shared_inputs`` (several legs read it).

    Two tickers are added that real data has sooner or later: ``Thin`` has one row, hence no reference, and ``Past`` has
    reference rows only (its trading stopped).
    """
    def build():
        df = feat.features_full(bars_daily(spark, sf))
        first = F.row_number().over(Window.partitionBy("ticker").orderBy("Date"))
        thin = df.where("ticker = 'Brand#11'").withColumn("_r", first).where("_r = 1")
        past = df.where("ticker = 'Brand#12'").withColumn("_r", first).where("_r <= 3")
        return (dr.autosplit(df)
                .unionByName(thin.drop("_r").withColumn("ticker", F.lit("Thin")).withColumn("sample", F.lit("cur")))
                .unionByName(past.drop("_r").withColumn("ticker", F.lit("Past")).withColumn("sample", F.lit("ref"))))
    return reuse(("drift_input", sf), build)


@register("ks_drift", f"{KS} SELECT ticker, feature, round(ks_stat, 6) AS ks_stat, n_ref, n_cur, "
          "round(p_value, 6) AS p_value, drifted FROM ksd")
def q_ks_drift(spark, sf):
    """Two-sample KS per ticker and feature, drifted when p < 0.05."""
    return dr.ks_drift(drift_input(spark, sf), FEATS)


@register("psi_drift", f"""{KS},
rk AS (SELECT ticker, feature, value, row_number() OVER (PARTITION BY ticker, feature ORDER BY value) AS i,
  count(*) OVER (PARTITION BY ticker, feature) AS n FROM lg WHERE sample = 'ref'),
ed AS (SELECT ticker, feature, list(value) AS edges FROM rk JOIN range(1, 10) t(k) ON i = (k * n + 9) // 10 GROUP BY ticker, feature),
lim AS (SELECT ticker, feature, min(value) AS lo, max(value) AS hi FROM rk GROUP BY ticker, feature),
sz AS (SELECT ticker, feature, count(*) FILTER (WHERE sample = 'ref') AS n_ref, count(*) FILTER (WHERE sample = 'cur') AS n_cur
  FROM lg GROUP BY ticker, feature),
bn AS (SELECT lg.ticker, lg.feature, sample, CASE WHEN lo IS NULL OR value < lo THEN -1 WHEN value > hi THEN 10
    ELSE len(list_filter(edges, lambda e: e < value)) END AS bin
  FROM lg LEFT JOIN ed USING (ticker, feature) LEFT JOIN lim USING (ticker, feature)),
pq AS (SELECT ticker, feature, bin, count(*) FILTER (WHERE sample = 'ref') / nullif(any_value(n_ref), 0) AS p,
  count(*) FILTER (WHERE sample = 'cur') / nullif(any_value(n_cur), 0) AS q
  FROM bn JOIN sz USING (ticker, feature) GROUP BY ticker, feature, bin),
d AS (SELECT ticker, feature, sum((greatest(q, 0.0001) - greatest(p, 0.0001)) * ln(greatest(q, 0.0001) / greatest(p, 0.0001))) AS psi,
  sqrt(greatest(0.0, (sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0.0 END)
    + sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0.0 END)) / 2 / ln(2.0))) AS js_distance FROM pq GROUP BY ticker, feature),
w AS (SELECT ticker, feature, sum(gap * width) AS wasserstein FROM cdf GROUP BY ticker, feature)
SELECT ticker, feature, round(CASE WHEN ok THEN psi END, 6) AS psi, round(CASE WHEN ok THEN js_distance END, 6) AS js_distance,
  round(CASE WHEN ok THEN coalesce(wasserstein, 0.0) END, 6) AS wasserstein
FROM (SELECT *, n_ref > 0 AND n_cur > 0 AS ok FROM sz) JOIN d USING (ticker, feature) JOIN w USING (ticker, feature)""")
def q_psi_drift(spark, sf):
    """PSI / Jensen-Shannon on reference deciles with open ends, exact Wasserstein-1."""
    return dr.binned_drift(drift_input(spark, sf), FEATS)


@register("target_drift", f"""{DS}, {TGT}
SELECT ticker, n_ref, pos_ref, n_cur, pos_cur, round(z, 6) AS z, round(target_drift_score, 6) AS target_drift_score,
  coalesce(target_drift_score < 0.05, false) AS target_drift_detected,
  coalesce(target_drift_score > 0.3, false) AS target_drift_compat FROM td""")
def q_target_drift(spark, sf):
    """D3: two-proportion z-test on the up-label rate, ref vs cur."""
    return dr.target_drift(drift_input(spark, sf))


CHI_COLS = ["target", "dow"]


@register("chi2_drift", f"""{DS},
cl AS (SELECT ticker, sample, feature, category FROM (SELECT ticker, sample, CAST(target AS VARCHAR) AS target,
  CAST(isodow(Date) - 1 AS VARCHAR) AS dow FROM ds) UNPIVOT (category FOR feature IN (target, dow))),
cnt AS (SELECT ticker, feature, category, count(*) FILTER (WHERE sample = 'ref') AS a,
  count(*) FILTER (WHERE sample = 'cur') AS b FROM cl GROUP BY ticker, feature, category),
t AS (SELECT *, sum(a) OVER (PARTITION BY ticker, feature) AS na, sum(b) OVER (PARTITION BY ticker, feature) AS nb FROM cnt),
e AS (SELECT *, (a + b) * na / (na + nb) AS ea, (a + b) * nb / (na + nb) AS eb FROM t),
c AS (SELECT ticker, feature, sum(CASE WHEN ea <> 0 THEN (a - ea) ** 2 / ea END + CASE WHEN eb <> 0 THEN (b - eb) ** 2 / eb END) AS chi2,
  CAST(count(*) - 1 AS BIGINT) AS dof FROM e GROUP BY ticker, feature),
w AS (SELECT *, CASE WHEN dof < 1 OR chi2 <= 0 THEN 1.0 WHEN chi2 IS NOT NULL THEN greatest(1.0 - list_sum(list_transform(range(0, CAST(chi2 / 2 + 14 * sqrt(chi2 / 2) + dof + 60 AS BIGINT)),
    lambda j: exp((dof / 2.0 + j) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0 + j + 1)))), 0.0) END AS p_value FROM c)
SELECT ticker, feature, round(chi2, 6) AS chi2, dof, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM w""")
def q_chi2_drift(spark, sf):
    """Chi-square drift of categorical columns (label, weekday)."""
    ds = drift_input(spark, sf).withColumn("dow", F.weekday("Date"))
    return dr.chi2_drift(ds, CHI_COLS)


@register("dataset_drift", f"""{KS}, {DATA}
SELECT ticker, n_features, num_drifted_columns, drifted_columns, round(drift_share, 6) AS drift_share,
  drift_share >= 0.5 AS dataset_drift_detected FROM dd""")
def q_dataset_drift(spark, sf):
    """Share of drifted features per ticker."""
    return dr.dataset_drift(dr.ks_drift(drift_input(spark, sf), FEATS))


SUMMARY_SQL = f"""{KS}, {DATA}, {TGT},
sm AS (SELECT dd.ticker, td.n_ref AS reference_size, td.n_cur AS current_size, dd.n_features AS feature_count,
  dd.drift_share >= 0.5 AS dataset_drift_detected, dd.drift_share, dd.num_drifted_columns, dd.drifted_columns,
  coalesce(td.target_drift_score < 0.05, false) AS target_drift_detected, td.target_drift_score,
  coalesce(td.target_drift_score > 0.3, false) AS target_drift_compat, td.z
  FROM dd JOIN td ON dd.ticker = td.ticker)"""


@register("drift_autosplit", f"""{SUMMARY_SQL}
SELECT ticker, reference_size, current_size, feature_count, dataset_drift_detected, round(drift_share, 6) AS drift_share,
  num_drifted_columns, drifted_columns, target_drift_detected, round(target_drift_score, 6) AS target_drift_score,
  target_drift_compat, round(z, 6) AS z FROM sm""")
def q_drift_autosplit(spark, sf):
    """D8 + D6: 70/30 split per ticker, then the full drift summary."""
    return dr.drift_summary(drift_input(spark, sf), FEATS)


@register("drift_gate", f"""{SUMMARY_SQL}
SELECT ticker, round(drift_share, 6) AS drift_share, round(target_drift_score, 6) AS target_drift_score,
  drift_share > 0.5 OR target_drift_detected AS significant,
  target_drift_compat AS significant_compat FROM sm""")
def q_drift_gate(spark, sf):
    """Corrected significance gate and the reference's literal one."""
    ds = drift_input(spark, sf)
    data = dr.dataset_drift(dr.ks_drift(ds, FEATS))
    return dr.drift_gate(data, dr.target_drift(ds))


@register("drift_report_json")
def q_drift_report_json(spark, sf):
    """JSON drift report per ticker."""
    return dr.drift_report_json(dr.drift_summary(drift_input(spark, sf), FEATS))


REPORT_SCHEMA = """ticker array<string>, body struct<
  metadata: struct<reference_size: bigint, current_size: bigint, feature_count: bigint>,
  data_drift: struct<dataset_drift_detected: boolean, drift_share: double, num_drifted_columns: bigint, drifted_columns: array<string>>,
  target_drift: struct<target_drift_detected: boolean, target_drift_score: double>>"""


@register("drift_report_parsed", f"""{SUMMARY_SQL}
SELECT ticker, reference_size, current_size, feature_count, dataset_drift_detected, round(drift_share, 6) AS drift_share, num_drifted_columns,
  drifted_columns, target_drift_detected, round(target_drift_score, 6) AS target_drift_score FROM sm""")
def q_drift_report_parsed(spark, sf):
    """The JSON reports, written as text files, read back and parsed."""
    from tickerwise.sources import write_json_report
    from tickerwise.streaming.jobs import run_dir
    path = run_dir(spark, "drift-reports")
    reports = dr.drift_report_json(dr.drift_summary(drift_input(spark, sf), FEATS))
    keyed = reports.select(F.concat(F.lit('{"ticker":'), F.to_json(F.array("ticker")), F.lit(',"body":'), F.col("report"), F.lit("}")).alias("report"))
    write_json_report(keyed, path)
    doc = F.from_json("value", REPORT_SCHEMA)
    d = spark.read.text(path).select(doc.alias("d")).select(F.col("d.ticker")[0].alias("ticker"), "d.body.*")
    return d.select("ticker", "metadata.*", "data_drift.dataset_drift_detected", "data_drift.drift_share", "data_drift.num_drifted_columns",
                    F.array_join("data_drift.drifted_columns", ",").alias("drifted_columns"), "target_drift.*")
