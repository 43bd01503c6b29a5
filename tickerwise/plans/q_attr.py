"""Attribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerwise.functions.exprs import int_mix_sql
from tickerwise.operators import attribution as at
from tickerwise.operators import models as md
from tickerwise.plans.q_clean import split_features
from tickerwise.plans.q_model import BASE, FEATS
from tickerwise.plans import sql_blocks as S
from tickerwise.plans.registry import register
from tickerwise.sources import bars_daily

DAY = "datediff(Date, DATE'1970-01-01')"
MIX_SQL = int_mix_sql(["date_diff('day', DATE '1970-01-01', Date)", "Volume"])


def _with_key(df):
    return df.withColumn("_day", F.datediff("Date", F.lit("1970-01-01").cast("date"))).withColumn("_vol", F.col("Volume"))


@register("seeded_sample", f"""WITH bars AS ({S.BARS_DAILY})
SELECT ticker, Date, Close, Volume FROM bars ORDER BY {MIX_SQL}, ticker, Date LIMIT 100""")
def q_seeded_sample(spark, sf):
    """T5: 100 bars chosen by a seeded hash of (day, volume) — a sampling operator."""
    b = _with_key(bars_daily(spark, sf))
    return at.seeded_sample(b, 100, ["_day", "_vol"], ["ticker", "Date"]).select("ticker", "Date", "Close", "Volume")


def scaled_keyed(spark, sf):
    return md.standardize(_with_key(split_features(spark, sf)), FEATS)


def background(scaled):
    """100 standardized train rows by the seeded hash."""
    return at.seeded_sample(scaled.filter(F.col("split") == "train"), at.MAX_BACKGROUND, ["_day", "_vol"],
                            ["ticker", "Date"])


def contributions(spark, sf):
    sc = scaled_keyed(spark, sf)
    return at.linear_shap(sc, background(sc), FEATS)


BG_SQL = (f"bgk AS (SELECT sc.*, {MIX_SQL.replace('Volume', 'sp.Volume').replace('Date', 'sp.Date')} AS _h "
          f"FROM sc JOIN sp ON sc.ticker = sp.ticker AND sc.Date = sp.Date WHERE sc.split = 'train'), "
          f"bg AS (SELECT * FROM bgk ORDER BY _h, ticker, Date LIMIT 100), "
          "bgm AS (SELECT " + ", ".join(f"avg({f}) AS {f}__bg" for f in FEATS) + " FROM bg), "
          "bgb AS (SELECT *, " + f"CAST({md.LINEAR_INTERCEPT} AS DOUBLE)" + "".join(
              f" + CAST({md.LINEAR_WEIGHTS[f]} AS DOUBLE) * {f}__bg" for f in FEATS) + " AS base_value FROM bgm), "
          "ct AS (SELECT ticker, Date, base_value, feature, contribution FROM (SELECT sc.ticker, sc.Date, bgb.base_value, "
          + ", ".join(f"CAST({md.LINEAR_WEIGHTS[f]} AS DOUBLE) * (sc.{f} - bgb.{f}__bg) AS {f}" for f in FEATS)
          + f" FROM sc, bgb) UNPIVOT (contribution FOR feature IN ({', '.join(FEATS)})))")


@register("linear_shap", f"{BASE}, {BG_SQL} SELECT ticker, Date, round(base_value, 6) AS base_value, feature, "
          "round(contribution, 6) + 0.0 AS contribution FROM ct")
def q_linear_shap(spark, sf):
    """E2(a): exact Shapley contributions of the fixed linear model, log-odds."""
    return contributions(spark, sf)


@register("global_importance", f"""{BASE}, {BG_SQL}
SELECT feature, round(importance, 6) AS importance,
  CAST(row_number() OVER (ORDER BY importance DESC, feature) AS BIGINT) AS rank
FROM (SELECT feature, avg(abs(contribution)) AS importance FROM ct GROUP BY feature)""")
def q_global_importance(spark, sf):
    """Mean |phi| per feature, ranked."""
    return at.global_importance(contributions(spark, sf))


@register("local_ranking", f"""{BASE}, {BG_SQL}
SELECT ticker, Date, round(base_value, 6) AS base_value, feature, round(contribution, 6) + 0.0 AS contribution,
  CAST(row_number() OVER (PARTITION BY ticker, Date ORDER BY abs(contribution) DESC, feature) AS BIGINT) AS rank,
  CASE WHEN contribution > 0 THEN 'UP' ELSE 'DOWN' END AS direction FROM ct""")
def q_local_ranking(spark, sf):
    """Features of every row ranked by |phi|."""
    return at.local_ranking(contributions(spark, sf))


@register("perm_shap")
def q_perm_shap(spark, sf):
    """E2(b): permutation Shapley of P(up) for every row, 100-row background."""
    sc = scaled_keyed(spark, sf)
    return at.perm_shap(sc, background(sc), FEATS)


@register("perm_shap_sums", f"""{BASE} SELECT ticker, Date, round(probability, 6) AS prediction, round(probability, 6) AS explained,
  CAST({len(FEATS)} AS BIGINT) AS n_features FROM scored""")
def q_perm_shap_sums(spark, sf):
    """E2(b): contributions and base value of every row add up to its score."""
    sc = scaled_keyed(spark, sf)
    phi = at.perm_shap(sc, background(sc), FEATS)
    return phi.groupBy("ticker", "Date").agg(F.max("prediction").alias("prediction"),
                                             (F.sum("contribution") + F.max("base_value")).alias("explained"),
                                             F.count(F.lit(1)).alias("n_features"))
