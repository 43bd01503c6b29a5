"""Drift (D1-D8) including the reference's golden 7-vs-3 report."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerwise.operators import drift as dr

# ---- fixed values: the reference's drift input pair (7 reference + 3 current rows) ----
COLS = ["Date", "Open", "High", "Low", "Close", "Volume", "returns", "ma_5", "ma_10", "ma_20",
        "volatility_5", "volatility_10", "volatility_20", "target"]
REF = [
    ("2021-03-01", 34650.0, 34800.0, 34600.0, 34750.0, 23900000, 0.0028860028860029, 34550.0, 34300.0, 33792.5, 1.3323138896449182e-05, 2.5889269215268983e-05, 0.0016438814887115, 1),
    ("2021-03-02", 34750.0, 34900.0, 34700.0, 34850.0, 21400000, 0.0028776978417266, 34650.0, 34400.0, 33892.5, 1.324612404893652e-05, 2.573850855795902e-05, 0.0014843227925906, 1),
    ("2021-03-03", 34850.0, 35000.0, 34800.0, 34950.0, 22800000, 0.0028694404591105, 34750.0, 34500.0, 34000.0, 1.3169775064334675e-05, 2.558906102638376e-05, 0.0010465935822309, 1),
    ("2021-03-04", 34950.0, 35100.0, 34900.0, 35050.0, 24100000, 0.0028612303290413, 34850.0, 34600.0, 34100.0, 1.309408428876802e-05, 2.544091141418208e-05, 5.120943478245225e-05, 1),
    ("2021-03-05", 35050.0, 35200.0, 35000.0, 35150.0, 22300000, 0.0028530670470756, 34950.0, 34700.0, 34200.0, 1.3019044177657313e-05, 2.529404473441628e-05, 5.0909338547830005e-05, 1),
    ("2021-03-08", 35150.0, 35300.0, 35100.0, 35250.0, 21700000, 0.0028449502133711, 35050.0, 34800.0, 34300.0, 1.2944647294631308e-05, 2.5148446215963525e-05, 5.0611873073833655e-05, 1),
    ("2021-03-09", 35250.0, 35400.0, 35200.0, 35350.0, 23100000, 0.0028368794326241, 35150.0, 34900.0, 34400.0, 1.287088630896486e-05, 2.5004101299585283e-05, 5.031700769404475e-05, 1),
]
CUR = [
    ("2021-03-10", 35350.0, 35500.0, 35300.0, 35450.0, 24500000, 0.0028288543140029, 35250.0, 35000.0, 34500.0, 1.2797753994172846e-05, 2.48609956344494e-05, 5.002471218770623e-05, 1),
    ("2021-03-11", 35450.0, 35600.0, 35400.0, 35550.0, 22600000, 0.002820874471086, 35350.0, 35100.0, 34600.0, 1.2725243226291077e-05, 2.471911507455645e-05, 4.973495677196313e-05, 1),
    ("2021-03-12", 35550.0, 35700.0, 35500.0, 35650.0, 21900000, 0.0028129395218001, 35450.0, 35200.0, 34700.0, 1.2653346981698505e-05, 2.4578445675063336e-05, 4.9447712094228137e-05, 0),
]
GOLDEN_TARGET_P = 0.10736446520661458
GOLDEN_Z = 1.610153
# ---- end of fixed values ----


@pytest.fixture
def pair(spark):
    rows = [("BBCA", "ref", *r) for r in REF] + [("BBCA", "cur", *r) for r in CUR]
    df = spark.createDataFrame(rows, ["ticker", "sample", *COLS])
    return df.withColumn("Date", F.to_date("Date")).withColumn("Volume", F.col("Volume").cast("bigint")) \
        .withColumn("target", F.col("target").cast("int"))


def test_ks_statistics_on_golden_pair(pair):
    feats = dr.drift_features(pair)
    assert len(feats) == 12 and "Date" not in feats and "target" not in feats  # Q8
    ks = {r["feature"]: r for r in dr.ks_drift(pair, feats).collect()}
    for f in feats:
        if f == "Volume":
            assert ks[f]["ks_stat"] == pytest.approx(1 / 3)
            assert not ks[f]["drifted"]
        else:
            assert ks[f]["ks_stat"] == pytest.approx(1.0)
            assert ks[f]["drifted"]
            assert ks[f]["p_value"] == pytest.approx(0.0089, abs=1e-3)
    assert ks["Volume"]["p_value"] == pytest.approx(0.924, abs=2e-3)


def test_target_two_proportion_z(pair):
    t = dr.target_drift(pair).first()
    assert t["z"] == pytest.approx(GOLDEN_Z, abs=1e-6)
    assert t["target_drift_score"] == pytest.approx(GOLDEN_TARGET_P, abs=1e-6)
    assert not t["target_drift_detected"]      # p >= 0.05
    assert not t["target_drift_compat"]        # literal gate: 0.107 > 0.3 is false


def test_dataset_drift_true_share_and_list(pair):
    s = dr.drift_summary(pair).first()
    assert s["reference_size"] == 7 and s["current_size"] == 3 and s["feature_count"] == 12
    assert s["num_drifted_columns"] == 11  # Q7: the true count, not an echoed threshold
    assert s["drift_share"] == pytest.approx(11 / 12)
    assert s["dataset_drift_detected"]
    assert "Volume" not in s["drifted_columns"].split(",") and "Close" in s["drifted_columns"].split(",")
    g = dr.drift_gate(dr.dataset_drift(dr.ks_drift(pair, dr.drift_features(pair))), dr.target_drift(pair)).first()
    assert g["significant"] and not g["significant_compat"]  # the literal data leg compares a threshold with itself


def test_report_json_layout(pair):
    import json
    doc = json.loads(dr.drift_report_json(dr.drift_summary(pair)).first()["report"])
    assert set(doc) == {"metadata", "data_drift", "target_drift"}
    assert doc["metadata"] == {"reference_size": 7, "current_size": 3, "feature_count": 12}
    assert len(doc["data_drift"]["drifted_columns"]) == 11


def test_no_drift_identical_samples(spark):
    rows = [("T", s, float(i % 7), i % 2) for s in ("ref", "cur") for i in range(60)]
    df = spark.createDataFrame(rows, ["ticker", "sample", "x", "target"])
    ks = dr.ks_drift(df, ["x"]).first()
    assert ks["ks_stat"] == 0.0 and ks["p_value"] == 1.0 and not ks["drifted"]
    t = dr.target_drift(df).first()
    assert t["z"] == 0.0 and t["target_drift_score"] == pytest.approx(1.0, abs=1e-6)


def test_binned_drift_zero_on_identical(spark):
    rows = [("T", s, float(i % 13)) for s in ("ref", "cur") for i in range(130)]
    df = spark.createDataFrame(rows, ["ticker", "sample", "x"])
    b = dr.binned_drift(df, ["x"]).first()
    assert b["psi"] == pytest.approx(0.0, abs=1e-12)


def _pairs(spark, ref, cur, ticker="T"):
    rows = [(ticker, "ref", float(v), 1) for v in ref] + [(ticker, "cur", float(v), 0) for v in cur]
    return spark.createDataFrame(rows, "ticker string, sample string, x double, target int")


@pytest.mark.parametrize("ref,cur,want", [([0.0] * 99 + [10.0], [10.0] * 100, 9.9), ([0.0, 1.0, 2.0], [1000.0, 1001.0, 1002.0], 1000.0),
                                          ([0, 1, 3], [5, 6, 8], 5.0), ([1.0, 1.0], [1.0], 0.0)])
def test_wasserstein_is_exact(spark, ref, cur, want):
    assert dr.binned_drift(_pairs(spark, ref, cur), ["x"]).first()["wasserstein"] == pytest.approx(want)


def test_psi_counts_values_outside_the_reference_apart(spark):
    import math
    b = dr.binned_drift(_pairs(spark, range(1, 11), [-5, 100, 100, 4]), ["x"]).first()
    shares = {k: (0.1, 0.25 if k == 3 else 1e-4) for k in range(10)} | {-1: (1e-4, 0.25), 10: (1e-4, 0.5)}
    seen = {k: v for k, v in shares.items()}
    assert b["psi"] == pytest.approx(sum((q - p) * math.log(q / p) for p, q in seen.values()))


def test_groups_without_one_sample_stay(spark):
    df = _pairs(spark, range(20), range(5, 25)).unionByName(_pairs(spark, [], [3], "OnlyCur")).unionByName(_pairs(spark, [1, 2], [], "OnlyRef"))
    for out in (dr.ks_drift(df, ["x"]), dr.binned_drift(df, ["x"]), dr.target_drift(df), dr.drift_summary(df, ["x"])):
        assert {r["ticker"] for r in out.collect()} == {"T", "OnlyCur", "OnlyRef"}
    ks = {r["ticker"]: r for r in dr.ks_drift(df, ["x"]).collect()}
    assert ks["T"]["ks_stat"] == pytest.approx(0.25) and ks["OnlyCur"]["ks_stat"] is None and not ks["OnlyCur"]["drifted"]
    assert (ks["OnlyCur"]["n_ref"], ks["OnlyCur"]["n_cur"], ks["OnlyRef"]["n_cur"]) == (0, 1, 0)
    w = {r["ticker"]: r for r in dr.binned_drift(df, ["x"]).collect()}
    assert w["OnlyCur"]["wasserstein"] is None and w["OnlyRef"]["psi"] is None


def test_chi2_drift_detects_shift(spark):
    rows = [("T", "ref", "a")] * 50 + [("T", "ref", "b")] * 50 + [("T", "cur", "a")] * 90 + [("T", "cur", "b")] * 10
    df = spark.createDataFrame(rows, ["ticker", "sample", "c"])
    r = dr.chi2_drift(df, ["c"]).first()
    assert r["dof"] == 1 and r["drifted"] and r["chi2"] > 30


def test_autosplit_70_30(make_bars):
    df = dr.autosplit(make_bars([float(i) for i in range(10)]))
    got = [r["sample"] for r in df.orderBy("Date").collect()]
    assert got == ["ref"] * 7 + ["cur"] * 3
    assert dt.date(2021, 1, 4) in [r["Date"] for r in df.filter("sample = 'ref'").collect()]


@pytest.mark.parametrize("bins", [1, 3, 64, 1000])
def test_ks_exact_for_any_bin_count(spark, bins):
    # clustered values: most mass in a narrow range plus far outliers, unequal sample sizes
    vals_ref = [0.001 * (i % 50) for i in range(400)] + [1000.0, -500.0]
    vals_cur = [0.001 * (i % 37) + 0.0005 for i in range(150)] + [999.0]
    rows = [("T", "ref", v) for v in vals_ref] + [("T", "cur", v) for v in vals_cur]
    df = spark.createDataFrame(rows, ["ticker", "sample", "x"])
    got = dr.ks_drift(df, ["x"], bins=bins).first()["ks_stat"]
    # brute force over every distinct value
    grid = sorted(set(vals_ref) | set(vals_cur))
    want = max(abs(sum(v <= g for v in vals_ref) / len(vals_ref) - sum(v <= g for v in vals_cur) / len(vals_cur))
               for g in grid)
    assert got == pytest.approx(want, abs=1e-12)
