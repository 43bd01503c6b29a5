"""Cleaning and data-contract validation (P2-P6, V1-V10), one rule per test."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.operators import clean as cl
from tickerwise.operators import validate as va
from tickerwise.schema import BAR_SCHEMA

D0 = dt.date(2021, 1, 4)  # a Monday

GOOD = ("T", D0, 100.0, 105.0, 95.0, 102.0, 1000)


def row(**kw):
    base = dict(zip(["ticker", "Date", "Open", "High", "Low", "Close", "Volume"], GOOD))
    base.update(kw)
    return tuple(base[c] for c in ["ticker", "Date", "Open", "High", "Low", "Close", "Volume"])


def one(spark, **kw):
    return spark.createDataFrame([row(**kw)], BAR_SCHEMA)


@pytest.mark.parametrize("kw,rule", [
    (dict(Open=0.0), "negative_or_zero_prices"),
    (dict(Close=-1.0), "negative_or_zero_prices"),
    (dict(Volume=-5), "negative_volume"),
    (dict(High=90.0, Low=95.0), "high_less_than_low"),
    (dict(High=99.5), "high_less_than_open"),
    (dict(High=101.5, Open=100.0, Close=102.0), "high_less_than_close"),
    (dict(Low=101.0), "low_greater_than_open"),
    (dict(Low=99.0, Open=100.0, Close=98.0), "low_greater_than_close"),
    ({}, None),
])
def test_each_integrity_rule(spark, kw, rule):
    got = va.integrity_flags(one(spark, **kw)).first()["first_violation"]
    assert got == rule


def test_row_charged_to_first_rule_only(spark):
    # negative price AND high < low: counted once, under the first rule
    df = one(spark, Open=-1.0, High=90.0, Low=95.0)
    br = va.integrity_breakdown(df).collect()
    assert [(r["rule"], r["n_rows"]) for r in br] == [("negative_or_zero_prices", 1)]


def test_null_operands_never_violate(spark):
    df = one(spark, Close=None, High=None)
    assert va.integrity_flags(df).first()["first_violation"] is None
    assert va.integrity_filter(df).count() == 1


def test_nan_is_converted_to_null_before_rules(spark):
    # Q5: NaN > x is TRUE in Spark; after nan_to_null no rule fires on it
    df = cl.nan_to_null(one(spark, Low=float("nan")))
    assert df.first()["Low"] is None
    assert va.integrity_flags(df).first()["first_violation"] is None


def test_volume_zero_kept_by_validation_dropped_by_cleaning(spark):
    # Q19
    df = one(spark, Volume=0)
    assert va.integrity_filter(df).count() == 1
    assert cl.clean_bars(df, seq=None).count() == 0


def test_removal_gate_at_ten_percent(spark):
    def frame(n_bad, n):
        rows = [row(Date=D0 + dt.timedelta(days=i), Open=-1.0 if i < n_bad else 100.0) for i in range(n)]
        return spark.createDataFrame(rows, BAR_SCHEMA)
    at = va.integrity_gate(frame(10, 100)).first()
    over = va.integrity_gate(frame(15, 100)).first()
    assert at["removal_pct"] == pytest.approx(10.0) and at["passed"]
    assert over["removal_pct"] == pytest.approx(15.0) and not over["passed"]


def test_dedup_keeps_last_arrival(spark):
    schema = T.StructType(BAR_SCHEMA.fields + [T.StructField("seq", T.LongType())])
    rows = [row(Close=102.0) + (1,), row(Close=103.0) + (5,), row(Close=101.0) + (3,),
            row(Date=D0 + dt.timedelta(days=1)) + (2,)]
    out = cl.dedup_keep_last(spark.createDataFrame(rows, schema), "seq")
    got = {r["Date"]: r["Close"] for r in out.collect()}
    assert got == {D0: 103.0, D0 + dt.timedelta(days=1): 102.0}


def test_ffill_then_bfill(spark):
    rows = [row(Date=D0 + dt.timedelta(days=i), Close=c) for i, c in enumerate([None, None, 5.0, None, 7.0, None])]
    out = cl.fill_ffill_bfill(spark.createDataFrame(rows, BAR_SCHEMA))
    closes = [r["Close"] for r in out.orderBy("Date").collect()]
    assert closes == [5.0, 5.0, 5.0, 5.0, 7.0, 7.0]


def test_fill_none_option(spark):
    rows = [row(Date=D0 + dt.timedelta(days=i), Close=c) for i, c in enumerate([None, 5.0])]
    out = cl.clean_bars(spark.createDataFrame(rows, BAR_SCHEMA), seq=None, fill="none")
    assert [r["Close"] for r in out.orderBy("Date").collect()] == [None, 5.0]


def test_schema_missing_column_raises(spark):
    with pytest.raises(va.DataValidationError):
        va.validate_schema(one(spark).drop("Volume"))


def test_schema_string_dates_converted_or_rejected(spark):
    ok = one(spark).withColumn("Date", F.lit("2021-01-05"))
    assert isinstance(va.validate_schema(ok).schema["Date"].dataType, T.DateType)
    bad = one(spark).withColumn("Date", F.lit("not a date"))
    with pytest.raises(va.DataValidationError):
        va.validate_schema(bad)


def test_schema_non_numeric_price_rejected(spark):
    with pytest.raises(va.DataValidationError):
        va.validate_schema(one(spark).withColumn("Close", F.lit("x")))


def test_time_contract_duplicates_unsorted_weekend(spark):
    schema = T.StructType(BAR_SCHEMA.fields + [T.StructField("seq", T.LongType())])
    sat = dt.date(2021, 1, 9)
    rows = [row(Date=D0) + (1,), row(Date=D0) + (2,), row(Date=D0 + dt.timedelta(days=2)) + (3,),
            row(Date=D0 + dt.timedelta(days=1)) + (4,), row(Date=sat) + (5,)]
    r = va.time_contract(spark.createDataFrame(rows, schema)).first()
    assert r["n_duplicates"] == 1 and r["duplicate_examples"] == [D0]
    assert r["n_out_of_order"] == 1 and not r["is_sorted"]
    assert r["n_weekend"] == 1
    assert not r["passed"]


def test_time_contract_weekend_only_flags(spark):
    rows = [row(Date=dt.date(2021, 1, 8)), row(Date=dt.date(2021, 1, 9))]
    r = va.time_contract(spark.createDataFrame(rows, BAR_SCHEMA), seq=None).first()
    assert r["n_weekend"] == 1 and r["passed"]


def test_missing_counts_and_strict_validator(spark):
    rows = [row(Date=D0), row(Date=D0 + dt.timedelta(days=1), Close=None)]
    df = spark.createDataFrame(rows, BAR_SCHEMA)
    m = {r["column"]: r["n_missing"] for r in va.missing_counts(df).collect()}
    assert m == {"Open": 0, "High": 0, "Low": 0, "Close": 1, "Volume": 0}
    with pytest.raises(va.DataValidationError, match="missing"):
        va.validate_bars_strict(df, seq=None)


def test_validator_stats_and_breakdown(spark):
    rows = [row(Date=D0 + dt.timedelta(days=i), Close=100.0 + 0.5 * i) for i in range(9)] + \
        [row(Date=D0 + dt.timedelta(days=20), Volume=-1)]
    valid, stats = va.validate_bars(spark.createDataFrame(rows, BAR_SCHEMA), seq=None)
    s = stats.first()
    assert valid.count() == 9
    assert s["rows_before"] == 10 and s["rows_removed"] == 1 and s["total_rows"] == 9
    assert s["invalid_row_breakdown"] == {"negative_volume": 1}
    assert s["close_min"] == 100.0 and s["close_max"] == 104.0
    assert s["close_std"] == pytest.approx(1.3693063938)
    assert s["passed"]  # 10 % removed is still within the gate


@pytest.mark.parametrize("removed,before,grade", [(0, 100, "EXCELLENT"), (4, 100, "ACCEPTABLE"),
                                                  (5, 100, "NEEDS REVIEW")])
def test_quality_grade(spark, removed, before, grade):
    got = spark.range(1).select(va.quality_grade(F.lit(removed), F.lit(before)).alias("g")).first()["g"]
    assert got == grade


def test_freshness(spark):
    df = spark.createDataFrame([row(Date=D0)], BAR_SCHEMA)
    r = va.freshness(df, F.lit(D0 + dt.timedelta(days=8))).first()
    assert r["age_days"] == 8 and r["stale"]


def test_union_of_reused_shuffle_keeps_one_row_per_ticker(spark, tmp_path):
    """Regression: bars read from Parquet, self-union (re-sent rows), windows, then per-ticker joins.

    With spark.sql.unionOutputPartitioning on, this plan returned two rows per
    ticker on collect(); the session guard turns it off.
    """
    from tickerwise.session import apply_safe_conf
    from tickerwise.sources import tables
    apply_safe_conf(spark)
    path = str(tmp_path / "bars")
    tables.derive_bars_daily(spark, "/root/testdata/sf0.001").write.parquet(path)
    bars = spark.read.parquet(path)
    w = __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("ticker").orderBy("Date")
    b = bars.withColumn("seq", F.row_number().over(w).cast("bigint") * 2)
    dirty = b.unionByName(b.filter(F.col("seq") % 146 == 0).withColumn("seq", F.col("seq") + 1))
    c = cl.clean_bars(dirty)
    j = va.bar_summary(va.integrity_filter(c)).join(va.integrity_gate(c), "ticker")
    rows = j.collect()
    assert len(rows) == len({r["ticker"] for r in rows}) == bars.select("ticker").distinct().count()
