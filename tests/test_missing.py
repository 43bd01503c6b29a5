"""A NaN cell is a missing cell: every check gives for NaN what it gives for NULL."""

from __future__ import annotations

import pytest

from tests.conftest import bar_rows, bars_df
from tickerwise.operators import clean, feasibility, features, serving, validate
from tickerwise.schema import OHLCV

NAN = float("nan")


def holey(spark, hole):
    """Two tickers: T1 has holes in all price columns, T2 has no price at all."""
    rows = []
    for ticker in ("T1", "T2"):
        for i, r in enumerate(bar_rows([100.0 + (7 * i) % 11 for i in range(130)], ticker=ticker)):
            r = list(r)
            for j in range(2, 6):
                if ticker == "T2" or (i + j) % 9 == 0:
                    r[j] = hole
            rows.append(tuple(r))
    return bars_df(spark, rows)


def table(df):
    text = [str(sorted(r.asDict(recursive=True).items(), key=str)) for r in df.collect()]
    assert not any("nan" in t for t in text)
    return sorted(text)


CHECKS = {
    "integrity_filter": validate.integrity_filter,
    "integrity_breakdown": validate.integrity_breakdown,
    "integrity_gate": validate.integrity_gate,
    "missing_counts": validate.missing_counts,
    "bar_summary": validate.bar_summary,
    "validated rows": lambda d: validate.validate_bars(d, seq=None)[0],
    "validation stats": lambda d: validate.validate_bars(d, seq=None)[1],
    "completeness": feasibility.completeness,
    "outliers": feasibility.outliers,
    "outlier_rows": lambda d: feasibility.outlier_rows(d, z_max=1.0),
    "feasibility_report": lambda d: feasibility.feasibility_report(features.add_target(d)),
    "source_acceptance": lambda d: serving.source_acceptance(d, "primary"),
    "fill": clean.fill_ffill_bfill,
    "clean_bars": lambda d: clean.clean_bars(d, seq=None),
    "features_full": features.features_full,
    "warmup_dropped": features.warmup_dropped,
}


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_nan_counts_as_null(spark, name):
    got, want = table(CHECKS[name](holey(spark, NAN))), table(CHECKS[name](holey(spark, None)))
    assert got == want


def test_nan_cells_are_missing_and_break_no_rule(spark):
    rows = [("T", r[1], r[2], r[3], r[4], NAN, r[6]) for r in bar_rows([10.0] * 5, ticker="T")]
    df = bars_df(spark, rows)
    assert [r.first_violation for r in validate.integrity_flags(df).collect()] == [None] * 5
    missing = {r["column"]: (r.n_missing, r.passed) for r in validate.missing_counts(df).collect()}
    assert missing["Close"] == (5, False) and all(missing[c] == (0, True) for c in OHLCV if c != "Close")
    done = feasibility.completeness(df).first()
    assert (done.missing_cells, done.completeness_pct, done.passed) == (5, 80.0, False)
    empty = bars_df(spark, [("T", r[1], NAN, NAN, NAN, NAN, None) for r in bar_rows([10.0] * 3, ticker="T")])
    assert not serving.source_acceptance(empty, "primary").first().accepted


def test_nan_to_null_keeps_types_and_other_columns(spark):
    df = spark.createDataFrame([(1, 1.5, 2.5, "x"), (2, NAN, NAN, None)], "i int, d double, f float, s string")
    out = clean.nan_to_null(df)
    assert out.dtypes == df.dtypes and [tuple(r) for r in out.collect()] == [(1, 1.5, 2.5, "x"), (2, None, None, None)]
    assert clean.nan_to_null(df.select("i", "s")).columns == ["i", "s"]
