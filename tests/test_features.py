"""Rolling features, next-bar label, split (W1-W10) on hand-built bars."""

from __future__ import annotations

import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from tickerwise.operators import features as feat
from tickerwise.schema import BAR_SCHEMA


def by_date(df, *cols):
    return [tuple(r) for r in df.orderBy("ticker", "Date").select(*cols).collect()]


def test_rolling_mean_uses_past_rows_only(make_bars):
    # Close = 0..49; ma_5 at row 10 is mean(Close[6..10]) = 8.0
    df = feat.add_rolling_means(make_bars([float(i) for i in range(50)]))
    ma5 = [r[0] for r in by_date(df, "ma_5")]
    assert ma5[:4] == [None] * 4
    assert ma5[10] == pytest.approx(8.0)
    ma20 = [r[0] for r in by_date(df, "ma_20")]
    assert ma20[18] is None and ma20[19] == pytest.approx(9.5)


def test_target_label_last_row_zero_and_drop_option(make_bars):
    # labels 1,0,1,0,1,0,1,0,1 and the last row 0 (code behaviour, Q1)
    closes = [100, 101, 99, 102, 98, 103, 97, 104, 96, 105]
    df = make_bars([float(c) for c in closes])
    got = [r[0] for r in by_date(feat.add_target(df), "target")]
    assert got == [1, 0, 1, 0, 1, 0, 1, 0, 1, 0]
    dropped = feat.add_target(df, drop_unlabeled=True)
    assert dropped.count() == 9


def test_equal_close_is_not_up(make_bars):
    got = [r[0] for r in by_date(feat.add_target(make_bars([5.0, 5.0, 6.0])), "target")]
    assert got == [0, 1, 0]


def test_returns_first_null_and_zero_base_null(make_bars):
    df = feat.add_returns(make_bars([10.0, 11.0, 0.0, 5.0]))
    r = [x[0] for x in by_date(df, "returns")]
    assert r[0] is None
    assert r[1] == pytest.approx(0.1)
    assert r[2] == pytest.approx(-1.0)
    assert r[3] is None  # division by a zero close is NULL, not inf


def test_returns_pad_missing_close(make_bars):
    # Q17: a missing close is padded before the return, so the next return spans the gap
    df = feat.add_returns(make_bars([10.0, None, 12.0]))
    r = [x[0] for x in by_date(df, "returns")]
    assert r[1] == pytest.approx(0.0) and r[2] == pytest.approx(0.2)


def test_volatility_needs_n_returns(make_bars):
    closes = [100.0 * (1.01 ** i) * (1 + 0.01 * (-1) ** i) for i in range(30)]
    df = feat.add_rolling_volatility(make_bars(closes))
    rows = by_date(df, "returns", "volatility_5")
    vol = [v for _, v in rows]
    assert vol[:5] == [None] * 5  # first value at row 5 (0-based): needs 5 non-null returns
    rets = [r for r, _ in rows]
    assert vol[5] == pytest.approx(statistics.stdev(rets[1:6]))


def test_features_full_drops_warmup_per_ticker(spark):
    from tests.conftest import bar_rows
    rows = bar_rows([float(100 + i % 7) for i in range(40)], ticker="A") + \
        bar_rows([float(50 + i % 5) for i in range(30)], ticker="B")
    df = spark.createDataFrame(rows, BAR_SCHEMA)
    out = feat.features_full(df)
    counts = {r["ticker"]: r["count"] for r in out.groupBy("ticker").count().collect()}
    assert counts == {"A": 20, "B": 10}
    assert set(out.columns) >= {"returns", "ma_5", "ma_10", "ma_20", "volatility_5", "volatility_10",
                                "volatility_20", "target"}


def test_no_lookahead_appending_future_bar(spark):
    from tests.conftest import bar_rows
    base = bar_rows([100.0 + math.sin(i) * 3 for i in range(40)])
    next_day = base[-1][1] + dt.timedelta(days=1)
    extra = list(base) + [("T1", next_day, 199.0, 205.0, 195.0, 200.0, 1)]
    cols = ["Date", "returns", "ma_5", "ma_20", "volatility_20"]
    a = by_date(feat.add_all_features(spark.createDataFrame(base, BAR_SCHEMA)), *cols)
    b = by_date(feat.add_all_features(spark.createDataFrame(extra, BAR_SCHEMA)), *cols)
    # every earlier feature is unchanged (the label of the old last bar may change)
    assert b[:len(a)] == a


def test_partitioning_does_not_change_result(spark):
    from tests.conftest import bar_rows
    rows = []
    for t in range(6):
        rows += bar_rows([float(10 + (i * (t + 3)) % 11) for i in range(45)], ticker=f"T{t}")
    df = spark.createDataFrame(rows, BAR_SCHEMA)
    one = feat.features_full(df.coalesce(1))
    many = feat.features_full(df.repartition(7, F.rand(seed=1)).sortWithinPartitions(F.rand(seed=2)))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


@pytest.mark.parametrize("n,ratio,expected", [(10, 0.8, 8), (10, 0.7, 7), (3, 0.8, 2), (480, 0.8, 384), (1, 0.8, 0)])
def test_temporal_split_truncates_like_int(make_bars, n, ratio, expected):
    df = feat.temporal_split(make_bars([float(i + 1) for i in range(n)]), ratio)
    rows = by_date(df, "split")
    assert sum(1 for r in rows if r[0] == "train") == expected == int(n * ratio)
    # chronological: every train date precedes every test date
    assert [r[0] for r in rows] == ["train"] * expected + ["test"] * (n - expected)


def test_cumulative_return(make_bars):
    df = feat.cumulative_return(make_bars([100.0, 110.0, 99.0]))
    cum = [r[0] for r in by_date(df, "cum_return")]
    assert cum == pytest.approx([0.0, 0.1, -0.01])


def test_head_tail(make_bars):
    ht = feat.head_tail(make_bars([float(i) for i in range(12)]), 5)
    assert ht.filter("part = 'head'").count() == 5 and ht.filter("part = 'tail'").count() == 5
    first = ht.filter("part = 'head' AND pos = 1").first()
    last = ht.filter("part = 'tail' AND pos = 1").first()
    assert first["Close"] == 0.0 and last["Close"] == 11.0
