"""Blocks of rows give what whole-ticker windows give, also with one ticker holding all rows."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tickerwise.operators import blocks as bl
from tickerwise.operators import clean
from tickerwise.operators import features as feat

SCHEMA = "ticker string, Date date, Open double, High double, Low double, Close double, Volume long"


def long_bars(spark, tickers=(("HOT", 700), ("B", 45), ("C", 1), (None, 30))):
    rng, rows = random.Random(3), []
    for t, n in tickers:
        for i in range(n):
            c = None if rng.random() < 0.08 or 90 < i < 160 else float("nan") if rng.random() < 0.03 else 0.0 if rng.random() < 0.01 else 50 + rng.random()
            rows.append((t, dt.date(2000, 1, 1) + dt.timedelta(days=i), *(None if i < 3 else 40 + rng.random() for _ in range(3)), c, rng.choice([None, 5, 9])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


def rounded(df):
    def cell(x):
        return None if isinstance(x, float) and math.isnan(x) else round(x, 9) if isinstance(x, float) else x
    return sorted((tuple(cell(x) for x in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [20, 64, 50_000])
def test_features_equal_whole_ticker_windows(spark, block):
    bars = long_bars(spark)
    got, want = bl.features_blocked(bars, block=block), feat.features_full(bars)
    assert got.columns == want.columns and rounded(got) == rounded(want) and got.count() > 40


@pytest.mark.parametrize("block", [20, 64])
def test_scans_equal_whole_ticker_windows(spark, block):
    bars = clean.nan_to_null(long_bars(spark))
    assert rounded(bl.fill_blocked(bars, block=block)) == rounded(clean.fill_ffill_bfill(bars))
    closes = bars.select("ticker", "Date", "Close")
    assert rounded(bl.cumulative_return_blocked(closes, block=block)) == rounded(feat.cumulative_return(closes))
    assert rounded(bl.split_blocked(closes, block=block)) == rounded(feat.temporal_split(closes))


def test_row_numbers_and_blocks(spark):
    rows = bl.numbered(long_bars(spark), block=50).select("ticker", "Date", "_pos", "_b").collect()
    for t in ("HOT", "B", "C", None):
        mine = sorted((r.Date, r["_pos"], r["_b"]) for r in rows if r.ticker == t)
        assert [p for _, p, _ in mine] == list(range(len(mine))) and all(b == p // 50 for _, p, b in mine)
    with pytest.raises(ValueError):
        bl.features_blocked(long_bars(spark), block=19)
    assert bl.features_blocked(long_bars(spark).where("false")).count() == 0


def test_no_window_spans_a_ticker(spark):
    """One ticker holds all rows: every window of the last step is keyed by the block as well, and no group is larger than a block and its halo."""
    bars = long_bars(spark, (("HOT", 3000),))
    out = bl.features_blocked(bars, block=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    specs = [line for line in plan.splitlines() if "Window " in line and "windowspecdefinition" in line]
    assert specs and all("windowspecdefinition(_cell" in s and "windowspecdefinition(ticker" not in s for s in specs)
    numbered = bl.numbered(bars, block=100)
    assert numbered.groupBy("ticker", "_b").count().agg(F.max("count")).first()[0] == 100
