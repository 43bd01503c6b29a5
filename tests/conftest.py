"""Shared fixtures: one local session and small bar tables built from literals."""

from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickerwise.schema import BAR_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickerwise.session import get_session
    s = get_session("local[4]", 8)
    yield s
    s.stop()


def weekdays(start: dt.date, n: int) -> list[dt.date]:
    out, d = [], start
    while len(out) < n:
        if d.weekday() < 5:
            out.append(d)
        d += dt.timedelta(days=1)
    return out


def bar_rows(closes, start=dt.date(2021, 1, 4), ticker="T1", volume=1_000_000, business=True):
    """Bars with the given closes; Open = Close - 1, High/Low bracket both."""
    dates = weekdays(start, len(closes)) if business else [start + dt.timedelta(days=i) for i in range(len(closes))]
    rows = []
    for d, c in zip(dates, closes):
        o = None if c is None else c - 1.0
        hi = None if c is None else max(o, c) + 2.0
        lo = None if c is None else min(o, c) - 2.0
        rows.append((ticker, d, o, hi, lo, c, volume))
    return rows


def bars_df(spark, rows):
    return spark.createDataFrame(rows, BAR_SCHEMA)


@pytest.fixture
def make_bars(spark):
    return lambda closes, **kw: bars_df(spark, bar_rows(closes, **kw))
