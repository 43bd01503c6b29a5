"""Property test: Spark rolling features equal an independent pandas computation on random series."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickerwise.operators import features as feat
from tickerwise.schema import BAR_SCHEMA

closes = st.lists(st.one_of(st.none(), st.floats(min_value=1.0, max_value=1000.0, allow_nan=False)),
                  min_size=1, max_size=45)


def pandas_features(cl: list) -> pd.DataFrame:
    s = pd.Series(cl, dtype="float64")
    padded = s.ffill()
    ret = padded / padded.shift(1) - 1.0
    out = pd.DataFrame({"returns": ret})
    for n in (5, 10, 20):
        out[f"ma_{n}"] = s.rolling(n, min_periods=n).mean()
        out[f"volatility_{n}"] = ret.rolling(n, min_periods=n).std(ddof=1)
    nxt = s.shift(-1)
    out["target"] = (nxt > s).astype(int)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=closes, b=closes)
def test_features_match_pandas(spark, a, b):
    rows = []
    for t, series in (("A", a), ("B", b)):
        for i, c in enumerate(series):
            d = dt.date(2020, 1, 1) + dt.timedelta(days=3 * i)   # gaps do not matter: frames are rows
            rows.append((t, d, c, c, c, c, 10))
    df = spark.createDataFrame(rows, BAR_SCHEMA)
    got = feat.add_all_features(df).toPandas().sort_values(["ticker", "Date"])
    for t, series in (("A", a), ("B", b)):
        want = pandas_features(series)
        have = got[got.ticker == t].reset_index(drop=True)
        for c in want.columns:
            w = want[c].to_numpy(dtype="float64")
            h = have[c].to_numpy(dtype="float64")
            assert np.array_equal(np.isnan(w), np.isnan(h)), (t, c, w, h)
            assert np.allclose(w[~np.isnan(w)], h[~np.isnan(h)], rtol=1e-9, atol=1e-12), (t, c)
