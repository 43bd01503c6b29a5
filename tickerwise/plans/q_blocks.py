"""Window operators in blocks of rows (P4, W5, W8, W10): the twins of the whole-ticker queries, with blocks far shorter than a ticker."""

from __future__ import annotations

from tickerwise.operators import blocks as bl
from tickerwise.operators import clean
from tickerwise.operators import features as feat
from tickerwise.plans import q_bars, q_clean  # noqa: F401 - register the SQL used here
from tickerwise.plans.registry import ORACLE_SQL, register
from tickerwise.schema import OHLCV
from tickerwise.sources import bars_daily, dirty_bars

ROWS = 200  # rows of a block in these queries; the operator's own default is 50,000


@register("features_blocked", ORACLE_SQL["features_full"], shared=True)
def q_features_blocked(spark, sf):
    """W1-W5 over blocks with a halo of 19 rows."""
    return bl.features_blocked(bars_daily(spark, sf), block=ROWS)


@register("fill_blocked", ORACLE_SQL["fill_ffill_bfill"], shared=True)
def q_fill_blocked(spark, sf):
    """P4 over blocks, the last known value carried from block to block."""
    return bl.fill_blocked(clean.dedup_keep_last(dirty_bars(spark, sf)), block=ROWS).select("ticker", "Date", "seq", *OHLCV)


@register("cumulative_return_blocked", ORACLE_SQL["cumulative_return"], shared=True)
def q_cumulative_return_blocked(spark, sf):
    """W8 over blocks, the running sum carried from block to block."""
    return bl.cumulative_return_blocked(bars_daily(spark, sf).select("ticker", "Date", "Close"), block=ROWS)


@register("split_blocked", ORACLE_SQL["temporal_split"], shared=True)
def q_split_blocked(spark, sf):
    """W10 by row numbers that no window spans a ticker for."""
    return bl.split_blocked(feat.features_full(bars_daily(spark, sf)), block=ROWS).select("ticker", "Date", "split")
