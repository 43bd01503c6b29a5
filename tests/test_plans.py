"""Plan-shape checks: pushdown, pruning, shared window exchange, one scan per fan-out query."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def lineitem_scans(plan: str) -> list[str]:
    return [ln for ln in plan.split("\n") if "FileScan parquet" in ln and "lineitem.parquet" in ln]


def test_lookback_filter_reaches_the_scan(spark):
    plan = executed(E.queries()["lookback_scan"](spark, SF_SMALL))
    scans = lineitem_scans(plan)
    assert len(scans) == 1
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", scans[0])
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(l_shipdate", scans[0])


def test_bar_scan_reads_only_needed_columns(spark):
    plan = executed(E.queries()["bars_daily"](spark, SF_SMALL))
    read = re.search(r"FileScan parquet \[([^\]]*)\]", lineitem_scans(plan)[0]).group(1)
    cols = {c.split("#")[0] for c in read.split(",")}
    assert cols == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_shipdate"}


def test_feature_windows_share_one_exchange(spark):
    from tickerwise.operators.features import features_full
    df = spark.read.parquet(f"{SF_SMALL}/part.parquet")  # any small table to get a session warm
    assert df.count() > 0
    bars = E.queries()["bars_daily"](spark, SF_SMALL)
    out = features_full(bars)
    plan = out._jdf.queryExecution().executedPlan().toString()
    window_exchanges = re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", plan)
    assert len(window_exchanges) == 1          # returns, 3 means, 3 volatilities, target: one shuffle
    assert plan.count("Window [") >= 3


@pytest.mark.parametrize("name", ["retrain_gate", "baseline_comparison", "feasibility_report", "validation_stats"])
def test_fanout_query_scans_lineitem_once(spark, name):
    from tickerwise.sources import reuse as R
    calls = []
    orig = R.materialize
    R.materialize = lambda df, n: calls.append(n) or orig(df, n)
    try:
        df = E.queries()[name](spark, SF_SMALL)
    finally:
        R.materialize = orig
    assert calls.count("bars_daily") == 1
    assert lineitem_scans(executed(df)) == []  # every branch reads the written bar table


def test_bucketed_inputs_join_without_exchange(spark, tmp_path):
    from tickerwise.sources.bucketed import bars_daily_bucketed, write_bucketed_inputs
    from tickerwise.sources.tables import derive_bars_daily
    li, part = write_bucketed_inputs(spark, SF_SMALL, str(tmp_path / "tables"), buckets=8, prefix="t_bucket")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the large-table (sort-merge) plan
    try:
        df = bars_daily_bucketed(spark, li, part)
        plan = executed(df)
        join_part = plan[plan.index("SortMergeJoin"):]
        below_join = join_part.split("\n", 1)[1]
        assert "Exchange" not in below_join.split("FileScan")[0]        # left input: no shuffle before the scan
        assert plan.count("Exchange hashpartitioning(l_partkey") == 0
        assert plan.count("Exchange hashpartitioning(p_partkey") == 0
        got = sorted(map(tuple, df.collect()))
        want = sorted(map(tuple, derive_bars_daily(spark, SF_SMALL).collect()))
        assert got == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
