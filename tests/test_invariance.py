"""Results must not depend on partitioning: same rows with 3 and 17 shuffle partitions."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

NAMES = ["dedup_keep_last", "validation_stats", "feasibility_report", "ks_drift", "asof_features",
         "seeded_sample", "baseline_stratified", "time_contract", "local_ranking", "stream_dedup", "stream_dedup_last", "stream_features", "stream_bars", "stream_online_snapshot",
         "score_requests", "ticker_predictions", "model_report"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_any_partition_count(spark, name):
    conf = spark.conf
    saved = {k: conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        results = []
        for n in (3, 17):
            conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(rows(E.queries()[name](spark, SF_SMALL)))
        assert results[0] == results[1]
        assert len(results[0]) > 0
    finally:
        for k, v in saved.items():
            conf.set(k, v)
