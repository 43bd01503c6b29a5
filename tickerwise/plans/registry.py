"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` plus SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickerwise.functions.exprs import round_doubles
from tickerwise.session import apply_safe_conf
from tickerwise.sources.reuse import shared_inputs

# Queries whose plan reads the derived bars in more than one branch (self-union,
# per-check aggregates joined back, train/test legs, baselines, or a driver-side
# scalar followed by the main plan).  They derive the bars once per run; the
# rest read lineitem once anyway and skip the extra write.
FANOUT = frozenset("""
head_tail dedup_keep_last fill_ffill_bfill clean_bars time_contract integrity_filter integrity_breakdown
integrity_gate integrity_gate_heavy missing_counts validated_bars validation_stats quality_grade quality_report
freshness feasibility_report feasibility_verdict trading_calendar missing_days standardize score_linear
confusion_matrix classification_metrics classification_report baseline_majority baseline_stratified
baseline_comparison class_imbalance metric_compare retrain_gate prediction_diff lr_predictions gbt_predictions
reproducibility model_report score_requests ticker_predictions ks_drift dataset_drift psi_drift drift_autosplit drift_gate drift_report_json source_acceptance
source_fallback online_snapshot online_lookup online_misses linear_shap global_importance local_ranking perm_shap perm_shap_sums drift_report_parsed drift_alerts_sent
drift_alerts performance_alerts stream_scores stream_online_snapshot stream_dedup stream_dedup_last stream_features
""".split())

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None, digits: int | None = 6, shared: bool = False):
    """Register a query builder; every DOUBLE result column is rounded to ``digits``.

    ``shared=True`` marks a query whose plan forks its derived input (bars)
    into several branches: the builder then runs inside ``shared_inputs()``,
    so the input is derived once and read back from a written table.
    """
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_safe_conf(spark)
            if shared or name in FANOUT:
                with shared_inputs():
                    df = fn(spark, sf_dir)
            else:
                df = fn(spark, sf_dir)
            return round_doubles(df, digits) if digits is not None else df
        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that they register themselves."""
    from tickerwise.plans import (  # noqa: F401
        q_bars, q_clean, q_feas, q_model, q_drift, q_serving, q_attr, q_monitor, q_mixed, q_stream, q_ticker_models, q_blocks,
    )
