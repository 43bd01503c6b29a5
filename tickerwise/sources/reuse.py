"""Derive a shared input once per query and cut its lineage.

Many queries fork one derived input (the bar table) into several branches
- per-check aggregates joined back, train/test legs, baselines.  Without
help every branch re-runs lineitem -> part join -> bar aggregation, because
each branch prunes different columns and no exchange can be reused.  Inside
``shared_inputs()`` the first request for an input builds it, writes it as a
Parquet table under ``spark.checkpoint.dir`` (the shared folder of the
cluster) and every later request reads that table back:

* the expensive scan and aggregation run once per query;
* the lineage is cut, so a lost executor re-reads files instead of
  recomputing the whole derivation;
* the table keeps column pruning and filter pushdown for the branches.

Bars are bounded by tickers x trading days, so the table stays small even
when the input tables are huge.
"""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from tickerwise.session import checkpoint_dir, remove_at_exit

_memo: contextvars.ContextVar[dict | None] = contextvars.ContextVar("tickerwise_shared", default=None)


@contextlib.contextmanager
def shared_inputs():
    """Scope in which :func:`reuse` materializes each named input once."""
    token = _memo.set({})
    try:
        yield
    finally:
        _memo.reset(token)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the session's checkpoint folder and read it back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tickerwise-tables/{name}-{uuid.uuid4().hex[:12]}"
    remove_at_exit(df.sparkSession, path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def reuse(key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` once per scope (materialized); outside a scope just ``build()``."""
    memo = _memo.get()
    if memo is None:
        return build()
    if key not in memo:
        memo[key] = materialize(build(), str(key[0]))
    return memo[key]

