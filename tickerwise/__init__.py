"""tickerwise — per-ticker bar analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function keyed by a ticker
column and ordered by a date column.  Nothing is collected to the driver
except one-row results that are already aggregated.
"""

from tickerwise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
