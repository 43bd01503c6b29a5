from tickerwise.sources.files import load_and_compare, read_bars_csv, write_bars, write_json_report  # noqa: F401
from tickerwise.sources.tables import (  # noqa: F401
    bars_daily, bars_hourly, dirty_bars, entity_requests, label_predictions, read_table, request_log,
)
