"""Bar contract, feature names and the fixed thresholds of the checks."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "ticker"
ORDER = "Date"
TARGET = "target"

BAR_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), True),
    T.StructField("Date", T.DateType(), True),
    T.StructField("Open", T.DoubleType(), True),
    T.StructField("High", T.DoubleType(), True),
    T.StructField("Low", T.DoubleType(), True),
    T.StructField("Close", T.DoubleType(), True),
    T.StructField("Volume", T.LongType(), True),
])

# ---- fixed values: these must equal the reference's for equal results ----
REQUIRED_COLUMNS = ["Date", "Open", "High", "Low", "Close", "Volume"]
OHLCV = ["Open", "High", "Low", "Close", "Volume"]
PRICES = ["Open", "High", "Low", "Close"]
ROLLING_WINDOWS = [5, 10, 20]
TRAIN_RATIO = 0.8
DRIFT_SPLIT_RATIO = 0.7

# data-contract validation
MAX_REMOVAL_PCT = 10.0
# integrity rules, in the order they are applied; a row is charged to its first broken rule
INTEGRITY_RULES = [
    "negative_or_zero_prices",
    "negative_volume",
    "high_less_than_low",
    "high_less_than_open",
    "high_less_than_close",
    "low_greater_than_open",
    "low_greater_than_close",
]
QUALITY_ACCEPTABLE_PCT = 5.0
QUALITY_GRADES = ["EXCELLENT", "ACCEPTABLE", "NEEDS REVIEW"]
FRESHNESS_MAX_DAYS = 7

# feasibility thresholds
MIN_SAMPLES = 100
MIN_COMPLETENESS_PCT = 90.0
MAX_GAP_DAYS = 10
OUTLIER_Z = 4.0
MAX_OUTLIER_PCT = 1.0
MIN_LABEL_BALANCE = 0.20
MAX_LABEL_BALANCE = 0.80
LOOKAHEAD_KEYWORDS = ["target", "label", "future", "next", "tomorrow"]
EXAMPLES_SHOWN = 5

# drift
DATA_DRIFT_THRESHOLD = 0.5
TARGET_DRIFT_THRESHOLD = 0.3
DRIFT_P_VALUE = 0.05

# model evaluation
SUSPICIOUS_ACCURACY = 0.70
TRIVIAL_PREDICTION_SHARE = 0.95
LEAKAGE_CORR = 0.99
RETRAIN_FACTOR = 0.9
SEED = 42

# feature view
FEATURE_VIEW_TTL_DAYS = 1
FEATURE_VIEW_FIELDS = [
    "Open", "High", "Low", "Close", "Volume", "returns",
    "ma_5", "ma_10", "ma_20", "volatility_5", "volatility_10", "volatility_20",
]

# request metrics histogram bucket upper bounds, seconds
LATENCY_BUCKETS = [0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0]
STORE_LATENCY_BUCKETS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5]
# ---- end of fixed values ----


def feature_names(windows=ROLLING_WINDOWS) -> list[str]:
    """The 12 model features: raw OHLCV, returns, rolling means, rolling volatility."""
    return (OHLCV + ["returns"] + [f"ma_{w}" for w in windows]
            + [f"volatility_{w}" for w in windows])


class MissingFeaturesError(KeyError):
    """Raised when a frame lacks features a model was trained on."""


def feature_columns(columns, order: str = ORDER, target: str = TARGET, key: str = KEY) -> list[str]:
    """Every column except the date, the label (and the ticker key), in frame order."""
    return [c for c in columns if c not in (order, target, key)]


def select_features(df, names: list[str], keep=(KEY, ORDER)):
    """Project the model's features in training order; name every missing one."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingFeaturesError(f"missing features: {missing}")
    return df.select(*[k for k in keep if k in df.columns], *names)
