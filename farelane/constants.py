"""Fixed values that must equal the reference pipeline's for matching results.

Everything in this module is a plain constant: column names, thresholds,
feature lists, split rules and model presets.  Operators take these as
defaults and accept overrides.
"""

from __future__ import annotations

# --- fixed values: trip schema -------------------------------------------------
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
TARGET = "total_amount"
FILE_MONTH = "file_month"  # 'YYYY-MM' of the monthly file a row came from

# fare components removed during column normalisation (matched case-insensitively)
FARE_COMPONENT_COLUMNS = (
    "cbd_congestion_fee",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)

# columns imputed / dropped together by the missing-value policy
TRIO = ("passenger_count", "RatecodeID", "store_and_fwd_flag")
TRIO_DEFAULTS = {"passenger_count": 1.0, "RatecodeID": 1.0, "store_and_fwd_flag": "N"}
MISSING_POLICY = {2024: "drop", 2025: "impute"}

# inclusive ranges of the outlier filter
RANGE_BOUNDS = {
    "passenger_count": (1, 9),
    "trip_distance": (0.1, 50),
    "total_amount": (1, 250),
}

# location id rules
LOCATION_REPLACE = {57: 56}
BAD_LOCATION_IDS = (264, 265)

# trip duration band in minutes
DURATION_BOUNDS = (1, 180)

EARTH_RADIUS_KM = 6371.0

UNKNOWN = "Unknown"

# raw and intermediate columns dropped after feature engineering
RAW_FEATURE_DROP = (
    "pickup_hour",
    "dropoff_hour",
    "pickup_dayofweek",
    "pickup_month",
    "pickup_minute",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
)

# --- fixed values: model features ---------------------------------------------
NUMERIC_FEATURES = (
    "trip_distance",
    "trip_duration",
    "haversine_distance",
    "pickup_lon",
    "pickup_lat",
    "dropoff_lon",
    "dropoff_lat",
    "pickup_hour_sin",
    "pickup_hour_cos",
    "dropoff_hour_sin",
    "dropoff_hour_cos",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
    "passenger_count",
)

CATEGORICAL_FEATURES = (
    "VendorID",
    "RatecodeID",
    "store_and_fwd_flag",
    "payment_type",
    "pickup_borough",
    "dropoff_borough",
    "pickup_service_zone",
    "dropoff_service_zone",
    "pickup_period",
    "is_holiday",
    "is_long_weekend",
    "is_weekend",
    "is_rush_hour",
    "is_nightlife",
    "is_friday_getaway",
)

FEATURE_DROP = ("pickup_date",)

# --- fixed values: splits and sampling ----------------------------------------
# 2024 -> train, 2025-01..2025-06 -> val, 2025-07 -> test, anything else -> ignore
SPLIT_RULES = (
    ("train", 2024, 1, 12),
    ("val", 2025, 1, 6),
    ("test", 2025, 7, 7),
)
IGNORE_SPLIT = "ignore"
DEFAULT_SEED = 42
SAMPLE_ROWS_PER_MONTH = {"train": 100_000, "val": 35_000, "test": 100_000}
AUDIT_SAMPLE_ROWS = 25_000
BIAS_SEEDS = (0, 1, 2, 3, 42)
BIAS_CATEGORICALS = ("payment_type", "pickup_borough")
BIAS_NUMERICS = ("trip_distance", "trip_duration")
TVD_OK = 0.05
KS_OK = 0.10

MONTH_FILE_GLOB = "yellow_tripdata_20*.parquet"

# --- fixed values: model presets ----------------------------------------------
RIDGE_ALPHA = 1.0
# boosted-tree presets (trees, depth, learning rate, row / column fraction)
BOOSTED_PRESETS = {
    "xgboost": dict(max_iter=700, max_depth=8, step_size=0.08, subsampling_rate=0.9, feature_fraction=0.9),
    "lightgbm": dict(max_iter=1200, max_depth=5, step_size=0.05, subsampling_rate=1.0, feature_fraction=1.0),
    "catboost": dict(max_iter=1200, max_depth=8, step_size=0.05, subsampling_rate=1.0, feature_fraction=1.0),
}
EARLY_STOPPING_ROUNDS = 200
N_TRIALS = 50
TRAINING_MODES = ("evaluate", "optimize", "test")
