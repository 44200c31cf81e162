"""Schemas and fixed values.

FIXED VALUES — these must equal the original pipeline's settings for the
results to match; they are stated plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- FIXED VALUES: cleaning -------------------------------------------------
OUTLIER_COLUMNS = ["sold_price", "sqft", "beds", "lot_sqft"]
VALID_STYLES = ["SINGLE_FAMILY", "CONDO", "CONDOS", "TOWNHOMES", "APARTMENT"]
IQR_MULTIPLIER = 1.5
TARGET = "sold_price"

# --- FIXED VALUES: validation suite -------------------------------------------
REQUIRED_COLUMNS = [
    "style", "list_price", "sold_price", "year_built", "days_on_mls", "sqft",
    "beds", "full_baths", "half_baths", "formatted_address", "new_construction",
    "city", "lot_sqft", "stories", "parking_garage", "hoa_fee", "county",
    "state", "zip_code", "status",
]
# column -> least share of non-null values
NOT_NULL_EXPECTATIONS = [
    ("sold_price", 1.0), ("formatted_address", 0.98), ("city", 0.98),
    ("county", 0.98), ("state", 1.0), ("zip_code", 0.98), ("status", 1.0),
    ("style", 0.98), ("sqft", 0.85), ("beds", 0.90), ("full_baths", 0.90),
    ("half_baths", 0.80),
]
# column -> (min, max, least share of non-null values inside [min, max])
RANGE_EXPECTATIONS = [
    ("list_price", 100000, 1000000, 1.0),
    ("sold_price", 100000, 1000000, 1.0),
    ("sqft", 500, 5000, 0.98),
    ("beds", 0, 8, 1.0),
    ("full_baths", 0, 5, 1.0),
    ("half_baths", 0, 5, 1.0),
    ("year_built", 1900, 2027, 0.95),
    ("lot_sqft", 0, 200000, 0.85),
    ("stories", 0, 5, 0.95),
]
# column -> (allowed values, least share of non-null values in the set)
SET_EXPECTATIONS = [
    ("style", ["SINGLE_FAMILY", "CONDO", "CONDOS", "TOWNHOMES", "APARTMENT"], 1.0),
    ("status", ["SOLD"], 1.0),
]
MIN_ROW_COUNT = 50

# --- FIXED VALUES: snapshot naming ---------------------------------------------
KNOWN_PREFIXES = ["validated_", "quarantined_", "fixed_", "approved_", "rejected_", "removed_"]

# --- FIXED VALUES: feature engineering -----------------------------------------
NON_FEATURE_COLUMNS = [
    "property_url", "property_id", "listing_id", "permalink", "mls", "mls_id",
    "status", "mls_status",
    "text", "formatted_address", "full_street_line", "street", "unit",
    "list_price", "list_price_min", "list_price_max",
    "pending_date", "last_sold_date", "last_sold_price",
    "last_status_change_date", "last_update_date",
    "assessed_value", "estimated_value",
    "tax", "tax_history",
    "price_per_sqft",
    "latitude", "longitude",
    "neighborhoods", "fips_code",
    "agent_id", "agent_name", "agent_email", "agent_phones", "agent_mls_set", "agent_nrds_id",
    "broker_id", "broker_name",
    "builder_id", "builder_name",
    "office_id", "office_mls_set", "office_name", "office_email", "office_phones",
    "nearby_schools", "primary_photo", "alt_photos",
]
# month -> season
SEASON_OF_MONTH = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Fall", 10: "Fall", 11: "Fall",
}
DEFAULT_MONTH = 6
DEFAULT_SEASON = "Summer"
# (column, group keys), applied in this order
MEDIAN_IMPUTE_PLAN = [
    ("year_built", ["style"]),
    ("beds", ["style"]),
    ("sqft", ["style", "beds"]),
    ("stories", ["style"]),
    ("full_baths", ["style", "beds"]),
    ("lot_sqft", ["style"]),
]
ONE_HOT_COLUMNS = ["style", "city", "state", "zip_code", "county", "sale_season"]

# --- FIXED VALUES: scoring defaults ---------------------------------------------
NUMERIC_DEFAULTS = {
    "beds": 3, "full_baths": 2, "half_baths": 0, "sqft": 1500,
    "year_built": 1960, "lot_sqft": 8000, "stories": 2, "hoa_fee": 0,
    "parking_garage": 1, "sale_month": 1,
}
BINARY_PREFIXES = ["has_", "is_"]
BINARY_NAMES = ["new_construction"]

# --- FIXED VALUES: run summary display (dashboard metric order) -------------------
METRIC_DISPLAY_ORDER = [
    "cv_adj_r2_mean", "cv_adj_r2_std", "cv_r2_mean", "cv_rmse_mean",
    "cv_rmse_std", "cv_mae_mean", "train_adj_r2", "train_r2", "train_rmse", "train_mae",
]

# --- Listing schema --------------------------------------------------------------
LISTING_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

LISTING_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("style", T.StringType()),
    T.StructField("list_price", T.DoubleType()),
    T.StructField("sold_price", T.DoubleType()),
    T.StructField("year_built", T.IntegerType()),
    T.StructField("days_on_mls", T.IntegerType()),
    T.StructField("sqft", T.DoubleType()),
    T.StructField("beds", T.IntegerType()),
    T.StructField("full_baths", T.IntegerType()),
    T.StructField("half_baths", T.IntegerType()),
    T.StructField("formatted_address", T.StringType()),
    T.StructField("new_construction", T.BooleanType()),
    T.StructField("city", T.StringType()),
    T.StructField("lot_sqft", T.DoubleType()),
    T.StructField("stories", T.DoubleType()),
    T.StructField("parking_garage", T.IntegerType()),
    T.StructField("hoa_fee", T.DoubleType()),
    T.StructField("county", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("list_date", T.StringType()),
])
LISTING_COLUMNS = [f.name for f in LISTING_SCHEMA.fields]

VALIDATION_REPORT_SCHEMA = T.StructType([
    T.StructField("snapshot", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("evaluated", T.IntegerType()),
    T.StructField("passed", T.IntegerType()),
    T.StructField("failed", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("column_count", T.IntegerType()),
    T.StructField("dataset_hash", T.StringType()),
    T.StructField("data_path", T.StringType()),
    T.StructField("failures", T.ArrayType(T.StructType([
        T.StructField("expectation", T.StringType()),
        T.StructField("kwargs", T.StringType()),
        T.StructField("observed", T.StringType()),
    ]))),
])
