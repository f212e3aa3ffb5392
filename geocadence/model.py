"""Schemas, missing-data markers and fixed thresholds."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: markers written for missing data ---------------------------------------------
NO_DATA_NUMBER = -9999
NO_DATA_FLOAT = -9999.0
NO_DATA_TEXT = "NA"
NO_DATA_ROW_TEXT = "NoData"

# --- fixed values: period labels -----------------------------------------------------------------
OBSERVED = "Observed"
FORECAST = "Forecast"
MIXED = "Observed_Forecast"

# --- fixed values: default alert ranges, ids and colours (lo, hi; hi None = open) -----------------
ALERT_DEFAULTS = [
    ("white", 0, 0, 0, "255,255,255,0.1"),
    ("green", 1, 2, 1, "0,128,0,0.1"),
    ("yellow", 3, 5, 2, "255,255,0,0.1"),
    ("orange", 6, 13, 3, "255,165,0,0.1"),
    ("red", 14, None, 4, "255,0,0,0.1"),
]
UNKNOWN_RGBA = "0,0,0,0.1"

# --- fixed values: indicator windows in hours, feature order of the kernel ------------------------
RAIN_WINDOWS = (3, 6, 12, 24)
KERNEL_FEATURES = ("sm_value_first", "rain_accumulated_12H", "rain_peak_3H", "day_of_the_year")
EARTH_RADIUS_M = 6371000.0
MERCATOR_RADIUS_M = 6378137.0

GRID_CELL = T.StructType([
    T.StructField("var", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("domain_order", T.IntegerType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("row", T.IntegerType()),
    T.StructField("col", T.IntegerType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
])

SLIP_CATALOGUE = T.StructType([
    T.StructField("id_frana", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("provincia", T.StringType()),
    T.StructField("comune", T.StringType()),
    T.StructField("ALLERTA", T.StringType()),
])

# --- fixed values: column kinds of the predictor table -------------------------------------------
PREDICTOR_KINDS = {
    "day_of_the_year": "numeric:integer",
    "rain_peak_3H": "numeric:float",
    "rain_accumulated_12H": "numeric:float",
    "rain_time_run": "timestamp",
    "rain_time_start": "timestamp",
    "rain_time_end": "timestamp",
    "rain_time_pivot": "timestamp",
    "rain_period_type": "string",
    "rain_latest_from": None,
    "sm_value_first": "numeric:float",
    "sm_value_last": "numeric:float",
    "sm_time_run": "timestamp",
    "sm_time_start": "timestamp",
    "sm_time_end": "timestamp",
    "sm_time_pivot": "timestamp",
    "sm_period_type": "string",
    "sm_latest_from": None,
    "slips_domain": "string",
    "slips_obs_n": "numeric:integer",
    "slips_obs_id": "numeric:integer",
    "slips_obs_alert_color": "string",
    "slips_obs_alert_rgb": "string",
    "slips_pred_n": "numeric:integer",
    "slips_pred_id": "numeric:integer",
    "slips_pred_alert_color": "string",
    "slips_pred_alert_rgb": "string",
}
