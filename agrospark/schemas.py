"""Logical tables and the fixed values of the agronomic rules."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: rule constants, stage tables, names and formats -------------------------
BASE_ALTITUDE_M = 1200.0
LATE_ALTITUDE_M = 1600.0
METRES_PER_DELAY_DAY = 100.0
MIN_PLANTING_RAIN_MM = 5.0
MIN_PLANTING_TEMP_C = 18.0
GDD_BASE_C = 10.0
TEMP_MIN_C = -50.0
TEMP_MAX_C = 60.0
DEFAULT_YEAR = 2021
SHORT_RAINS = "Short Rains"
LONG_RAINS = "Long Rains"
OFF_SEASON = "Off Season"
SHORT_RAINS_NAMES = ("short rains", "short", "sr", "short_rains", "short-rains")
LONG_RAINS_NAMES = ("long rains", "long", "lr", "long_rains", "long-rains")
PLANTING_METHOD = "rainfall_temperature_threshold"
STAGES = ("VE", "V2", "V6", "VT", "R1", "R4", "R6")
GDD_THRESHOLDS = {
    "early": {"VE": 80, "V2": 150, "V6": 350, "VT": 850, "R1": 950, "R4": 1150, "R6": 1300},
    "medium": {"VE": 100, "V2": 180, "V6": 400, "VT": 1000, "R1": 1100, "R4": 1350, "R6": 1500},
    "late": {"VE": 120, "V2": 210, "V6": 450, "VT": 1150, "R1": 1250, "R4": 1550, "R6": 1800},
}
LONG_FORM_STAGES = {
    "Emergence (VE)": 100,
    "V2 (Two leaves with collars visible)": 250,
    "V6 (Six leaves with collars visible)": 475,
    "VT (Tasseling)": 900,
    "R1 (Silking)": 1100,
    "R3 (Milk)": 1400,
    "R5 (Dent)": 1925,
    "R6 (Maturity)": 2450,
}
VT_SOURCES = ("gdd_calculated", "r1_fallback", "estimated")
STAGE_METHODS = ("gdd", "estimated")
PLANTING_COLUMN_NAMES = (
    "inferred_planting_date",
    "planting_date",
    "extracted_planting_date",
    "date",
    "optimal_planting_date",
    "plantingDate",
)
PLANTING_COLUMN_KEYWORDS = ("plant", "date", "infer", "extract")
BANDS = {"blue": "B2", "green": "B3", "red": "B4", "red_edge": "B5", "nir": "B8", "swir": "B11"}
INDICES = ("ndvi", "evi", "savi", "ndre", "ndwi", "ndmi")
LATENCY_BUCKETS_S = (0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)
PSI_HIGH = 0.25
PSI_MEDIUM = 0.1
PSI_EMPTY_SHARE = 1e-6
DRIFT_IGNORED = ("plot_id", "date", "planting_date", "latitude", "longitude")
SCORING_DROPPED = ("plot_id", "planting_date", "latitude", "longitude", "season")
# -------------------------------------------------------------------------------------------

# Running degree days are whole millionths, so that the order of partial sums cannot move a threshold.
GDD_UNIT = 1_000_000

PLOTS = T.StructType([
    T.StructField("plot_id", T.LongType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("altitude", T.DoubleType()),
    T.StructField("season", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

WEATHER = T.StructType([
    T.StructField("plot_id", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("date", T.DateType()),
    T.StructField("max_temp_c", T.DoubleType()),
    T.StructField("min_temp_c", T.DoubleType()),
    T.StructField("mean_temp_c", T.DoubleType()),
    T.StructField("precip_mm", T.DoubleType()),
    T.StructField("humidity_pct", T.DoubleType()),
    T.StructField("solar_energy_mjm2", T.DoubleType()),
    T.StructField("wind_speed_kmh", T.DoubleType()),
    T.StructField("cloud_cover_pct", T.DoubleType()),
])

# Provider payload: one document per plot, one entry of `days` per day.
WEATHER_PAYLOAD = T.StructType([
    T.StructField("plot_id", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("days", T.ArrayType(T.StructType([
        T.StructField("datetime", T.StringType()),
        T.StructField("tempmax", T.DoubleType()),
        T.StructField("tempmin", T.DoubleType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("precip", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("solarenergy", T.DoubleType()),
        T.StructField("et", T.DoubleType()),
        T.StructField("windspeed", T.DoubleType()),
        T.StructField("cloudcover", T.DoubleType()),
    ]))),
])

PAYLOAD_NAMES = {
    "tempmax": "max_temp_c",
    "tempmin": "min_temp_c",
    "temp": "mean_temp_c",
    "precip": "precip_mm",
    "humidity": "humidity_pct",
    "solarenergy": "solar_energy_mjm2",
    "et": "evapotranspiration_mm",
    "windspeed": "wind_speed_kmh",
    "cloudcover": "cloud_cover_pct",
}
