"""Table schemas and the fixed values the operators share."""

from __future__ import annotations

from pyspark.sql import types as T

READING_SCHEMA = T.StructType(
    [
        T.StructField("meter_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("region", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("voltage", T.DoubleType()),
        T.StructField("current", T.DoubleType()),
        T.StructField("power", T.DoubleType()),
        T.StructField("consumption_kwh", T.DoubleType()),
        T.StructField("power_factor", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("rainfall", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("weather_condition", T.StringType()),
        T.StructField("is_theft", T.IntegerType()),
        T.StructField("expected_consumption_kwh", T.DoubleType()),
        T.StructField("wastage_score", T.DoubleType()),
        T.StructField("usage_profile", T.StringType()),
        T.StructField("theft_type", T.StringType()),
        T.StructField("seeded_theft_probability", T.DoubleType()),
    ]
)

# The measures that cleaning coerces to numbers.
NUMERIC_COLUMNS = [
    "latitude", "longitude", "voltage", "current", "power", "consumption_kwh", "power_factor",
    "temperature", "humidity", "rainfall", "wind_speed", "is_theft", "expected_consumption_kwh",
    "wastage_score", "seeded_theft_probability",
]

# Model inputs, in model order.
MODEL_NUMERIC = [
    "voltage", "current", "power", "consumption_kwh", "power_factor", "temperature", "humidity",
    "rainfall", "wind_speed", "expected_consumption_kwh", "hour_of_day", "day_of_week",
    "rolling_average_consumption", "consumption_variance", "peak_usage_ratio", "night_usage_ratio",
    "weather_consumption_ratio", "power_factor_loss", "voltage_irregularity", "current_power_gap",
    "wastage_score",
]
MODEL_CATEGORICAL = ["region", "area", "weather_condition", "usage_profile"]

# Status names, in cascade order, and the cut-offs of each step.
THEFT = "Electricity Theft"
ANOMALY = "Anomaly"
WASTAGE = "Power Wastage"
NORMAL = "Normal"
THEFT_CUT = 0.8
WASTAGE_CUT = 0.35

# Segment names by rising mean consumption, and the override.
SEGMENTS = ["Residential", "Commercial", "Industrial"]
SUSPICIOUS = "Suspicious cluster"

# Features a consumer profile is clustered on.
PROFILE_FEATURES = [
    "avg_consumption_kwh", "peak_consumption_kwh", "consumption_std", "night_usage_ratio",
    "peak_usage_ratio", "power_factor_loss", "voltage_irregularity",
]
