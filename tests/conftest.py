from __future__ import annotations

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlake.plans.session import build_session  # noqa: E402
from meterlake.schema import READING_SCHEMA  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session("4", 4, "meterlake-tests")


@pytest.fixture(scope="session")
def base_frame(spark):
    """Two meters with six hourly readings each."""
    start = dt.datetime(2026, 3, 12)
    places = {
        "M0001": ("Whitefield", 12.9698, 77.7499, "residential"),
        "M0002": ("Electronic City", 12.8452, 77.6602, "commercial"),
    }
    rows = []
    for meter, (area, lat, lon, profile) in places.items():
        for i in range(6):
            rows.append(
                (
                    meter, start + dt.timedelta(hours=i), "Bengaluru", area, lat, lon, 228.0 + i, 5.0 + 0.1 * i, 1.4 + 0.05 * i,
                    1.1 + 0.04 * i, 0.92, 27.0 + 0.2 * i, 68.0, 0.0, 2.1, "Clear", 0, 1.0 + 0.04 * i, 0.08, profile, "none", 0.0,
                )
            )
    df = spark.createDataFrame(rows, READING_SCHEMA)
    return df.withColumn("reading_id", F.monotonically_increasing_id())


@pytest.fixture(scope="session")
def expanded_frame(spark, base_frame):
    """Four meters with given scores, from the first meter's rows."""
    from meterlake.operators.clean import clean_readings
    from meterlake.operators.features import add_engineered_features
    from meterlake.operators.theft import blend_probability

    meters = spark.createDataFrame(
        [
            ("M0101", "Whitefield", "residential", 0.9, 0.08, 0.92, 0.15, 0.05, 0.11, 0.16, "Normal"),
            ("M0102", "Electronic City", "commercial", 1.7, 0.08, 0.92, 0.45, 0.18, 0.49, 0.53, "Normal"),
            ("M0103", "Peenya Industrial Area", "industrial", 2.8, 0.08, 0.82, 0.78, 0.32, 0.67, 0.74, "Anomaly"),
            ("M0104", "Koramangala", "night_usage", 1.4, 0.32, 0.92, 0.88, 0.41, 0.85, 0.91, "Electricity Theft"),
        ],
        "m string, a string, u string, s double, w double, f double, seeded double, anomaly double, rf double, boost double, st string",
    )
    df = base_frame.where("meter_id = 'M0001'").join(meters.withColumn("region", F.lit("Bengaluru")), "region")
    df = df.select(
        F.col("m").alias("meter_id"), "timestamp", "region", F.col("a").alias("area"), "latitude", "longitude",
        (F.col("voltage") - F.col("s")).alias("voltage"), "current", (F.col("power") * F.col("s")).alias("power"),
        (F.col("consumption_kwh") * F.col("s")).alias("consumption_kwh"), F.col("f").alias("power_factor"),
        (F.col("temperature") + F.col("s")).alias("temperature"), (F.col("humidity") + 2 * F.col("s")).alias("humidity"),
        "rainfall", "wind_speed", "weather_condition", "is_theft",
        (F.col("expected_consumption_kwh") * F.greatest(F.col("s") - 0.08, F.lit(0.4))).alias("expected_consumption_kwh"),
        F.col("w").alias("wastage_score"), F.col("u").alias("usage_profile"), "theft_type",
        F.col("seeded").alias("seeded_theft_probability"), F.col("anomaly").alias("anomaly_score"),
        F.col("rf").alias("random_forest_probability"), F.col("boost").alias("xgboost_probability"), F.col("st").alias("status"),
        F.xxhash64("m", "timestamp").alias("reading_id"),
    )
    out = add_engineered_features(clean_readings(df))
    return out.withColumn("theft_probability", F.round(blend_probability(), 4)).cache()
