"""Binding of the driver's star schema to meter readings.

`events` is the fact table (one event = one reading), `customer` x `nation` x `region` the meter
catalog. Measures the events do not carry are arithmetic on the event id, so that any SQL engine
derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.load import weather_condition
from meterlake.functions.numeric import clip


# Schemas of the tables read here; with them Spark need not open a file to plan a query.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


# Market segment -> usage profile.
PROFILE_BY_SEGMENT = {
    "HOUSEHOLD": "residential",
    "BUILDING": "commercial",
    "MACHINERY": "industrial",
    "AUTOMOBILE": "ac_heavy",
    "FURNITURE": "night_usage",
}


def meter_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """One row per meter. Nation and region are fixed at 25 and 5 rows, hence broadcast."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    profile = F.coalesce(*[F.when(F.col("c_mktsegment") == s, F.lit(p)) for s, p in PROFILE_BY_SEGMENT.items()])
    key = F.col("c_custkey")
    return (
        table(spark, folder, "customer")
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("user_id"),
            meter_name(key).alias("meter_id"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("area"),
            (whole(F.lit(1280) + F.pmod(key * 7, F.lit(40))) / 1e2).alias("latitude"),
            (whole(F.lit(7745) + F.pmod(key * 11, F.lit(35))) / 1e2).alias("longitude"),
            profile.alias("usage_profile"),
        )
    )


def meter_name(key: Column) -> Column:
    return F.concat(F.lit("M"), F.lpad(key.cast("string"), 6, "0"))


def whole(col: Column) -> Column:
    return col.cast("double")


def meter_readings(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """The canonical readings table, with bound model scores for score-dependent operators.

    `timestamp` is the event time, `tick` the hour it falls into, `reading_id` the unique key.
    `events` may be a stream of the events table; the catalog stays a static side.
    """
    catalog = meter_catalog(spark, folder)
    events = table(spark, folder, "events") if events is None else events
    e = F.col("event_id")
    k = whole(F.get_json_object("props", "$.k").cast("int"))

    def cycle(multiplier: int, modulus: int) -> Column:
        return whole(F.pmod(e * multiplier, F.lit(modulus)))

    facts = events.select(
        F.col("event_id").alias("reading_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("consumption_kwh"),
        (F.col("value") * (F.lit(1e0) + k / 2e2)).alias("power"),
        (F.lit(195e0) + cycle(37, 58)).alias("voltage"),
        ((F.lit(60e0) + cycle(17, 40)) / 1e2).alias("power_factor"),
        (F.lit(-12e0) + cycle(13, 66)).alias("temperature"),
        (F.lit(35e0) + cycle(7, 64)).alias("humidity"),
        (cycle(11, 50) / 1e1).alias("rainfall"),
        (F.lit(5e-1) + cycle(5, 40) / 1e1).alias("wind_speed"),
        (F.lit(20e0) + cycle(29, 60)).alias("expected_consumption_kwh"),
        (F.col("event_type") == "error").cast("int").alias("is_theft"),
        F.when(F.col("event_type") == "error", F.lit("tampered_meter")).otherwise("none").alias("theft_type"),
        (k / 1e2).alias("seeded_theft_probability"),
        (k / 99e0).alias("random_forest_probability"),
        (cycle(31, 100) / 99e0).alias("xgboost_probability"),
        (F.lit(35e-2) + cycle(19, 45) / 1e2).alias("anomaly_score"),
    )
    joined = facts.join(catalog, "user_id")
    expected = F.col("expected_consumption_kwh")
    return (
        joined.withColumn("tick", F.date_trunc("hour", "timestamp"))
        .withColumn(
            "wastage_score",
            clip((F.col("consumption_kwh") - expected) / F.greatest(expected, F.lit(1e-1)), low=0.0),
        )
        .withColumn(
            "current",
            F.col("power") * 1e3 / F.greatest(F.col("voltage") * F.col("power_factor"), F.lit(1e0)),
        )
        .withColumn("weather_condition", weather_condition("rainfall", "humidity", "temperature"))
        .drop("user_id")
    )


def raw_readings(spark: SparkSession, folder: str) -> DataFrame:
    """The same readings as untyped text with the defects cleaning has to cope with.

    The seeded probability (0 .. 0.99 in steps of 0.01) decides which row carries which defect.
    """
    df = meter_readings(spark, folder)
    p = F.col("seeded_theft_probability")
    text = {c: F.col(c).cast("string") for c in ("consumption_kwh", "power", "power_factor", "wastage_score", "temperature")}
    return df.select(
        "reading_id",
        "meter_id",
        "area",
        F.when(p == 0e0, F.lit("unknown")).otherwise(F.col("timestamp").cast("string")).alias("timestamp"),
        F.when(p == 3e-2, F.concat(F.lit("-"), text["consumption_kwh"])).otherwise(text["consumption_kwh"]).alias("consumption_kwh"),
        F.when(p == 1e-2, F.lit("n/a")).otherwise(text["power"]).alias("power"),
        F.when(p == 2e-2, F.lit("1.5")).otherwise(text["power_factor"]).alias("power_factor"),
        F.when(p == 4e-2, F.lit(None)).otherwise(text["wastage_score"]).alias("wastage_score"),
        F.when(p == 5e-2, F.lit("NaN")).otherwise(text["temperature"]).alias("temperature"),
    )
