"""Source, sink, load-model and weather queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meterlake.catalog.base import over_readings, over_scored, query, readings, scored
from meterlake.functions import load
from meterlake.operators import theft
from meterlake.plans.session import checkpoint_folder, cut_lineage
from meterlake.sources import io
from meterlake.sources.tables import meter_catalog, meter_readings


def scratch(spark, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


PLAIN = "reading_id, meter_id, area, consumption_kwh, power_factor, temperature, wastage_flag, power_gap, temperature_band"


@query("csv_scan", over_readings(f"SELECT {PLAIN} FROM readings"))
def _csv(spark, folder):
    path = scratch(spark, "readings-csv")
    names = [f.name for f in io.READING_SCHEMA]
    io.append_readings(meter_readings(spark, folder).select(*names, "reading_id"), path, "csv", partition=False)
    df = io.load_readings(spark, path, "csv", extra=("reading_id",))
    return df.withColumn("reading_id", F.col("reading_id").cast("bigint")).select(*PLAIN.split(", "))


@query("partitioned_parquet", over_readings("SELECT reading_id, cast(\"timestamp\" AS date) AS event_date, consumption_kwh FROM readings"))
def _parquet(spark, folder):
    path = scratch(spark, "readings-parquet")
    io.append_readings(readings(spark, folder), path)
    return spark.read.parquet(path).select("reading_id", "event_date", "consumption_kwh")


@query("table_writes", over_readings("SELECT reading_id, meter_id, consumption_kwh FROM readings"))
def _table(spark, folder):
    path = scratch(spark, "readings-table")
    io.write_table(readings(spark, folder).limit(10), path)
    io.write_table(readings(spark, folder), path)
    return spark.read.parquet(path).select("reading_id", "meter_id", "consumption_kwh")


@query("replaced_snapshot", over_readings("SELECT meter_id, count(*) AS readings FROM readings GROUP BY meter_id"))
def _replaced(spark, folder):
    name = f"meter_snapshot_{uuid.uuid4().hex}"
    counts = readings(spark, folder).groupBy("meter_id").agg(F.count("*").alias("readings"))
    io.save_snapshot(counts.limit(3), name)
    io.save_snapshot(counts, name)
    kept = cut_lineage(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    return kept


@query(
    "sql_over_tables",
    over_readings("SELECT region, usage_profile, count(*) AS readings, max(consumption_kwh) AS peak FROM readings GROUP BY 1, 2"),
)
def _sql(spark, folder):
    return io.run_sql(
        spark,
        "SELECT region, usage_profile, count(*) AS readings, max(consumption_kwh) AS peak FROM {r} GROUP BY region, usage_profile",
        r=readings(spark, folder),
    )


@query(
    "records_export",
    over_scored("""
SELECT reading_id, meter_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS "timestamp", risk_score, status FROM scored
ORDER BY risk_score DESC, reading_id LIMIT 100"""),
)
def _export(spark, folder):
    df = scored(spark, folder).select("reading_id", "meter_id", "timestamp", "risk_score", "status")
    return io.export_records(df, 100, [F.desc("risk_score"), F.col("reading_id")])


@query(
    "json_documents",
    over_readings("""SELECT reading_id, meter_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS "timestamp", consumption_kwh, usage_profile FROM readings"""),
)
def _documents(spark, folder):
    df = readings(spark, folder).select("reading_id", "meter_id", "timestamp", "consumption_kwh", "usage_profile")
    documents = io.to_documents(io.export_records(df))
    shape = "reading_id bigint, meter_id string, timestamp string, consumption_kwh double, usage_profile string"
    return documents.select(F.from_json("document", shape).alias("d")).select("d.*")


@query(
    "json_ingest",
    over_readings("""
, q AS (
  SELECT reading_id, meter_id, area, consumption_kwh, least(greatest(power_factor, 0e0), 1e0) AS power_factor,
    CASE WHEN is_theft = 1 THEN consumption_kwh ELSE coalesce(nullif(CASE WHEN seeded_theft_probability < 1e-1 THEN 0e0 ELSE expected_consumption_kwh END, 0e0), consumption_kwh) END
      AS expected_consumption_kwh
  FROM readings
), w AS (
  SELECT *, greatest((consumption_kwh - greatest(expected_consumption_kwh, 1e-1)) / greatest(expected_consumption_kwh, 1e-1), 0e0) AS wastage_score FROM q
)
SELECT reading_id, meter_id, area, consumption_kwh, expected_consumption_kwh, wastage_score, 'residential' AS usage_profile,
  CASE WHEN wastage_score >= 25e-2 OR power_factor < 8e-1 THEN 1 ELSE 0 END AS wastage_flag FROM w"""),
)
def _ingest(spark, folder):
    df = readings(spark, folder)
    expected = F.when(F.col("seeded_theft_probability") < 1e-1, F.lit(0e0)).otherwise(F.col("expected_consumption_kwh"))
    sent = F.struct(
        "meter_id", "timestamp", "region", "area", "latitude", "longitude", "voltage", "current", "power", "consumption_kwh",
        "power_factor", "temperature", "humidity", "rainfall", "wind_speed", "weather_condition",
        F.when(F.col("is_theft") == 0, expected).alias("expected_consumption_kwh"),
    )
    document = F.to_json(sent)
    payload = F.when(F.col("is_theft") == 1, F.concat(F.lit("["), document, F.lit("]"))).otherwise(document)
    parsed = io.parse_requests(df.select("reading_id", payload.alias("payload")), keep=("reading_id",))
    return parsed.select(
        "reading_id", "meter_id", "area", "consumption_kwh", "expected_consumption_kwh", "wastage_score", "usage_profile", "wastage_flag"
    )


@query(
    "weather_parse",
    over_readings("""
SELECT reading_id, temperature, humidity, CASE WHEN rainfall > 0 THEN rainfall ELSE 0e0 END AS rainfall,
  CASE WHEN is_theft = 1 THEN 0e0 ELSE wind_speed END AS wind_speed, weather_condition, 'openweather' AS source FROM readings"""),
)
def _weather(spark, folder):
    df = readings(spark, folder)
    document = F.to_json(
        F.struct(
            F.struct(F.col("temperature").alias("temp"), "humidity").alias("main"),
            F.when(F.col("is_theft") == 0, F.struct(F.col("wind_speed").alias("speed"))).alias("wind"),
            F.when(F.col("rainfall") > 0, F.create_map(F.lit("1h"), F.col("rainfall"))).alias("rain"),
            F.array(F.struct(F.col("weather_condition").alias("main"))).alias("weather"),
        )
    )
    return io.parse_weather(df.select("reading_id", document.alias("payload")))


@query(
    "live_slice",
    over_readings("""
SELECT reading_id, meter_id, "timestamp" FROM readings
WHERE meter_id IN (SELECT concat('M', lpad(cast(c_custkey AS varchar), 6, '0')) AS m FROM customer ORDER BY m LIMIT 120)
  AND "timestamp" >= (SELECT max("timestamp") FROM readings) - INTERVAL 10 DAY"""),
)
def _live(spark, folder):
    return io.live_slice(readings(spark, folder), meter_catalog(spark, folder)).select("reading_id", "meter_id", "timestamp")


@query(
    "expected_load",
    over_readings("""
, t AS (SELECT *, hour("timestamp") AS h, isodow("timestamp") - 1 AS d FROM readings)
, c AS (
  SELECT *, CASE usage_profile WHEN 'residential' THEN 1.6e0 WHEN 'night_usage' THEN 1.7e0 WHEN 'industrial' THEN 3.4e0
      WHEN 'ac_heavy' THEN 2.3e0 WHEN 'commercial' THEN 2.8e0 END AS base,
    greatest(CASE usage_profile
      WHEN 'residential' THEN 55e-2 + CASE WHEN h BETWEEN 6 AND 9 THEN 35e-2 ELSE 0 END + CASE WHEN h BETWEEN 18 AND 23 THEN 75e-2 ELSE 0 END + CASE WHEN d >= 5 THEN 12e-2 ELSE 0 END
      WHEN 'night_usage' THEN 45e-2 + CASE WHEN h >= 20 OR h <= 4 THEN 85e-2 ELSE 0 END + CASE WHEN d >= 5 THEN 8e-2 ELSE 0 END
      WHEN 'industrial' THEN 7e-1 + CASE WHEN h BETWEEN 8 AND 18 THEN 55e-2 ELSE 0 END - CASE WHEN d >= 5 THEN 18e-2 ELSE 0 END
      WHEN 'commercial' THEN 55e-2 + CASE WHEN h BETWEEN 10 AND 21 THEN 75e-2 ELSE 0 END - CASE WHEN d >= 5 THEN 1e-1 ELSE 0 END
      ELSE 5e-1 + CASE WHEN h BETWEEN 11 AND 19 THEN 5e-1 ELSE 0 END + 35e-3 * greatest(temperature - 28e0, 0e0) END, 2e-1) AS curve,
    1e0 + 8e-2 * sin(cast(dayofyear("timestamp") AS double) / 365e0 * (2e0 * pi())) + CASE WHEN month("timestamp") BETWEEN 6 AND 9 THEN 8e-2 ELSE 0e0 END
      + CASE WHEN month("timestamp") BETWEEN 10 AND 12 THEN 5e-2 ELSE 0e0 END AS season,
    1e0 + 3e-2 * greatest(temperature - 28e0, 0e0) + 15e-3 * rainfall + 5e-3 * greatest(humidity - 75e0, 0e0) AS effect
  FROM t
)
SELECT reading_id, round_even(curve * 1e6, 0) / 1e6 AS curve, round_even(season * 1e6, 0) / 1e6 AS season,
  round_even(greatest(base * curve * season * effect, 12e-2) * 1e6, 0) / 1e6 AS expected_kwh FROM c"""),
)
def _load(spark, folder):
    from meterlake.functions.numeric import round_to

    ts = F.col("timestamp")
    return readings(spark, folder).select(
        "reading_id",
        round_to(load.load_curve("usage_profile", F.hour(ts), F.weekday(ts), "temperature"), 6).alias("curve"),
        round_to(load.seasonal_factor(ts), 6).alias("season"),
        round_to(load.expected_load(), 6).alias("expected_kwh"),
    )


@query(
    "wastage_formula",
    over_readings("""
, s AS (
  SELECT reading_id, least(greatest((consumption_kwh - expected_consumption_kwh) / greatest(expected_consumption_kwh, 1e-1), 0e0), 2.5e0)
    + CASE WHEN usage_profile = 'ac_heavy' AND temperature < 24 AND consumption_kwh > expected_consumption_kwh * 1.15e0 THEN 18e-2 ELSE 0e0 END
    + CASE WHEN power_factor < 82e-2 AND is_theft <> 1 THEN 12e-2 ELSE 0e0 END AS total FROM readings
)
SELECT reading_id, round_even(least(greatest(total, 0e0), 2.5e0) * 1e3, 0) / 1e3 AS wastage FROM s"""),
)
def _wastage(spark, folder):
    return readings(spark, folder).select("reading_id", load.wastage_score().alias("wastage"))


@query(
    "current_from_power",
    over_readings("SELECT reading_id, greatest(power * 1e3 / greatest(voltage * power_factor, 1e0), 4e-1) AS amps FROM readings"),
)
def _current(spark, folder):
    return readings(spark, folder).select("reading_id", load.current_from_power().alias("amps"))


@query(
    "weather_condition",
    over_readings("SELECT weather_condition, count(*) AS readings, max(rainfall) AS rain FROM readings GROUP BY 1"),
)
def _condition(spark, folder):
    df = readings(spark, folder).withColumn("weather_condition", load.weather_condition("rainfall", "humidity", "temperature"))
    return df.groupBy("weather_condition").agg(F.count("*").alias("readings"), F.max("rainfall").alias("rain"))


@query(
    "weather_enrich",
    over_readings("""
, w AS (SELECT area, tick, max(temperature) AS area_temperature, min(humidity) AS area_humidity FROM readings GROUP BY 1, 2)
SELECT r.reading_id, area_temperature, area_humidity FROM readings r LEFT JOIN w USING (area, tick)"""),
)
def _enrich(spark, folder):
    df = readings(spark, folder)
    weather = df.groupBy("area", F.col("tick").alias("timestamp")).agg(
        F.max("temperature").alias("area_temperature"), F.min("humidity").alias("area_humidity")
    )
    return io.enrich_weather(df, weather).select("reading_id", "area_temperature", "area_humidity")


BLOCK_TAKE = 40


@query(
    "block_sample",
    over_readings(f"""
SELECT reading_id, block FROM (
  SELECT reading_id, cast(cast(substr(meter_id, 2) AS bigint) // 45 AS bigint) AS block FROM readings)
QUALIFY row_number() OVER (PARTITION BY block ORDER BY ((reading_id % 2147483648) * 1103515245 + 12345 * 42) % 2147483648, reading_id) <= {BLOCK_TAKE}"""),
)
def _block(spark, folder):
    block = F.floor(F.substring("meter_id", 2, 20).cast("bigint") / 45)
    df = readings(spark, folder).select("reading_id", block.alias("block"))
    return theft.block_sample(df, "block", BLOCK_TAKE)
