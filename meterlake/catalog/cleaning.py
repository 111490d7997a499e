"""Cleaning, features and simple predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.catalog.base import (
    features,
    over_features,
    over_readings,
    over_scored,
    over_statused,
    query,
    readings,
    scored,
    statused,
)
from meterlake.operators import clean, features as feats
from meterlake.sources.tables import raw_readings


@query(
    "clean_readings",
    over_readings("""
, texts AS (
  SELECT reading_id, meter_id, area, seeded_theft_probability AS p, "timestamp" AS ts,
    consumption_kwh AS c, power AS pw, power_factor AS pf, r.wastage_score AS ws, r.temperature AS t
  FROM raw r
), typed AS (
  SELECT reading_id, meter_id, area, ts AS "timestamp",
    greatest(CASE WHEN p = 3e-2 THEN -c ELSE c END, 0e0) AS consumption_kwh,
    CASE WHEN p = 1e-2 THEN 0e0 ELSE pw END AS power,
    CASE WHEN p = 2e-2 THEN 1e0 ELSE least(greatest(pf, 0e0), 1e0) END AS power_factor,
    CASE WHEN p = 4e-2 THEN 0e0 ELSE greatest(ws, 0e0) END AS wastage_score,
    CASE WHEN p = 5e-2 THEN 0e0 ELSE t END AS temperature
  FROM texts WHERE p <> 0e0
)
SELECT *, CASE WHEN wastage_score >= 25e-2 OR power_factor < 8e-1 THEN 1 ELSE 0 END AS wastage_flag,
  round_even((power - consumption_kwh) * 1e3, 0) / 1e3 AS power_gap,
  CASE WHEN temperature > -10 AND temperature <= 20 THEN 'cool' WHEN temperature > 20 AND temperature <= 26 THEN 'mild'
    WHEN temperature > 26 AND temperature <= 32 THEN 'warm' WHEN temperature > 32 AND temperature <= 50 THEN 'hot'
    ELSE 'nan' END AS temperature_band
FROM typed"""),
)
def _clean(spark, folder):
    return clean.clean_readings(raw_readings(spark, folder))


@query(
    "temperature_bands",
    over_readings("SELECT temperature_band, count(*) AS readings, min(temperature) AS low, max(temperature) AS high FROM readings GROUP BY 1"),
)
def _bands(spark, folder):
    return readings(spark, folder).groupBy("temperature_band").agg(
        F.count("*").alias("readings"), F.min("temperature").alias("low"), F.max("temperature").alias("high")
    )


@query(
    "flag_counts",
    over_readings("SELECT area, wastage_flag, count(*) AS readings FROM readings GROUP BY 1, 2"),
)
def _flags(spark, folder):
    return readings(spark, folder).groupBy("area", "wastage_flag").agg(F.count("*").alias("readings"))


@query(
    "default_columns",
    over_readings("""
SELECT reading_id, 'Unknown' AS zone, wastage_score AS measured, 0e0 AS absent FROM readings"""),
)
def _defaults(spark, folder):
    from meterlake.functions.numeric import column_or, with_default

    df = with_default(readings(spark, folder), "zone", "Unknown")
    return df.select("reading_id", "zone", column_or(df, "wastage_score").alias("measured"), column_or(df, "no_such_column").alias("absent"))


METER_COLUMNS = [
    "meter_id", "timestamp", "area", "consumption_kwh", "power", "voltage", "power_factor", "anomaly_score",
    "theft_probability", "risk_score", "risk_level", "efficiency_score", "status",
]


@query(
    "meter_projection",
    over_scored("""SELECT meter_id, "timestamp", area, consumption_kwh, power, voltage, power_factor, anomaly_score,
  theft_probability, risk_score, risk_level, efficiency_score, status FROM scored"""),
)
def _projection(spark, folder):
    return clean.select_present(scored(spark, folder), METER_COLUMNS)


@query(
    "search_theft",
    over_scored("""
SELECT reading_id, meter_id, area, risk_score, theft_probability FROM scored
WHERE status = 'Electricity Theft' AND (contains(lower(meter_id), 'n_1') OR contains(lower(area), 'n_1'))"""),
)
def _search(spark, folder):
    found = clean.search_theft(scored(spark, folder), text=" N_1")
    return found.select("reading_id", "meter_id", "area", "risk_score", "theft_probability")


@query(
    "latest_tick",
    over_readings("SELECT reading_id, meter_id, tick, consumption_kwh FROM readings WHERE tick = (SELECT max(tick) FROM readings)"),
)
def _latest_tick(spark, folder):
    return clean.at_latest(readings(spark, folder), "tick").select("reading_id", "meter_id", "tick", "consumption_kwh")


@query(
    "theft_predicate",
    over_statused("""
SELECT 'status' AS evidence, count(*) FILTER (WHERE status = 'Electricity Theft') AS theft_rows FROM statused
UNION ALL SELECT 'probability', count(*) FILTER (WHERE theft_probability >= 75e-2) FROM statused
UNION ALL SELECT 'label', count(*) FILTER (WHERE is_theft = 1) FROM statused"""),
)
def _predicate(spark, folder):
    df = statused(spark, folder)
    frames = {
        "status": df,
        "probability": df.drop("status"),
        "label": df.drop("status", "theft_probability"),
    }
    parts = [
        clean.theft_rows(f).agg(F.count("*").alias("theft_rows")).select(F.lit(n).alias("evidence"), "theft_rows")
        for n, f in frames.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "calendar_features",
    over_features("SELECT reading_id, hour_of_day, day_of_week FROM features"),
)
def _calendar(spark, folder):
    return feats.calendar_features(readings(spark, folder)).select("reading_id", "hour_of_day", "day_of_week")


@query(
    "rolling_mean_var",
    over_features("SELECT reading_id, rolling_average_consumption, consumption_variance FROM features"),
)
def _rolling(spark, folder):
    return feats.rolling_features(readings(spark, folder)).select(
        "reading_id", "rolling_average_consumption", "consumption_variance"
    )


@query(
    "usage_ratios",
    over_features("SELECT reading_id, peak_usage_ratio, night_usage_ratio FROM features"),
)
def _ratios(spark, folder):
    return feats.rolling_features(readings(spark, folder)).select("reading_id", "peak_usage_ratio", "night_usage_ratio")


@query(
    "tick_scope_features",
    over_readings("""
, t AS (
  SELECT *, round_even(consumption_kwh * 1e4, 0) AS x, hour(tick) AS h FROM readings
), s AS (
  SELECT *, cast(count(*) OVER w AS double) AS n, sum(x) OVER w AS sx, sum(x * x) OVER w AS sxx,
    sum(CASE WHEN h >= 22 OR h <= 5 THEN x ELSE 0e0 END) OVER w AS sn,
    max(consumption_kwh) OVER (PARTITION BY meter_id, tick) AS peak
  FROM t WINDOW w AS (PARTITION BY meter_id, tick ORDER BY tick, reading_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
)
SELECT reading_id, sx / 1e4 / n AS rolling_average_consumption,
  coalesce(greatest(sxx - sx * sx / n, 0e0) / nullif(n - 1e0, 0e0) / (1e4 * 1e4), 0e0) AS consumption_variance,
  coalesce(consumption_kwh / nullif(peak, 0e0), 0e0) AS peak_usage_ratio, coalesce(sn / nullif(sx, 0e0), 0e0) AS night_usage_ratio
FROM s"""),
)
def _tick_scope(spark, folder):
    return feats.rolling_features(readings(spark, folder), time_col="tick", scope="tick").select(
        "reading_id", "rolling_average_consumption", "consumption_variance", "peak_usage_ratio", "night_usage_ratio"
    )


@query(
    "electrical_features",
    over_features("""SELECT reading_id, weather_consumption_ratio, power_factor_loss, voltage_irregularity, current_power_gap FROM features"""),
)
def _electrical(spark, folder):
    return feats.electrical_features(readings(spark, folder)).select(
        "reading_id", "weather_consumption_ratio", "power_factor_loss", "voltage_irregularity", "current_power_gap"
    )


PROFILE_COLUMNS = [f"usage_profile_{p}" for p in ("ac_heavy", "commercial", "industrial", "night_usage", "residential")]
REGION_COLUMNS = [f"region_{r}" for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")]


@query(
    "one_hot_profile",
    over_readings(
        "SELECT reading_id, power, 0e0 AS \"weather_condition_Snow\", "
        + ", ".join(f"CASE WHEN usage_profile = '{c[14:]}' THEN 1e0 ELSE 0e0 END AS {c}" for c in PROFILE_COLUMNS)
        + ", "
        + ", ".join(f"CASE WHEN region = '{c[7:]}' THEN 1e0 ELSE 0e0 END AS \"{c}\"" for c in REGION_COLUMNS)
        + " FROM readings"
    ),
)
def _one_hot(spark, folder):
    # A stored column list: categories the data lacks are 0, numeric columns it does not name are left out.
    wanted = ["power", "weather_condition_Snow", *PROFILE_COLUMNS, *REGION_COLUMNS]
    return feats.encode_features(readings(spark, folder), wanted, keep=["reading_id"])


@query(
    "feature_vectors",
    over_readings("""
, w AS (SELECT 21 + count(DISTINCT region) + count(DISTINCT area) + count(DISTINCT weather_condition) + count(DISTINCT usage_profile) AS width FROM readings)
SELECT reading_id, cast(width AS int) AS width FROM readings, w"""),
)
def _vectors(spark, folder):
    from pyspark.ml.functions import vector_to_array

    df = features(spark, folder)
    columns = feats.design_columns(readings(spark, folder))
    full = [*[c for c in feats.MODEL_NUMERIC], *[c for c in columns if c not in feats.MODEL_NUMERIC]]
    vectors = feats.assemble(df, full, keep=["reading_id"])
    return vectors.select("reading_id", F.size(vector_to_array("features")).alias("width"))


@query(
    "duplicate_removal",
    over_readings("""
SELECT reading_id, meter_id, tick FROM readings
QUALIFY row_number() OVER (PARTITION BY meter_id, tick ORDER BY reading_id) = 1"""),
)
def _drop_repeats(spark, folder):
    return clean.drop_repeats(readings(spark, folder), "tick").select("reading_id", "meter_id", "tick")
