"""Query registry, shared inputs and the SQL the oracles start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.clean import clean_readings
from meterlake.operators.efficiency import efficiency_metrics
from meterlake.operators.features import add_engineered_features
from meterlake.operators.risk import score_risk
from meterlake.operators.theft import classify
from meterlake.sources.tables import meter_readings

ANOMALY_CUT = 0.7

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain_time(df: DataFrame) -> DataFrame:
    """Timestamps without zone, which compare alike in every engine."""
    return df.select(
        [F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain_time(build(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return clean_readings(meter_readings(spark, folder))


def features(spark: SparkSession, folder: str) -> DataFrame:
    return add_engineered_features(readings(spark, folder))


def flagged(df: DataFrame) -> DataFrame:
    return df.withColumn("is_anomaly", (F.col("anomaly_score") >= ANOMALY_CUT).cast("int"))


def statused(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned readings with status and efficiency; no windows."""
    return efficiency_metrics(classify(flagged(readings(spark, folder))))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Features, bound model scores, status, risk and efficiency of every reading."""
    return efficiency_metrics(
        score_risk(classify(flagged(features(spark, folder))), unit=("night_usage_ratio",))
    )


# ---- SQL -----------------------------------------------------------------------------------------

READINGS = """
kv AS (
  SELECT *, cast(cast(json_extract_string(props, '$.k') AS int) AS double) AS k FROM events
),
measured AS (
  SELECT e.event_id AS reading_id,
    concat('M', lpad(cast(e.user_id AS varchar), 6, '0')) AS meter_id,
    e.ts AS "timestamp", date_trunc('hour', e.ts) AS tick,
    r.r_name AS region, n.n_name AS area,
    cast(1280 + (e.user_id * 7) % 40 AS double) / 1e2 AS latitude,
    cast(7745 + (e.user_id * 11) % 35 AS double) / 1e2 AS longitude,
    e.value AS consumption_kwh,
    e.value * (1e0 + k / 2e2) AS power,
    195e0 + cast((e.event_id * 37) % 58 AS double) AS voltage,
    (60e0 + cast((e.event_id * 17) % 40 AS double)) / 1e2 AS power_factor,
    -12e0 + cast((e.event_id * 13) % 66 AS double) AS temperature,
    35e0 + cast((e.event_id * 7) % 64 AS double) AS humidity,
    cast((e.event_id * 11) % 50 AS double) / 1e1 AS rainfall,
    5e-1 + cast((e.event_id * 5) % 40 AS double) / 1e1 AS wind_speed,
    20e0 + cast((e.event_id * 29) % 60 AS double) AS expected_consumption_kwh,
    CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END AS is_theft,
    CASE WHEN e.event_type = 'error' THEN 'tampered_meter' ELSE 'none' END AS theft_type,
    CASE c.c_mktsegment WHEN 'HOUSEHOLD' THEN 'residential' WHEN 'BUILDING' THEN 'commercial'
      WHEN 'MACHINERY' THEN 'industrial' WHEN 'AUTOMOBILE' THEN 'ac_heavy'
      WHEN 'FURNITURE' THEN 'night_usage' END AS usage_profile,
    k / 1e2 AS seeded_theft_probability,
    k / 99e0 AS random_forest_probability,
    cast((e.event_id * 31) % 100 AS double) / 99e0 AS xgboost_probability,
    35e-2 + cast((e.event_id * 19) % 45 AS double) / 1e2 AS anomaly_score
  FROM kv e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
raw AS (
  SELECT *,
    greatest((consumption_kwh - expected_consumption_kwh) / greatest(expected_consumption_kwh, 1e-1), 0e0) AS wastage_score,
    power * 1e3 / greatest(voltage * power_factor, 1e0) AS current,
    CASE WHEN rainfall > 3.5e0 THEN 'Thunderstorm' WHEN rainfall > 1.1e0 THEN 'Rain'
      WHEN humidity > 82e0 THEN 'Clouds' WHEN temperature > 31e0 THEN 'Clear' ELSE 'Haze' END AS weather_condition
  FROM measured
),
readings AS (
  SELECT *,
    CASE WHEN wastage_score >= 25e-2 OR power_factor < 8e-1 THEN 1 ELSE 0 END AS wastage_flag,
    round_even((power - consumption_kwh) * 1e3, 0) / 1e3 AS power_gap,
    CASE WHEN temperature > -10 AND temperature <= 20 THEN 'cool' WHEN temperature > 20 AND temperature <= 26 THEN 'mild'
      WHEN temperature > 26 AND temperature <= 32 THEN 'warm' WHEN temperature > 32 AND temperature <= 50 THEN 'hot'
      ELSE 'nan' END AS temperature_band
  FROM raw
)"""

FEATURES = (
    READINGS
    + """,
units AS (
  SELECT *, cast(hour("timestamp") AS int) AS hour_of_day, cast(isodow("timestamp") - 1 AS int) AS day_of_week,
    round_even(consumption_kwh * 1e4, 0) AS x
  FROM readings
),
summed AS (
  SELECT *, cast(count(*) OVER w AS double) AS n, sum(x) OVER w AS sx, sum(x * x) OVER w AS sxx,
    sum(CASE WHEN hour_of_day >= 22 OR hour_of_day <= 5 THEN x ELSE 0e0 END) OVER w AS sn,
    max(consumption_kwh) OVER (PARTITION BY meter_id) AS peak
  FROM units
  WINDOW w AS (PARTITION BY meter_id ORDER BY "timestamp", reading_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
),
features AS (
  SELECT * EXCLUDE (x, n, sx, sxx, sn, peak),
    sx / 1e4 / n AS rolling_average_consumption,
    coalesce(greatest(sxx - sx * sx / n, 0e0) / nullif(n - 1e0, 0e0) / (1e4 * 1e4), 0e0) AS consumption_variance,
    coalesce(consumption_kwh / nullif(peak, 0e0), 0e0) AS peak_usage_ratio,
    coalesce(sn / nullif(sx, 0e0), 0e0) AS night_usage_ratio,
    coalesce(consumption_kwh / nullif(abs(temperature) + humidity / 1e2 + rainfall * 8e-1 + wind_speed * 6e-1 + 1e0, 0e0), 0e0)
      AS weather_consumption_ratio,
    1e0 - least(greatest(power_factor, 0e0), 1e0) AS power_factor_loss,
    abs(voltage - 230e0) / 230e0 AS voltage_irregularity,
    abs(power - consumption_kwh) AS current_power_gap
  FROM summed
)"""
)


def status_sql(source: str) -> str:
    return f"""
blended AS (
  SELECT *, 45e-2 * random_forest_probability + 55e-2 * xgboost_probability AS theft_probability,
    CASE WHEN anomaly_score >= 7e-1 THEN 1 ELSE 0 END AS is_anomaly
  FROM {source}
),
classified AS (
  SELECT *, CASE WHEN theft_probability >= 8e-1 THEN 'Electricity Theft' WHEN is_anomaly = 1 THEN 'Anomaly'
    WHEN wastage_score >= 35e-2 THEN 'Power Wastage' ELSE 'Normal' END AS status
  FROM blended
)"""


def efficiency_sql(source: str, name: str) -> str:
    return f"""
useful AS (
  SELECT * EXCLUDE (wastage_flag), least(expected_consumption_kwh, consumption_kwh) AS useful,
    nullif(greatest(expected_consumption_kwh, consumption_kwh), 0e0) AS total
  FROM {source}
),
efficient AS (
  SELECT * EXCLUDE (useful, total),
    round_even(least(greatest(coalesce(useful / total, 0e0) * power_factor, 0e0), 1e0) * 1e2 * 1e2, 0) / 1e2 AS efficiency_score,
    round_even((greatest(consumption_kwh - useful, 0e0) + (1e0 - power_factor) * consumption_kwh) * 1e3, 0) / 1e3 AS estimated_losses_kwh
  FROM useful
),
{name} AS (
  SELECT *, CASE WHEN efficiency_score < 72e0 OR wastage_score >= 25e-2 THEN 1 ELSE 0 END AS wastage_flag FROM efficient
)"""


def norm_sql(value: str, low: str, high: str) -> str:
    return f"""CASE WHEN {high} <= 1e0 THEN least(greatest({value}, 0e0), 1e0)
      WHEN abs({high} - {low}) <= 1e-8 + 1e-5 * abs({low}) THEN 0e0
      ELSE least(greatest(({value} - {low}) / nullif({high} - {low}, 0e0), 0e0), 1e0) END"""


def risk_sql(source: str, name: str) -> str:
    parts = {
        "anomaly_score": "a", "random_forest_probability": "rf", "xgboost_probability": "bo",
        "theft_probability": "tp", "voltage_irregularity": "vo", "night_usage_ratio": "ni",
    }
    limits = ", ".join(f"min(greatest({c}, 0e0)) AS {s}_lo, max(greatest({c}, 0e0)) AS {s}_hi" for c, s in parts.items())
    n = {s: norm_sql(f"greatest({c}, 0e0)", f"{s}_lo", f"{s}_hi") for c, s in parts.items()}
    return f"""
ranges AS (SELECT {limits} FROM {source}),
parts AS (
  SELECT s.*, {n['a']} AS p_a, {n['vo']} AS p_v, {n['ni']} AS p_n,
    45e-2 * {n['rf']} + 55e-2 * {n['bo']} + 20e-2 * {n['tp']} AS t_raw
  FROM {source} s, ranges
),
t_range AS (SELECT min(t_raw) AS t_lo, max(t_raw) AS t_hi FROM parts),
normed AS (SELECT p.* EXCLUDE (t_raw), {norm_sql('t_raw', 't_lo', 't_hi')} AS p_t FROM parts p, t_range),
weighed AS (
  SELECT *, round_even((35e-2 * p_a + 35e-2 * p_t + 15e-2 * p_v + 15e-2 * p_n) * 1e2 * 1e2, 0) / 1e2 AS risk_score FROM normed
),
{name} AS (
  SELECT * EXCLUDE (p_a, p_t, p_v, p_n),
    CASE WHEN risk_score < 35e0 THEN 'Low' WHEN risk_score < 60e0 THEN 'Medium' WHEN risk_score < 80e0 THEN 'High' ELSE 'Critical' END AS risk_level,
    CASE WHEN p_a = greatest(p_a, p_t, p_v, p_n) THEN 'Anomaly-driven risk'
      WHEN p_t = greatest(p_a, p_t, p_v, p_n) THEN 'Theft probability dominated'
      WHEN p_v = greatest(p_a, p_t, p_v, p_n) THEN 'Voltage irregularity dominated'
      ELSE 'High night usage dominated' END AS risk_summary
  FROM weighed
)"""


STATUSED = READINGS + "," + status_sql("readings") + "," + efficiency_sql("classified", "statused")
SCORED = (
    FEATURES + "," + status_sql("features") + "," + risk_sql("classified", "risky") + "," + efficiency_sql("risky", "scored")
)


def over_readings(body: str) -> str:
    return f"WITH {READINGS}\n{body}"


def over_features(body: str) -> str:
    return f"WITH {FEATURES}\n{body}"


def over_statused(body: str) -> str:
    return f"WITH {STATUSED}\n{body}"


def over_scored(body: str) -> str:
    return f"WITH {SCORED}\n{body}"


def sum_sql(col: str, digits: int = 6) -> str:
    return f"(cast(sum(cast(round_even(({col}) * 1e{digits}, 0) AS hugeint)) AS double) / 1e{digits})"


def avg_sql(col: str, digits: int = 6) -> str:
    return f"({sum_sql(col, digits)} / nullif(cast(count({col}) AS double), 0e0))"


def round_sql(col: str, digits: int) -> str:
    return f"(round_even(({col}) * 1e{digits}, 0) / 1e{digits})"


def count_sql(cond: str) -> str:
    return f"cast(count(*) FILTER (WHERE {cond}) AS bigint)"
