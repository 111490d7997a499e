"""Rollup queries over scored readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.catalog.base import (
    avg_sql,
    count_sql,
    over_readings,
    over_scored,
    over_statused,
    query,
    readings,
    round_sql,
    scored,
    statused,
    sum_sql,
)
from meterlake.operators import rollups
from meterlake.operators.clean import at_latest
from meterlake.sources.tables import meter_catalog

LATEST = """
, latest AS (
  SELECT * FROM statused QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY "timestamp" DESC, reading_id DESC) = 1
)"""


@query("latest_per_meter", over_statused(LATEST + 'SELECT meter_id, reading_id, "timestamp", status FROM latest'))
def _latest(spark, folder):
    return rollups.latest_per_meter(statused(spark, folder)).select("meter_id", "reading_id", "timestamp", "status")


@query(
    "latest_meters_newest_first",
    over_statused(LATEST + 'SELECT meter_id, reading_id, "timestamp" FROM latest ORDER BY "timestamp" DESC, reading_id DESC LIMIT 25'),
)
def _latest_head(spark, folder):
    return rollups.latest_per_meter(readings(spark, folder), limit=25).select("meter_id", "reading_id", "timestamp")


@query(
    "overview",
    over_statused(
        LATEST
        + f"""SELECT count(*) AS active_meters, {count_sql('is_anomaly = 1')} AS anomalies, {count_sql("status = 'Electricity Theft'")} AS theft,
  {count_sql('wastage_flag = 1')} AS wastage, (SELECT count(DISTINCT meter_id) FROM statused) AS total_meters FROM latest"""
    ),
)
def _overview(spark, folder):
    return rollups.overview(statused(spark, folder))


@query(
    "consumption_by_area",
    over_readings(f"SELECT area, {sum_sql('consumption_kwh')} AS consumption_kwh FROM readings WHERE area IS NOT NULL GROUP BY 1"),
)
def _area(spark, folder):
    return rollups.consumption_by_area(readings(spark, folder))


IMPACT = f"""temperature_band, {avg_sql('consumption_kwh')} AS avg_consumption, {avg_sql('wastage_score')} AS avg_wastage,
  {avg_sql('humidity')} AS avg_humidity"""


@query("weather_impact", over_readings(f"SELECT {IMPACT} FROM readings GROUP BY 1"))
def _impact(spark, folder):
    return rollups.weather_impact(readings(spark, folder))


TOTALS = f"""tick AS "timestamp", {sum_sql('consumption_kwh')} AS total_consumption, {count_sql('is_anomaly = 1')} AS anomalies,
  {count_sql("status = 'Electricity Theft'")} AS theft"""


@query("tick_totals", over_statused(f"SELECT {TOTALS} FROM statused GROUP BY tick"))
def _totals(spark, folder):
    return rollups.tick_totals(statused(spark, folder), "tick")


@query("live_timeline", over_statused(f"SELECT {TOTALS} FROM statused GROUP BY tick ORDER BY tick DESC LIMIT 24"))
def _timeline(spark, folder):
    return rollups.live_timeline(statused(spark, folder), time_col="tick")


@query("tick_timeline", over_readings('SELECT DISTINCT tick AS "timestamp" FROM readings'))
def _ticks(spark, folder):
    return rollups.tick_timeline(readings(spark, folder), "tick")


@query(
    "anomaly_queue",
    over_scored("""SELECT reading_id, meter_id, area, anomaly_score, risk_score, status FROM scored
WHERE is_anomaly = 1 OR status = 'Anomaly' ORDER BY anomaly_score DESC, risk_score DESC, reading_id LIMIT 25"""),
)
def _anomaly_queue(spark, folder):
    return rollups.anomaly_queue(scored(spark, folder)).select("reading_id", "meter_id", "area", "anomaly_score", "risk_score", "status")


@query(
    "anomaly_summary",
    over_statused(f"""
SELECT count(*) AS count, coalesce({round_sql(avg_sql('anomaly_score'), 3)}, 0e0) AS average_score,
  coalesce({round_sql('max(anomaly_score)', 3)}, 0e0) AS highest_score, count(DISTINCT area) AS impacted_areas
FROM statused WHERE is_anomaly = 1 OR status = 'Anomaly'"""),
)
def _anomaly_summary(spark, folder):
    return rollups.anomaly_summary(statused(spark, folder))


@query(
    "theft_queue",
    over_scored("""SELECT reading_id, meter_id, area, risk_score, theft_probability FROM scored
WHERE status = 'Electricity Theft' ORDER BY risk_score DESC, theft_probability DESC, reading_id LIMIT 20"""),
)
def _theft_queue(spark, folder):
    return rollups.theft_queue(scored(spark, folder)).select("reading_id", "meter_id", "area", "risk_score", "theft_probability")


@query(
    "theft_summary",
    over_scored(f"""
SELECT count(*) AS count, coalesce({round_sql(avg_sql('risk_score', 2), 2)}, 0e0) AS average_risk_score,
  coalesce({round_sql(avg_sql('theft_probability'), 4)}, 0e0) AS average_theft_probability,
  count(DISTINCT CASE WHEN risk_score >= 80e0 THEN area END) AS critical_areas FROM scored WHERE status = 'Electricity Theft'"""),
)
def _theft_summary(spark, folder):
    return rollups.theft_summary(scored(spark, folder))


@query(
    "weather_scatter",
    over_readings("""
, cut AS (SELECT max(tick) AS t FROM readings)
, parts AS (
  SELECT 0 AS part, r.* FROM readings r, cut WHERE tick < t
  UNION ALL SELECT 1, r.* FROM readings r, cut WHERE tick = t
)
SELECT "timestamp", reading_id, temperature, consumption_kwh, wastage_score, area FROM parts
ORDER BY part DESC, "timestamp" DESC, reading_id DESC LIMIT 240"""),
)
def _scatter(spark, folder):
    df = readings(spark, folder)
    newest = df.agg(F.max("tick")).scalar()
    return rollups.weather_scatter(df.where(F.col("tick") < newest), at_latest(df, "tick"))


@query(
    "live_kpis",
    over_statused(f"""
, line AS (SELECT {TOTALS} FROM statused GROUP BY tick ORDER BY tick DESC LIMIT 24)
, now AS (SELECT * FROM statused WHERE tick = (SELECT max(tick) FROM statused))
SELECT arg_max(total_consumption, "timestamp") AS latest_load, max(total_consumption) AS peak_load,
  (SELECT {avg_sql('voltage')} FROM now) AS mean_voltage,
  (SELECT area FROM now GROUP BY area ORDER BY {sum_sql('consumption_kwh')} DESC, area LIMIT 1) AS top_area FROM line"""),
)
def _kpis(spark, folder):
    return rollups.live_kpis(statused(spark, folder), time_col="tick")


@query("top_power", over_readings("SELECT reading_id, meter_id, power FROM readings ORDER BY power DESC, reading_id LIMIT 12"))
def _top_power(spark, folder):
    return rollups.top_power(readings(spark, folder)).select("reading_id", "meter_id", "power")


@query(
    "hotspots",
    over_statused(f"""
SELECT coalesce(area, 'Unknown') AS area, count(*) AS meters, {count_sql("status = 'Electricity Theft'")} AS theft,
  {count_sql("is_anomaly = 1 OR status = 'Anomaly'")} AS anomalies FROM statused GROUP BY 1
ORDER BY theft + anomalies DESC, area LIMIT 10"""),
)
def _hotspots(spark, folder):
    return rollups.hotspots(statused(spark, folder))


@query(
    "heat_points",
    over_statused("""
, p AS (
  SELECT reading_id, meter_id, area, coalesce(latitude, 0e0) AS latitude, coalesce(longitude, 0e0) AS longitude,
    coalesce(theft_probability, 0e0) AS weight
  FROM statused WHERE tick = (SELECT max(tick) FROM statused) AND status = 'Electricity Theft'
)
SELECT *, CASE WHEN row_number() OVER (ORDER BY weight DESC, reading_id) <= 150 THEN 1 ELSE 0 END AS is_marker FROM p"""),
)
def _heat(spark, folder):
    return rollups.heat_points(statused(spark, folder), time_col="tick")


@query(
    "report_tables",
    over_statused(
        LATEST
        + f"""
, o AS (SELECT count(*) AS active_meters, {count_sql('is_anomaly = 1')} AS anomalies, {count_sql("status = 'Electricity Theft'")} AS theft,
  {count_sql('wastage_flag = 1')} AS wastage FROM latest)
, a AS (SELECT area, {sum_sql('consumption_kwh')} AS v FROM latest WHERE area IS NOT NULL GROUP BY 1 ORDER BY v DESC, area LIMIT 8)
, w AS (SELECT {IMPACT} FROM statused GROUP BY 1)
, t AS (SELECT meter_id, theft_probability FROM latest WHERE status = 'Electricity Theft' ORDER BY meter_id LIMIT 10)
SELECT 'overview' AS section, 1 AS position, 'active_meters' AS label, cast(active_meters AS double) AS value FROM o
UNION ALL SELECT 'overview', 2, 'anomalies', cast(anomalies AS double) FROM o
UNION ALL SELECT 'overview', 3, 'theft', cast(theft AS double) FROM o
UNION ALL SELECT 'overview', 4, 'wastage', cast(wastage AS double) FROM o
UNION ALL SELECT 'overview', 5, 'total_meters', cast(active_meters AS double) FROM o
UNION ALL SELECT 'areas', cast(row_number() OVER (ORDER BY v DESC, area) AS int), area, v FROM a
UNION ALL SELECT 'weather', cast(row_number() OVER (ORDER BY temperature_band) AS int), temperature_band, avg_consumption FROM w
UNION ALL SELECT 'theft', cast(row_number() OVER (ORDER BY meter_id) AS int), meter_id, theft_probability FROM t"""
    ),
)
def _report(spark, folder):
    return rollups.report_tables(statused(spark, folder))


@query(
    "score_histogram",
    over_readings("""
, s AS (
  SELECT min(anomaly_score) AS lo, max(anomaly_score) AS hi,
    cast(least(8, greatest(4, ceil(sqrt(cast(count(*) AS double))))) AS int) AS b FROM readings
), p AS (SELECT lo, b, CASE WHEN hi = lo THEN 1e0 ELSE (hi - lo) / cast(b AS double) END AS span, hi FROM s)
, placed AS (
  SELECT CASE WHEN hi = lo THEN 0 ELSE least(b - 1, cast(floor((anomaly_score - lo) / span) AS int)) END AS bucket, count(*) AS n
  FROM readings, p GROUP BY 1
), g AS (SELECT cast(unnest(range(0, b)) AS int) AS bucket, lo, span FROM p)
SELECT g.bucket, lo + cast(g.bucket AS double) * span AS low, lo + cast(g.bucket + 1 AS double) * span AS high, coalesce(n, 0) AS count
FROM g LEFT JOIN placed USING (bucket)"""),
)
def _histogram(spark, folder):
    return rollups.histogram(readings(spark, folder), "anomaly_score")


def area_weather(spark, folder):
    """Newest weather observation of every area."""
    from pyspark.sql import Window

    newest = Window.partitionBy("area").orderBy(F.desc("timestamp"), F.desc("reading_id"))
    return (
        readings(spark, folder)
        .withColumn("_nth", F.row_number().over(newest))
        .where(F.col("_nth") == 1)
        .select("area", "temperature", "humidity", "rainfall", "wind_speed", "weather_condition")
    )


WEATHER_JOIN = f"""
, weather AS (
  SELECT area, temperature, humidity, rainfall, wind_speed, weather_condition FROM readings
  QUALIFY row_number() OVER (PARTITION BY area ORDER BY "timestamp" DESC, reading_id DESC) = 1
), demand AS (
  SELECT area, {sum_sql('consumption_kwh')} AS demand FROM readings WHERE tick = (SELECT max(tick) FROM readings) GROUP BY 1
), joined AS (SELECT w.*, coalesce(d.demand, 0e0) AS demand FROM weather w LEFT JOIN demand d USING (area))"""


@query("weather_demand_join", over_readings(WEATHER_JOIN + "SELECT * FROM joined"))
def _weather_demand(spark, folder):
    now = at_latest(readings(spark, folder), "tick")
    return rollups.weather_demand(area_weather(spark, folder), rollups.consumption_by_area(now))


@query(
    "weather_demand_summary",
    over_readings(
        WEATHER_JOIN
        + f"""SELECT {avg_sql('temperature')} AS mean_temperature, {avg_sql('humidity')} AS mean_humidity,
  {count_sql('rainfall > 0')} AS rainy_areas, (SELECT area FROM joined ORDER BY demand DESC, area DESC LIMIT 1) AS sensitive_area FROM joined"""
    ),
)
def _weather_summary(spark, folder):
    now = at_latest(readings(spark, folder), "tick")
    joined = rollups.weather_demand(area_weather(spark, folder), rollups.consumption_by_area(now))
    return rollups.weather_demand_summary(joined)


@query(
    "data_summary",
    over_readings("""
, cat AS (SELECT concat('M', lpad(cast(c_custkey AS varchar), 6, '0')) AS meter_id, n_name AS area
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT count(*) AS records, round_even(cast(sum(is_theft) AS double) / count(*) * 1e4, 0) / 1e4 AS theft_rate,
  round_even(cast(count(*) FILTER (WHERE wastage_score > 25e-2) AS double) / count(*) * 1e4, 0) / 1e4 AS wastage_rate,
  (SELECT count(DISTINCT meter_id) FROM cat) AS meters,
  (SELECT string_agg(area, ', ' ORDER BY area) FROM (SELECT DISTINCT area FROM cat)) AS areas FROM readings"""),
)
def _summary(spark, folder):
    return rollups.data_summary(readings(spark, folder), meter_catalog(spark, folder))
