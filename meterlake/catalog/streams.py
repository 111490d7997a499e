"""Streaming queries: the tables are read as streams, driven to their end, and the result table returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.catalog.base import (
    ORACLES,
    avg_sql,
    count_sql,
    flagged,
    over_features,
    over_readings,
    over_statused,
    query,
)
from meterlake.catalog.insight import SHIFTED, concept_sql, shift_sql
from meterlake.catalog.rollups import TOTALS
from meterlake.catalog.scoring import CANDIDATES
from meterlake.catalog.sources import scratch
from meterlake.operators import efficiency, risk, rollups
from meterlake.operators.clean import clean_readings
from meterlake.operators.features import add_engineered_features
from meterlake.operators.theft import classify, promote_candidate
from meterlake.schema import SUSPICIOUS
from meterlake.sources.tables import SCHEMAS, meter_readings, table
from meterlake.streaming import feeds
from meterlake.streaming.live import LiveState


def reading_stream(spark, folder):
    events = feeds.read_stream(spark, folder, SCHEMAS["events"], only="events.parquet")
    return clean_readings(meter_readings(spark, folder, events))


def slices(spark, folder, path: str, held_back: bool = False):
    """The events as a feed that arrives in three slices of time, each of several files; yields a stream for each, and whether it is the last.

    `held_back`: the first reading of all comes with the last slice.
    """
    events = table(spark, folder, "events")
    first = F.col("event_id") == (first_reading(spark, folder) if held_back else F.lit(None))
    cuts = [None, "2024-01-11", "2024-01-21", None]
    for low, high in zip(cuts, cuts[1:]):
        part = events if low is None else events.where((F.col("ts") >= F.lit(low).cast("timestamp_ntz")) | ((high is None) & F.coalesce(first, F.lit(False))))
        part = part if high is None else part.where((F.col("ts") < F.lit(high).cast("timestamp_ntz")) & ~F.coalesce(first, F.lit(False)))
        part.repartition(3, "event_id").write.mode("append").parquet(path)
        files = feeds.read_stream(spark, path, SCHEMAS["events"])
        yield clean_readings(meter_readings(spark, folder, files)), high is None


def first_reading(spark, folder):
    return meter_readings(spark, folder).where(F.col("timestamp") < F.lit("2024-01-11").cast("timestamp")).agg(F.min("reading_id")).scalar()


HELD_BACK = "(SELECT min(reading_id) FROM readings WHERE \"timestamp\" < TIMESTAMP '2024-01-11')"


def demand_feed(spark, folder) -> str:
    base = scratch(spark, "stream")
    for stream, _ in slices(spark, folder, f"{base}/events", held_back=True):
        feeds.run_hourly_demand(classify(flagged(stream)), base)
    return base


@query("stream_hourly_demand", over_statused(f"SELECT {TOTALS} FROM statused WHERE reading_id <> {HELD_BACK} GROUP BY tick"))
def _demand(spark, folder):
    base = demand_feed(spark, folder)
    return feeds.hourly_table(spark, base)


@query(
    "stream_late_hours",
    over_statused(f'SELECT tick AS "timestamp", count(*) AS "rows", {count_sql("is_anomaly = 1")} AS anomalies FROM statused WHERE reading_id = {HELD_BACK} GROUP BY tick'),
)
def _late(spark, folder):
    return feeds.late_hours(spark, demand_feed(spark, folder)).select("timestamp", "rows", "anomalies")


@query("stream_dedup", over_readings("SELECT DISTINCT meter_id, tick FROM readings"))
def _dedup(spark, folder):
    stream = reading_stream(spark, folder).select("meter_id", "tick")
    return feeds.run_to_table(feeds.without_repeats(stream, "tick"), scratch(spark, "stream"), "unique")


@query(
    "stream_rolling_features",
    over_features("""SELECT reading_id, rolling_average_consumption, consumption_variance, night_usage_ratio,
  coalesce(consumption_kwh / nullif(max(consumption_kwh) OVER (PARTITION BY meter_id ORDER BY "timestamp", reading_id ROWS UNBOUNDED PRECEDING), 0), 0) AS peak_usage_ratio
FROM features"""),
)
def _rolling(spark, folder):
    base = scratch(spark, "stream")
    for stream, last in slices(spark, folder, f"{base}/events"):
        rolled = feeds.run_rolling_features(stream, base, finish=last)
    return rolled.select("reading_id", "rolling_average_consumption", "consumption_variance", "night_usage_ratio", "peak_usage_ratio")


@query(
    "stream_recent_buffer",
    over_statused("""
, ranked AS (SELECT *, dense_rank() OVER (ORDER BY tick DESC) AS nth FROM statused)
SELECT reading_id, tick, status FROM ranked WHERE nth <= 36"""),
)
def _buffer(spark, folder):
    base = scratch(spark, "stream")
    for stream, last in slices(spark, folder, f"{base}/events"):
        scored = feeds.run_ticks(stream, base, lambda df: classify(flagged(df)), time_col="tick", finish=last)
    return feeds.recent_buffer(scored, time_col="tick").select("reading_id", "tick", "status")


def score_ticks(df):
    """Score every tick on its own: windows, candidate promotion and risk scale restart per tick."""
    scored = promote_candidate(classify(flagged(add_engineered_features(df, "tick", scope="tick"))), "tick")
    return efficiency.efficiency_metrics(risk.score_risk(scored, by="tick", unit=("night_usage_ratio",)))


@query(
    "stream_scored_ticks",
    over_statused(
        CANDIDATES
        + f"""
, promoted AS (SELECT * EXCLUDE (status), CASE WHEN has_theft = 0 AND nth = 1 THEN 'Electricity Theft' ELSE status END AS status FROM ticked)
, recent AS (SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY tick DESC) AS d FROM promoted) WHERE d <= 36)
SELECT {TOTALS} FROM recent GROUP BY tick ORDER BY tick DESC LIMIT 24"""
    ),
)
def _ticks(spark, folder):
    base = scratch(spark, "stream")
    for stream, last in slices(spark, folder, f"{base}/events"):
        feeds.run_ticks(
            stream,
            base,
            score_ticks,
            snapshots={
                "live_predictions": lambda recent: rollups.at_latest(recent, "tick"),
                "recent_predictions": lambda recent: recent,
                "area_risk": risk.risk_by_area,
                "efficiency_metrics": lambda recent: efficiency.efficiency_by_area(rollups.at_latest(recent, "tick")),
                "live_timeline": lambda recent: rollups.live_timeline(recent, time_col="tick"),
            },
            side_outputs={
                "heat_points": (3, lambda scored: rollups.heat_points(scored, time_col="tick")),
                "report_tables": (6, rollups.report_tables),
            },
            time_col="tick",
            finish=last,
        )
    return feeds.newest_snapshot(spark, base, "live_timeline")


#: Scored ticks as `score_ticks` leaves them, as far as the tables below need them.
PROMOTED = CANDIDATES + """
, promoted AS (
  SELECT * EXCLUDE (theft_probability), CASE WHEN has_theft = 0 AND nth = 1 THEN greatest(theft_probability, 81e-2) ELSE theft_probability END AS theft_probability,
    round_even(consumption_kwh * 1e4, 0) AS x, 1e0 - least(greatest(power_factor, 0e0), 1e0) AS power_factor_loss, abs(voltage - 230e0) / 230e0 AS voltage_irregularity
  FROM ticked
)"""


def live_table(spark, folder, name):
    base = scratch(spark, "stream")
    state = LiveState(spark, base, ["meter_id", "tick", *SHIFTED, "theft_probability", "status"], "tick", names=(name,))
    for stream, last in slices(spark, folder, f"{base}/events"):
        feeds.run_ticks(stream, base, score_ticks, state=state.tables, time_col="tick", finish=last)
    return feeds.newest_snapshot(spark, base, name)


@query(
    "stream_consumer_segments",
    over_statused(
        PROMOTED
        + f"""
, rolled AS (
  SELECT *, coalesce(consumption_kwh / nullif(max(consumption_kwh) OVER (PARTITION BY meter_id, tick), 0e0), 0e0) AS peak_usage_ratio,
    coalesce(sum(CASE WHEN hour(tick) >= 22 OR hour(tick) <= 5 THEN x ELSE 0e0 END) OVER w / nullif(sum(x) OVER w, 0e0), 0e0) AS night_usage_ratio
  FROM promoted WINDOW w AS (PARTITION BY meter_id, tick ORDER BY tick, reading_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
), sums AS (
  SELECT meter_id, arg_max(area, struct_pack(t := tick, k := reading_id)) AS area, {avg_sql('consumption_kwh')} AS avg_consumption_kwh,
    max(consumption_kwh) AS peak_consumption_kwh, {avg_sql('night_usage_ratio')} AS night_usage_ratio, {avg_sql('peak_usage_ratio')} AS peak_usage_ratio,
    {avg_sql('power_factor_loss')} AS power_factor_loss, {avg_sql('voltage_irregularity')} AS voltage_irregularity,
    cast(count(*) AS double) AS n, cast(sum(cast(x AS hugeint)) AS double) AS sx, cast(sum(cast(x AS hugeint) * cast(x AS hugeint)) AS double) AS sxx,
    max(theft_probability) AS theft_probability, max(anomaly_score) AS anomaly_score
  FROM rolled GROUP BY meter_id
), cut AS (SELECT round_even(quantile_cont(anomaly_score, 85e-2) * 1e6, 0) / 1e6 AS q FROM sums)
SELECT * EXCLUDE (n, sx, sxx, q), coalesce(sqrt(greatest(sxx - sx * sx / n, 0e0) / nullif(n - 1e0, 0e0)) / 1e4, 0e0) AS consumption_std,
  theft_probability >= 75e-2 OR anomaly_score >= q AS suspicious FROM sums, cut"""
    ),
)
def _live_segments(spark, folder):
    found = live_table(spark, folder, "consumer_segments").withColumn("suspicious", F.col("segment") == SUSPICIOUS)
    return found.drop("region", "usage_profile", "segment", "kmeans_cluster", "dbscan_cluster", "is_core")


@query("stream_forecast_snapshots", ORACLES["forecast_snapshot"])
def _live_forecasts(spark, folder):
    return live_table(spark, folder, "forecast_snapshots")


@query(
    "stream_drift_reports",
    over_statused(
        PROMOTED
        + f"""
, recent AS (SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY tick DESC) AS d FROM promoted) WHERE d <= 36)
, shifts AS ({shift_sql([*SHIFTED, 'theft_probability'], 'promoted', 'recent')})
, concept AS ({concept_sql('promoted', 'recent')})
, repeats AS (SELECT coalesce(max(n), 0) > 1 AS r FROM (SELECT count(*) AS n FROM recent GROUP BY meter_id, tick))
SELECT CASE WHEN (SELECT coalesce(bool_or(drift_detected), false) FROM shifts) OR detected OR r THEN 1 ELSE 0 END AS drift_detected,
  (SELECT {count_sql('drift_detected')} FROM shifts) AS drifted_features, 0e0 AS reference_missing_pct, 0e0 AS current_missing_pct,
  CASE WHEN r THEN 1 ELSE 0 END AS issue_count, CASE WHEN r THEN 'Duplicate meter/timestamp rows detected in current data.' ELSE '' END AS issues,
  theft_rate_shift, prediction_rate_shift, CASE WHEN detected THEN 1 ELSE 0 END AS concept_drift_detected FROM concept, repeats"""
    ),
)
def _live_drift(spark, folder):
    return live_table(spark, folder, "drift_reports")
