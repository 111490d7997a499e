"""Segment, forecast, drift, explanation and alert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.catalog.base import (
    avg_sql,
    count_sql,
    features,
    flagged,
    over_features,
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
from meterlake.operators import alerts, drift, efficiency, explain, forecast, risk, rollups, segments
from meterlake.operators.theft import classify
from meterlake.schema import MODEL_NUMERIC, PROFILE_FEATURES

# ---- segments ------------------------------------------------------------------------------------

PROFILE = f"""
, blended AS (SELECT *, 45e-2 * random_forest_probability + 55e-2 * xgboost_probability AS theft_probability FROM features)
, sums AS (
  SELECT meter_id, arg_max(region, struct_pack(t := "timestamp", k := reading_id)) AS region,
    arg_max(area, struct_pack(t := "timestamp", k := reading_id)) AS area,
    arg_max(usage_profile, struct_pack(t := "timestamp", k := reading_id)) AS usage_profile,
    {avg_sql('consumption_kwh')} AS avg_consumption_kwh, max(consumption_kwh) AS peak_consumption_kwh,
    cast(count(*) AS double) AS n, cast(sum(cast(round_even(consumption_kwh * 1e4, 0) AS hugeint)) AS double) AS sx,
    cast(sum(cast(round_even(consumption_kwh * 1e4, 0) AS hugeint) * cast(round_even(consumption_kwh * 1e4, 0) AS hugeint)) AS double) AS sxx,
    {avg_sql('night_usage_ratio')} AS night_usage_ratio, {avg_sql('peak_usage_ratio')} AS peak_usage_ratio,
    {avg_sql('power_factor_loss')} AS power_factor_loss, {avg_sql('voltage_irregularity')} AS voltage_irregularity,
    max(theft_probability) AS theft_probability, max(anomaly_score) AS anomaly_score
  FROM blended GROUP BY meter_id
), profile AS (
  SELECT * EXCLUDE (n, sx, sxx), coalesce(sqrt(greatest(sxx - sx * sx / n, 0e0) / nullif(n - 1e0, 0e0)) / 1e4, 0e0) AS consumption_std FROM sums
)"""


def profile(spark, folder):
    return segments.consumer_profile(classify(flagged(features(spark, folder))))


@query("consumer_profile", over_features(PROFILE + "SELECT * FROM profile"))
def _profile(spark, folder):
    return profile(spark, folder)


def _units(c: str) -> str:
    return f"cast(round_even({c} * 1e6, 0) AS hugeint)"


ZSCORES = (
    PROFILE
    + ", moments AS (SELECT cast(count(*) AS double) AS n, "
    + ", ".join(
        f"cast(sum({_units(c)}) AS double) AS {c}_s, cast(sum({_units(c)} * {_units(c)}) AS double) AS {c}_q, min({_units(c)}) = max({_units(c)}) AS {c}_f"
        for c in PROFILE_FEATURES
    )
    + " FROM profile), z AS (SELECT meter_id, "
    + ", ".join(
        f"coalesce(({c} - {c}_s / n / 1e6) / nullif(CASE WHEN {c}_f THEN 0e0 ELSE sqrt(greatest({c}_q - {c}_s * {c}_s / n, 0e0) / n) / 1e6 END, 0e0), 0e0) AS z_{c}"
        for c in PROFILE_FEATURES
    )
    + " FROM profile, moments)"
)


@query("profile_zscores", over_features(ZSCORES + "SELECT meter_id, " + ", ".join(f"round_even(z_{c} * 1e6, 0) / 1e6 AS z_{c}" for c in PROFILE_FEATURES) + " FROM z"))
def _zscores(spark, folder):
    from meterlake.functions.numeric import round_to

    z = segments.standardise(profile(spark, folder))
    return z.select("meter_id", *[round_to(F.col(f"z_{c}"), 6).alias(f"z_{c}") for c in PROFILE_FEATURES])


BOUND = PROFILE + """
, clustered AS (SELECT * EXCLUDE (theft_probability, anomaly_score), theft_probability * 8e-1 AS theft_probability,
  consumption_std / 1e3 AS anomaly_score, cast(cast(substr(meter_id, 2) AS int) % 4 AS int) AS kmeans_cluster FROM profile)
, means AS (SELECT kmeans_cluster, """ + avg_sql("avg_consumption_kwh") + """ AS m FROM clustered GROUP BY 1)
, names AS (SELECT kmeans_cluster, (['Residential', 'Commercial', 'Industrial'])[least(row_number() OVER (ORDER BY m, kmeans_cluster), 3)] AS label FROM means)
, cut AS (SELECT round_even(quantile_cont(anomaly_score, 85e-2) * 1e6, 0) / 1e6 AS q FROM clustered)
, segmented AS (
  SELECT c.*, CASE WHEN theft_probability >= 75e-2 OR anomaly_score >= q THEN 'Suspicious cluster' ELSE label END AS segment
  FROM clustered c JOIN names USING (kmeans_cluster), cut
)"""


def bound_segments(spark, folder):
    """Profiles with a bound cluster number and bound scores, so that naming and overriding can be
    checked exactly and not every meter is suspicious."""
    df = profile(spark, folder).withColumns(
        {
            "kmeans_cluster": F.substring("meter_id", 2, 20).cast("int") % 4,
            "theft_probability": F.col("theft_probability") * 8e-1,
            "anomaly_score": F.col("consumption_std") / 1e3,
        }
    )
    return segments.mark_suspicious(segments.segment_labels(df))


@query("segment_labels", over_features(BOUND + "SELECT meter_id, kmeans_cluster, segment FROM segmented"))
def _labels(spark, folder):
    return bound_segments(spark, folder).select("meter_id", "kmeans_cluster", "segment")


@query(
    "suspicious_meters",
    over_features(BOUND + """SELECT meter_id, area, avg_consumption_kwh, night_usage_ratio, theft_probability FROM segmented
WHERE segment = 'Suspicious cluster' ORDER BY theft_probability DESC, meter_id LIMIT 20"""),
)
def _suspicious(spark, folder):
    return segments.suspicious_members(bound_segments(spark, folder)).select(
        "meter_id", "area", "avg_consumption_kwh", "night_usage_ratio", "theft_probability"
    )


@query(
    "segment_summary",
    over_features(BOUND + f"SELECT segment, count(DISTINCT meter_id) AS meter_count, {avg_sql('avg_consumption_kwh')} AS avg_consumption_kwh FROM segmented GROUP BY 1"),
)
def _segment_summary(spark, folder):
    return segments.segment_summary(bound_segments(spark, folder))


@query(
    "segment_highlights",
    over_features(BOUND + f"""
, s AS (SELECT segment, count(DISTINCT meter_id) AS n, {avg_sql('avg_consumption_kwh')} AS m FROM segmented GROUP BY 1)
SELECT cast(sum(n) AS bigint) AS meters, cast(coalesce(sum(n) FILTER (WHERE segment = 'Suspicious cluster'), 0) AS bigint) AS suspicious,
  (SELECT segment FROM s ORDER BY n DESC, segment LIMIT 1) AS dominant_segment, max(m) AS highest_mean FROM s"""),
)
def _highlights(spark, folder):
    return segments.segment_highlights(bound_segments(spark, folder))


@query(
    "clustering_source",
    over_readings("""
, cut AS (SELECT max(tick) AS t FROM readings)
, h AS (SELECT r.reading_id, r.meter_id, r.consumption_kwh, cast(NULL AS double) AS anomaly_score FROM readings r, cut
  WHERE tick < t)
SELECT * FROM h UNION ALL SELECT r.reading_id, r.meter_id, r.consumption_kwh, r.anomaly_score FROM readings r, cut WHERE tick = t"""),
)
def _source(spark, folder):
    df = readings(spark, folder)
    newest = df.agg(F.max("tick")).scalar()
    history = df.where(F.col("tick") < newest).drop("anomaly_score")
    recent = df.where(F.col("tick") == newest)
    return segments.clustering_source(history, recent).select("reading_id", "meter_id", "consumption_kwh", "anomaly_score")


def _near(a: str, b: str) -> str:
    return " + ".join(f"({a}.z_{c} - {b}.z_{c}) * ({a}.z_{c} - {b}.z_{c})" for c in PROFILE_FEATURES) + " <= 1.15e0 * 1.15e0"


# Plain self-join and transitive closure: quadratic, which is why the operator does not work this way.
DBSCAN = (
    ZSCORES
    + f"""
, sized AS (SELECT greatest(2, least(4, count(*) // 3)) AS m FROM z)
, nb AS (SELECT a.meter_id AS a, b.meter_id AS b FROM z a JOIN z b ON {_near('a', 'b')})
, core AS (SELECT a AS id FROM nb, sized GROUP BY a, m HAVING count(*) >= m)
, ce AS (SELECT a, b FROM nb WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core))
, reach AS (SELECT a, b FROM ce UNION SELECT r.a, e.b FROM reach r JOIN ce e ON r.b = e.a)
, roots AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a)
, numbers AS (SELECT id, cast(dense_rank() OVER (ORDER BY root) - 1 AS int) AS number FROM roots)
, border AS (SELECT nb.a AS id, min(number) AS number FROM nb JOIN numbers n ON nb.b = n.id GROUP BY nb.a)
SELECT z.meter_id, coalesce(n.number, b.number, -1) AS dbscan_cluster, CASE WHEN n.id IS NULL THEN 0 ELSE 1 END AS is_core
FROM z LEFT JOIN numbers n ON z.meter_id = n.id LEFT JOIN border b ON z.meter_id = b.id"""
)


@query("dbscan_clusters", over_features(DBSCAN).replace("WITH ", "WITH RECURSIVE ", 1))
def _dbscan(spark, folder):
    from meterlake.operators.dbscan import dbscan
    from meterlake.plans.session import cut_lineage

    z = cut_lineage(segments.standardise(profile(spark, folder)))
    return dbscan(z, [f"z_{c}" for c in PROFILE_FEATURES], "meter_id")


@query("kmeans_segments")
def _kmeans(spark, folder):
    return segments.cluster_consumers(classify(flagged(features(spark, folder)))).select(
        "meter_id", "avg_consumption_kwh", "kmeans_cluster", "segment"
    )


@query("kmeans_fixed_point", over_features(PROFILE + "SELECT meter_id, true AS nearest FROM profile"))
def _kmeans_rest(spark, folder):
    """Every meter is assigned to the nearest of the clusters' own means: the chosen run has come to rest."""
    from meterlake.plans.session import cut_lineage

    z = [f"z_{c}" for c in PROFILE_FEATURES]
    profiles = cut_lineage(segments.standardise(profile(spark, folder)))
    return segments.kmeans_at_rest(segments.kmeans_clusters(profiles, z), z).select("meter_id", "nearest")


# ---- forecast ------------------------------------------------------------------------------------

SERIES = f"""
, series AS (SELECT 'all' AS series, tick AS "timestamp", {sum_sql('consumption_kwh')} AS consumption_kwh FROM readings GROUP BY tick)
, area_series AS (SELECT area AS series, tick AS "timestamp", {sum_sql('consumption_kwh')} AS consumption_kwh FROM readings GROUP BY area, tick)"""


def tail_sql(source: str) -> str:
    return f"""
, ranged AS (SELECT series, count(*) AS points, min(consumption_kwh) AS low, max(consumption_kwh) AS high FROM {source} GROUP BY 1)
, tails AS (
  SELECT s.series, s."timestamp", cast(row_number() OVER (PARTITION BY s.series ORDER BY s."timestamp" DESC) AS int) AS back,
    round_even(consumption_kwh * 1e3, 0) / 1e3 AS value, coalesce((consumption_kwh - low) / nullif(high - low, 0e0), 0e0) AS sc
  FROM {source} s JOIN ranged r USING (series) WHERE points > 32
  QUALIFY back <= 168
)"""


def baseline_sql(name: str, seasonal: str, level: str) -> str:
    return f"""
, {name}_w AS (
  SELECT series, value, 24 - least(24, count(*) OVER (PARTITION BY series)) + 0 AS gap, 24 - back AS i,
    sum(round_even(value * 1e3, 0)) OVER (PARTITION BY series) / 1e3 / 24e0 AS m FROM tails WHERE back <= 24
)
, {name} AS (SELECT w.series, cast(s.step + 1 AS int) AS step, {seasonal} * w.value + {level} * w.m AS forecast
  FROM {name}_w w JOIN (SELECT unnest(range(0, 168)) AS step) s ON s.step % 24 = w.i)"""


def hourly(spark, folder, by=None):
    return forecast.demand_series(readings(spark, folder), by)


@query("demand_series", over_readings(SERIES + "SELECT * FROM series"))
def _series(spark, folder):
    return hourly(spark, folder)


@query("demand_series_by_area", over_readings(SERIES + "SELECT * FROM area_series"))
def _area_series(spark, folder):
    return hourly(spark, folder, "area")


@query(
    "history_tail",
    over_readings(SERIES + tail_sql("area_series") + 'SELECT series, "timestamp", back, value, CASE WHEN back <= 24 THEN round_even(sc * 1e6, 0) / 1e6 END AS scaled FROM tails'),
)
def _tail(spark, folder):
    return forecast.history_tail(hourly(spark, folder, "area"))


@query(
    "minmax_series",
    over_readings(SERIES + """
, r AS (SELECT series, count(*) AS points, min(consumption_kwh) AS low, max(consumption_kwh) AS high FROM area_series GROUP BY 1)
, m AS (SELECT series, "timestamp", low, high, coalesce((consumption_kwh - low) / nullif(high - low, 0e0), 0e0) AS scaled FROM area_series JOIN r USING (series))
SELECT series, "timestamp", scaled, CASE WHEN high = low THEN low ELSE scaled * (high - low) + low END AS restored FROM m"""),
)
def _minmax(spark, folder):
    scaled = forecast.scale_series(hourly(spark, folder, "area"))
    return scaled.select(
        "series", "timestamp", "scaled", forecast.unscale(F.col("scaled"), F.col("low"), F.col("high")).alias("restored")
    )


@query(
    "lag_matrix",
    over_readings(
        SERIES
        + 'SELECT series, "timestamp", consumption_kwh, '
        + ", ".join(f"lag(consumption_kwh, {i}) OVER w AS lag_{i}" for i in range(1, 25))
        + ' FROM area_series WINDOW w AS (PARTITION BY series ORDER BY "timestamp") QUALIFY lag_24 IS NOT NULL'
    ),
)
def _lags(spark, folder):
    return forecast.lag_matrix(hourly(spark, folder, "area"))


BOTH = SERIES + tail_sql("area_series") + baseline_sql("fa", "65e-2", "35e-2") + baseline_sql("fb", "6e-1", "4e-1")


def both(spark, folder):
    series = hourly(spark, folder, "area")
    return [forecast.baseline_forecast(series, *w) for w in forecast.BASELINES.values()]


for _index, _name in enumerate(("a", "b")):

    @query(f"baseline_forecast_{_name}", over_readings(BOTH + f"SELECT * FROM f{_name}"))
    def _baseline(spark, folder, index=_index):
        return both(spark, folder)[index]


def horizon_sql(source: str) -> str:
    return f"""SELECT series, {round_sql('max(forecast) FILTER (WHERE step = 1)', 2)} AS next_hour,
  {round_sql(sum_sql('CASE WHEN step <= 24 THEN forecast END'), 2)} AS next_day,
  {round_sql(sum_sql('CASE WHEN step <= 168 THEN forecast END'), 2)} AS next_week FROM {source} GROUP BY series"""


@query("forecast_horizons", over_readings(BOTH + horizon_sql("fa")))
def _horizons(spark, folder):
    return forecast.horizons(both(spark, folder)[0])


@query(
    "forecast_ensemble",
    over_readings(
        BOTH
        + f", ha AS ({horizon_sql('fa')}), hb AS ({horizon_sql('fb')}) SELECT series, "
        + ", ".join(f"round_even((ha.{c} + hb.{c}) / 2e0 * 1e2, 0) / 1e2 AS {c}, abs(ha.{c} - hb.{c}) AS {c}_delta" for c in ("next_hour", "next_day", "next_week"))
        + " FROM ha JOIN hb USING (series)"
    ),
)
def _ensemble(spark, folder):
    return forecast.ensemble_horizons(*both(spark, folder))


@query(
    "forecast_compare",
    over_readings(BOTH + """
SELECT series, step, round_even(fa.forecast * 1e2, 0) / 1e2 AS first_kwh, round_even(fb.forecast * 1e2, 0) / 1e2 AS second_kwh,
  round_even(fb.forecast * 1e2, 0) / 1e2 - round_even(fa.forecast * 1e2, 0) / 1e2 AS delta
FROM fa JOIN fb USING (series, step) WHERE step <= 12"""),
)
def _compare(spark, folder):
    return forecast.compare_steps(*both(spark, folder))


@query(
    "forecast_snapshot",
    over_readings(BOTH + """
SELECT series, step, round_even(forecast * 1e2, 0) / 1e2 AS forecast_kwh, 'lstm' AS model_name FROM fa WHERE step <= 48
UNION ALL SELECT series, step, round_even(forecast * 1e2, 0) / 1e2, 'transformer' FROM fb WHERE step <= 48"""),
)
def _snapshot(spark, folder):
    a, b = both(spark, folder)
    return forecast.forecast_snapshot({"lstm": a, "transformer": b})


@query("lag_regression_forecast")
def _regression(spark, folder):
    series = hourly(spark, folder, "area")
    return forecast.lag_forecast(series, forecast.fit_lag_model(series), cap=1.5)


def _lag_unit(i: int) -> str:
    return "1000000" if i == 0 else f"x{i}"


@query(
    "lag_equations",
    over_readings(
        SERIES
        + """
, r AS (SELECT series, count(*) AS points, min(consumption_kwh) AS low, max(consumption_kwh) AS high FROM area_series GROUP BY 1)
, m AS (SELECT series, "timestamp", coalesce((consumption_kwh - low) / nullif(high - low, 0e0), 0e0) AS scaled FROM area_series JOIN r USING (series) WHERE points > 32)
, l AS (SELECT series, cast(round_even(scaled * 1e6, 0) AS bigint) AS y, """
        + ", ".join(f"cast(round_even(lag(scaled, {i}) OVER w * 1e6, 0) AS bigint) AS x{i}" for i in range(1, 25))
        + ' FROM m WINDOW w AS (PARTITION BY series ORDER BY "timestamp") QUALIFY x24 IS NOT NULL)'
        + "SELECT series, count(*) AS windows, concat_ws(',', "
        + ", ".join(f"sum(cast({_lag_unit(i)} AS hugeint) * {_lag_unit(j)})" for i in range(25) for j in range(i, 25))
        + ") AS gram, concat_ws(',', "
        + ", ".join(f"sum(cast({_lag_unit(i)} AS hugeint) * y)" for i in range(25))
        + ") AS moments, true AS solved FROM l GROUP BY series HAVING count(*) >= 64"
    ),
)
def _equations(spark, folder):
    """The sums that a series is fitted from, and whether the coefficients solve their equations."""
    from meterlake.plans.session import cut_lineage

    series = cut_lineage(hourly(spark, folder, "area"))
    sums, models = forecast.lag_equations(series), forecast.fit_lag_model(series)
    solved = sums.select("series", F.lit(None).cast("double").alias("residual")).limit(0) if models is None else models.select("series", "residual")
    sums = sums.join(solved, "series")
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",").alias(c)
    return sums.select("series", "windows", text("gram"), text("moments"), (F.col("residual") < 1e-9).alias("solved"))


# ---- drift ---------------------------------------------------------------------------------------

SPLIT = "2024-01-16"
#: Every numeric column that readings and their cleaned form share.
SHIFTED = [
    "latitude", "longitude", "voltage", "current", "power", "consumption_kwh", "power_factor", "temperature", "humidity", "rainfall", "wind_speed",
    "expected_consumption_kwh", "wastage_score", "seeded_theft_probability", "is_theft", "anomaly_score",
]


def halves(spark, folder):
    df = statused(spark, folder)
    return df.where(F.col("timestamp") < F.lit(SPLIT).cast("timestamp")), df.where(F.col("timestamp") >= F.lit(SPLIT).cast("timestamp"))


HALVES = f"""
, old_half AS (SELECT * FROM statused WHERE "timestamp" < TIMESTAMP '{SPLIT}'), new_half AS (SELECT * FROM statused WHERE "timestamp" >= TIMESTAMP '{SPLIT}')"""


def shift_sql(columns: list[str], old: str, new: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT coalesce({avg_sql(c)}, 0e0) FROM {old}) AS r, (SELECT coalesce({avg_sql(c)}, 0e0) FROM {new}) AS c" for c in columns
    )
    return f"""SELECT feature, {round_sql('r', 4)} AS reference_mean, {round_sql('c', 4)} AS current_mean,
  {round_sql('abs(c - r) / greatest(abs(r), 1e-6)', 4)} AS relative_shift, abs(c - r) / greatest(abs(r), 1e-6) >= 12e-2 AS drift_detected FROM ({rows})"""


@query("mean_shift", over_statused(HALVES + shift_sql(SHIFTED, "old_half", "new_half")))
def _shift(spark, folder):
    return drift.mean_shift(*halves(spark, folder), columns=SHIFTED)


def concept_sql(old: str, new: str) -> str:
    r, c = (f"(SELECT {avg_sql('is_theft')} AS rate, {avg_sql('theft_probability')} AS prob FROM {t})" for t in (old, new))
    return f"""SELECT {round_sql('c.rate - r.rate', 4)} AS theft_rate_shift, {round_sql('c.prob - r.prob', 4)} AS prediction_rate_shift,
  abs(c.rate - r.rate) >= 5e-2 OR abs(c.prob - r.prob) >= 8e-2 AS detected FROM {r} r, {c} c"""


@query("concept_drift", over_statused(HALVES + concept_sql("old_half", "new_half")))
def _concept(spark, folder):
    return drift.concept_drift(*halves(spark, folder))


@query(
    "missing_pct",
    over_readings("""
, g AS (SELECT nullif(usage_profile, 'residential') AS a, nullif(is_theft, 1) AS b, consumption_kwh AS c FROM readings)
, s AS (SELECT cast(sum((a IS NULL)::int + (b IS NULL)::int + (c IS NULL)::int) AS double) / (count(*) * 3) AS share FROM g)
SELECT round_even(share * 1e2 * 1e3, 0) / 1e3 AS missing_pct, share >= 3e-2 AS elevated FROM s"""),
)
def _missing(spark, folder):
    df = readings(spark, folder).select(
        F.nullif("usage_profile", F.lit("residential")).alias("a"), F.nullif("is_theft", F.lit(1)).alias("b"), F.col("consumption_kwh").alias("c")
    )
    return drift.missing_pct(df)


@query(
    "duplicate_keys",
    over_readings('SELECT meter_id, tick AS "timestamp", count(*) AS copies FROM readings GROUP BY 1, 2 HAVING count(*) > 1'),
)
def _duplicates(spark, folder):
    return drift.duplicate_keys(readings(spark, folder), "tick")


REPORT_COLUMNS = ["meter_id", "timestamp", *SHIFTED, "theft_probability", "status"]


@query(
    "drift_report",
    over_statused(f"""
, cut AS (SELECT max(tick) - INTERVAL 3 DAY AS t FROM statused)
, old_rows AS (SELECT s.* FROM statused s, cut WHERE tick < t)
, new_rows AS (SELECT s.* FROM statused s, cut WHERE tick >= t)
, shifts AS ({shift_sql([*SHIFTED, 'theft_probability'], 'old_rows', 'new_rows')})
, concept AS ({concept_sql('old_rows', 'new_rows')})
, repeats AS (SELECT coalesce(max(n), 0) > 1 AS r FROM (SELECT count(*) AS n FROM new_rows GROUP BY meter_id, "timestamp"))
SELECT CASE WHEN (SELECT coalesce(bool_or(drift_detected), false) FROM shifts) OR detected OR r THEN 1 ELSE 0 END AS drift_detected,
  (SELECT {count_sql('drift_detected')} FROM shifts) AS drifted_features, 0e0 AS reference_missing_pct, 0e0 AS current_missing_pct,
  CASE WHEN r THEN 1 ELSE 0 END AS issue_count, CASE WHEN r THEN 'Duplicate meter/timestamp rows detected in current data.' ELSE '' END AS issues,
  theft_rate_shift, prediction_rate_shift, CASE WHEN detected THEN 1 ELSE 0 END AS concept_drift_detected FROM concept, repeats"""),
)
def _report(spark, folder):
    df = statused(spark, folder)
    newest = df.agg(F.max("tick") - F.make_dt_interval(F.lit(3))).scalar()
    columns = REPORT_COLUMNS
    reference = df.where(F.col("tick") < newest).select(columns)
    current = df.where(F.col("tick") >= newest).select(columns)
    return drift.drift_report(reference, current)


def ks_sql() -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, cast({c} AS double) AS v, {o} AS o, {1 - o} AS n FROM {t}" for c in [*SHIFTED, "theft_probability"] for t, o in (("old_half", 1), ("new_half", 0))
    )
    return f"""
, u AS ({union}), g AS (SELECT feature, v, sum(o) AS o, sum(n) AS n FROM u GROUP BY 1, 2)
, t AS (
  SELECT *, sum(o) OVER (PARTITION BY feature ORDER BY v) AS co, sum(n) OVER (PARTITION BY feature ORDER BY v) AS cn,
    sum(o) OVER (PARTITION BY feature) AS ao, sum(n) OVER (PARTITION BY feature) AS an FROM g
), b AS (
  SELECT feature, least(cast(floor(cast((co - o) * 10 AS double) / cast(ao AS double)) AS int), 9) AS bin,
    max(abs(cast(co AS double) / cast(ao AS double) - cast(cn AS double) / cast(an AS double))) AS gap,
    greatest(cast(sum(o) AS double) / cast(max(ao) AS double), 1e-4) AS p, greatest(cast(sum(n) AS double) / cast(max(an) AS double), 1e-4) AS q
  FROM t GROUP BY 1, 2
)
SELECT feature, {round_sql('max(gap)', 6)} AS ks, {round_sql('sum(round_even((q - p) * ln(q / p) * 1e9, 0)) / 1e9', 6)} AS psi FROM b GROUP BY 1"""


@query("ks_drift", over_statused(HALVES + ks_sql()))
def _ks(spark, folder):
    columns = [*SHIFTED, "theft_probability"]
    old, new = halves(spark, folder)
    return drift.distribution_drift(old.select(columns), new.select(columns))


@query(
    "column_summary",
    over_readings(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count({c}) AS present, {count_sql(f'{c} IS NULL')} AS missing, {avg_sql(c)} AS mean, cast(min({c}) AS double) AS low, cast(max({c}) AS double) AS high FROM readings"
            for c in SHIFTED
        )
    ),
)
def _column_summary(spark, folder):
    return drift.column_summary(readings(spark, folder), SHIFTED)


# ---- explanation and alerts ----------------------------------------------------------------------

IMPORTANCES = {c: (i + 1) / 231 for i, c in enumerate(MODEL_NUMERIC)}


def reasons_sql(source: str) -> str:
    union = ", ".join(
        f"struct_pack(w := -abs(cast({c} AS double) * (cast({i + 1} AS double) / 231e0)), i := {i}, l := '{explain.friendly_name(c)}')" for i, c in enumerate(MODEL_NUMERIC)
    )
    return f"SELECT *, list_transform(list_sort([{union}])[1:3], lambda e: e.l) AS rs FROM {source}"


@query("top_reasons", over_scored(f", x AS ({reasons_sql('scored')}) SELECT reading_id, array_to_string(rs, ', ') AS reason_summary FROM x"))
def _reasons(spark, folder):
    return explain.top_reasons(scored(spark, folder), IMPORTANCES).select("reading_id", "reason_summary")


@query(
    "explain_highest",
    over_scored(f""", h AS (SELECT * FROM scored ORDER BY theft_probability DESC, anomaly_score DESC, reading_id LIMIT 5), x AS ({reasons_sql('h')})
SELECT meter_id, area, array_to_string(rs, ', ') AS reason_summary FROM x"""),
)
def _explain(spark, folder):
    return explain.explain_highest(scored(spark, folder), IMPORTANCES).select("meter_id", "area", "reason_summary")


@query(
    "theft_reasons",
    over_scored(f""", h AS (SELECT * FROM scored WHERE status = 'Electricity Theft' ORDER BY risk_score DESC, theft_probability DESC, reading_id LIMIT 20)
, x AS ({reasons_sql('h')}) SELECT reading_id, risk_score, array_to_string(rs, ', ') AS reason FROM x"""),
)
def _theft_reasons(spark, folder):
    queue = explain.top_reasons(rollups.theft_queue(scored(spark, folder)), IMPORTANCES)
    return queue.select("reading_id", "risk_score", F.col("reason_summary").alias("reason"))


@query("alert_eligible", over_scored("SELECT reading_id, risk_level FROM scored WHERE risk_level IN ('High', 'Critical')"))
def _eligible(spark, folder):
    return alerts.alert_eligible(scored(spark, folder)).select("reading_id", "risk_level")


@query(
    "alert_messages",
    over_scored("""
SELECT CASE WHEN status = 'Electricity Theft' THEN 'Electricity Theft Detected' ELSE 'Smart Grid Risk Alert' END AS title, meter_id, area, risk_score,
  concat('Meter ', meter_id, ' in ', area, ' scored ', printf('%.1f', round_even(risk_score * 1e1, 0) / 1e1), ' with status ', status, '.') AS message
FROM scored WHERE risk_level IN ('High', 'Critical') ORDER BY risk_score DESC, theft_probability DESC, reading_id LIMIT 5"""),
)
def _messages(spark, folder):
    return alerts.alert_messages(alerts.alert_eligible(scored(spark, folder)))


FEED = """
, feed AS (
  SELECT 'Critical' AS severity, 'Electricity Theft Detected' AS category, meter_id, area,
    concat('Risk ', printf('%.1f', round_even(risk_score * 1e1, 0) / 1e1), ' | Probability ', printf('%.2f', round_even(theft_probability * 1e2, 0) / 1e2)) AS summary, "timestamp"
  FROM scored WHERE status = 'Electricity Theft'
  UNION ALL SELECT 'High', 'Anomaly Detected', meter_id, area,
    concat('Anomaly ', printf('%.3f', round_even(anomaly_score * 1e3, 0) / 1e3), ' | Status ', status), "timestamp"
  FROM scored WHERE is_anomaly = 1 OR status = 'Anomaly'
  UNION ALL SELECT 'Medium', 'Energy Wastage', meter_id, area,
    concat('Efficiency ', printf('%.1f', round_even(efficiency_score * 1e1, 0) / 1e1), '% | Losses ', printf('%.2f', round_even(estimated_losses_kwh * 1e2, 0) / 1e2), ' kWh'), "timestamp"
  FROM scored WHERE wastage_flag = 1
)"""


@query("alert_feed", over_scored(FEED + "SELECT * FROM feed"))
def _feed(spark, folder):
    return alerts.alert_feed(scored(spark, folder))


#: Comparisons of two parts of the readings: the last three days with all before, and likely thefts with the rest.
COMPARED = {"late": "tick >= t", "likely": "random_forest_probability >= 5e-1"}


def compared_sql(name: str, cond: str) -> str:
    return f"""
, {name}_old AS (SELECT s.* FROM scored s, late WHERE NOT ({cond})), {name}_new AS (SELECT s.* FROM scored s, late WHERE {cond})
, {name} AS ({concept_sql(f'{name}_old', f'{name}_new')})"""


@query(
    "alert_feed_with_drift",
    over_scored(
        FEED
        + ", late AS (SELECT max(tick) - INTERVAL 3 DAY AS t FROM scored)"
        + "".join(compared_sql(f"by_{n}", c) for n, c in COMPARED.items())
        + "SELECT severity, category, '-' AS compared, count(*) AS alerts, count(DISTINCT area) AS areas FROM feed GROUP BY 1, 2"
        + "".join(f" UNION ALL SELECT 'High', 'Data Drift Detected', '{n}', 1, 1 FROM by_{n} WHERE detected" for n in COMPARED)
    ),
)
def _feed_with_drift(spark, folder):
    """An alert only where the concept drift is one: its own cuts decide, and the two comparisons lie on either side of them."""
    df = scored(spark, folder)
    newest = df.agg(F.max("tick") - F.make_dt_interval(F.lit(3))).scalar()
    sides = {"late": F.col("tick") >= newest, "likely": F.col("random_forest_probability") >= 0.5}
    out = None
    for name, side in sides.items():
        report = drift.concept_drift(df.where(~side), df.where(side)).withColumn("drift_detected", F.col("detected").cast("int"))
        feed = alerts.alert_feed(df, report) if out is None else alerts.alert_feed(df.limit(0), report)
        named = feed.withColumn("compared", F.when(F.col("category") == "Data Drift Detected", F.lit(name)).otherwise(F.lit("-")))
        out = named if out is None else out.unionByName(named)
    return out.groupBy("severity", "category", "compared").agg(F.count("*").alias("alerts"), F.countDistinct("area").alias("areas"))


@query("newest_alerts", over_scored(FEED + 'SELECT * FROM feed ORDER BY "timestamp" DESC, severity, category, meter_id LIMIT 16'))
def _newest(spark, folder):
    return alerts.newest_alerts(alerts.alert_feed(scored(spark, folder)))


@query(
    "alert_counts",
    over_scored(FEED + """SELECT 'severity' AS grouping, severity AS name, count(*) AS alerts FROM feed GROUP BY severity
UNION ALL SELECT 'category', category, count(*) FROM feed GROUP BY category"""),
)
def _counts(spark, folder):
    return alerts.alert_counts(alerts.alert_feed(scored(spark, folder)))


@query("insight_rows")
def _insights(spark, folder):
    from meterlake.plans.session import cut_lineage

    df = cut_lineage(scored(spark, folder))
    area, worst = rollups.consumption_by_area(df).limit(1), risk.risk_by_area(df).limit(1)
    series = forecast.demand_series(df)
    facts = efficiency.efficiency_summary(df).select("low_efficiency", F.col("estimated_losses_kwh").alias("losses"))
    overview = rollups.overview(df)
    return alerts.insight_rows(
        facts.withColumns(
            {
                "top_area": area.select("area").scalar(),
                "top_load": area.select("consumption_kwh").scalar(),
                "top_risk_area": worst.select("area").scalar(),
                "top_risk": worst.select("avg_risk_score").scalar(),
                "next_hour": forecast.horizons(forecast.baseline_forecast(series)).select("next_hour").scalar(),
                "drift": drift.drift_report(*[h.select(REPORT_COLUMNS) for h in halves(spark, folder)]).select("drift_detected").scalar(),
                "anomalies": overview.select("anomalies").scalar(),
                "theft": overview.select("theft").scalar(),
            }
        )
    )
