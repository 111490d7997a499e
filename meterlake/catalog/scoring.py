"""Theft, risk and efficiency queries."""

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
from meterlake.operators import anomaly, efficiency, risk, theft


@query(
    "blend_status",
    over_statused("SELECT reading_id, theft_probability, is_anomaly, status FROM statused"),
)
def _blend(spark, folder):
    return statused(spark, folder).select("reading_id", "theft_probability", "is_anomaly", "status")


@query(
    "anomaly_threshold",
    over_readings("""
, cut AS (SELECT quantile_cont(anomaly_score, 97e-2) AS q FROM readings WHERE is_theft = 0)
SELECT round_even(q * 1e6, 0) / 1e6 AS threshold,
  count(*) FILTER (WHERE anomaly_score >= round_even(q * 1e6, 0) / 1e6) AS anomalies, count(*) AS readings
FROM readings, cut GROUP BY 1"""),
)
def _threshold(spark, folder):
    df = readings(spark, folder).select("reading_id", "anomaly_score", "is_theft")
    cut = anomaly.score_threshold(df.where(F.col("is_theft") == 0))
    marked = anomaly.flag_anomalies(df, cut)
    return marked.agg(
        F.max("threshold").alias("threshold"), F.sum("is_anomaly").cast("bigint").alias("anomalies"), F.count("*").alias("readings")
    )


@query(
    "anomaly_rescale",
    over_readings("""
SELECT reading_id, CASE WHEN hi > lo THEN (anomaly_score - lo) / (hi - lo) ELSE anomaly_score END AS scaled_score
FROM readings, (SELECT min(anomaly_score) AS lo, max(anomaly_score) AS hi FROM readings)"""),
)
def _rescale(spark, folder):
    df = readings(spark, folder).select("reading_id", "anomaly_score")
    return anomaly.rescale_scores(df).select("reading_id", "scaled_score")


SAMPLE_ROWS = 1500


@query(
    "balanced_sample",
    over_readings(f"""
, sized AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE is_theft = 1) AS p FROM readings
), ranked AS (
  SELECT reading_id, is_theft, row_number() OVER (PARTITION BY is_theft
    ORDER BY ((reading_id % 2147483648) * 1103515245 + 12345 * 42) % 2147483648, reading_id) AS nth FROM readings
)
SELECT reading_id, is_theft FROM ranked, sized WHERE n <= {SAMPLE_ROWS}
  OR (is_theft = 1 AND nth <= {SAMPLE_ROWS // 3})
  OR (is_theft = 0 AND nth <= {SAMPLE_ROWS} - least(p, {SAMPLE_ROWS // 3}))"""),
)
def _sample(spark, folder):
    df = readings(spark, folder).select("reading_id", "is_theft")
    return theft.balanced_sample(df, SAMPLE_ROWS)


@query(
    "stratified_split_counts",
    over_readings("""
, ranked AS (
  SELECT is_theft, reading_id, row_number() OVER (PARTITION BY is_theft
    ORDER BY ((reading_id % 2147483648) * 1103515245 + 12345 * 42) % 2147483648, reading_id) AS nth,
    count(*) OVER (PARTITION BY is_theft) AS size FROM readings
)
SELECT is_theft, CASE WHEN nth <= size * 2e-1 THEN 1 ELSE 0 END AS is_test, count(*) AS readings,
  cast(sum(reading_id) AS bigint) AS id_sum FROM ranked GROUP BY 1, 2"""),
)
def _split(spark, folder):
    split = theft.stratified_split(readings(spark, folder).select("reading_id", "is_theft"))
    return split.groupBy("is_theft", "is_test").agg(F.count("*").alias("readings"), F.sum("reading_id").alias("id_sum"))


@query(
    "class_weights",
    over_readings("""
SELECT is_theft, cast(count(*) AS double) AS n, max(total / (2e0 * size)) AS class_weight FROM (
  SELECT is_theft, cast(count(*) OVER () AS double) AS total, cast(count(*) OVER (PARTITION BY is_theft) AS double) AS size FROM readings
) GROUP BY 1"""),
)
def _weights(spark, folder):
    weighted = theft.class_weights(readings(spark, folder).select("is_theft"))
    return weighted.groupBy("is_theft").agg(F.count("*").cast("double").alias("n"), F.max("class_weight").alias("class_weight"))


@query(
    "classifier_metrics",
    over_statused("""
, ranks AS (
  SELECT is_theft, theft_probability,
    2 * rank() OVER (ORDER BY theft_probability) + count(*) OVER (PARTITION BY theft_probability) - 1 AS rank2 FROM statused
), c AS (
  SELECT count(*) FILTER (WHERE theft_probability >= 5e-1 AND is_theft = 1) AS tp,
    count(*) FILTER (WHERE theft_probability >= 5e-1 AND is_theft = 0) AS fp,
    count(*) FILTER (WHERE theft_probability < 5e-1 AND is_theft = 1) AS fn,
    count(*) FILTER (WHERE theft_probability < 5e-1 AND is_theft = 0) AS tn,
    count(*) AS n, cast(sum(CASE WHEN is_theft = 1 THEN rank2 ELSE 0 END) AS double) AS r2 FROM ranks
), d AS (
  SELECT *, cast(tp AS double) AS a, cast(fp AS double) AS b, cast(fn AS double) AS e, cast(tn AS double) AS f,
    cast(tp + fn AS double) AS p, cast(fp + tn AS double) AS q FROM c
)
SELECT tp, fp, fn, tn, n AS "rows", coalesce((a + f) / nullif(a + b + e + f, 0e0), 0e0) AS accuracy,
  coalesce(a / nullif(a + b, 0e0), 0e0) AS "precision", coalesce(a / nullif(a + e, 0e0), 0e0) AS recall,
  coalesce(2e0 * a / nullif(2e0 * a + b + e, 0e0), 0e0) AS f1_score,
  coalesce((r2 / 2e0 - p * (p + 1e0) / 2e0) / nullif(p * q, 0e0), 5e-1) AS roc_auc FROM d"""),
)
def _metrics(spark, folder):
    return theft.classifier_metrics(statused(spark, folder).select("theft_probability", "is_theft"))


@query(
    "label_agreement",
    """
WITH r AS (SELECT quality, toxic, 2 * rank() OVER (ORDER BY quality) + count(*) OVER (PARTITION BY quality) - 1 AS rank2 FROM labels),
c AS (SELECT cast(sum(CASE WHEN toxic = 1 THEN rank2 ELSE 0 END) AS double) AS r2,
  cast(count(*) FILTER (WHERE toxic = 1) AS double) AS p, cast(count(*) FILTER (WHERE toxic <> 1) AS double) AS q FROM r)
SELECT coalesce((r2 / 2e0 - p * (p + 1e0) / 2e0) / nullif(p * q, 0e0), 5e-1) AS roc_auc FROM c""",
)
def _labels(spark, folder):
    return theft.roc_auc(spark.read.parquet(f"{folder}/labels.parquet"), "quality", "toxic")


CANDIDATES = """
, ticked AS (
  SELECT *, max(CASE WHEN status = 'Electricity Theft' THEN 1 ELSE 0 END) OVER (PARTITION BY tick) AS has_theft,
    row_number() OVER (PARTITION BY tick ORDER BY 45e-2 * seeded_theft_probability + 3e-1 * greatest(theft_probability, 0e0)
      + 2e-1 * greatest(anomaly_score, 0e0) + 5e-2 * least(greatest(wastage_score, 0e0), 1e0) DESC, reading_id) AS nth
  FROM statused
)"""


@query(
    "promote_candidate",
    over_statused(CANDIDATES + """
SELECT reading_id, tick,
  CASE WHEN has_theft = 0 AND nth = 1 THEN greatest(theft_probability, 81e-2) ELSE theft_probability END AS theft_probability,
  CASE WHEN has_theft = 0 AND nth = 1 THEN greatest(random_forest_probability, 79e-2) ELSE random_forest_probability END AS random_forest_probability,
  CASE WHEN has_theft = 0 AND nth = 1 THEN greatest(xgboost_probability, 83e-2) ELSE xgboost_probability END AS xgboost_probability,
  CASE WHEN has_theft = 0 AND nth = 1 THEN 'Electricity Theft' ELSE status END AS status
FROM ticked"""),
)
def _promote(spark, folder):
    return theft.promote_candidate(statused(spark, folder), "tick").select(
        "reading_id", "tick", "theft_probability", "random_forest_probability", "xgboost_probability", "status"
    )


@query(
    "rank_tick",
    over_statused("""
SELECT reading_id, tick, theft_probability, anomaly_score FROM statused
WHERE tick = (SELECT max(tick) FROM statused) ORDER BY theft_probability DESC, anomaly_score DESC, reading_id"""),
)
def _rank(spark, folder):
    from meterlake.operators.clean import at_latest

    return theft.rank_tick(at_latest(statused(spark, folder), "tick")).select(
        "reading_id", "tick", "theft_probability", "anomaly_score"
    )


@query(
    "risk_scores",
    over_scored("SELECT reading_id, risk_score, risk_level, risk_summary FROM scored"),
)
def _risk(spark, folder):
    return scored(spark, folder).select("reading_id", "risk_score", "risk_level", "risk_summary")


def _norm_by_tick(value: str) -> str:
    from meterlake.catalog.base import norm_sql

    return norm_sql(value, f"min({value}) OVER t", f"max({value}) OVER t")


@query(
    "risk_scores_by_tick",
    over_scored(f"""
, a AS (
  SELECT reading_id, tick, {_norm_by_tick('anomaly_score')} AS p_a, {_norm_by_tick('voltage_irregularity')} AS p_v,
    {_norm_by_tick('night_usage_ratio')} AS p_n,
    45e-2 * {_norm_by_tick('random_forest_probability')} + 55e-2 * {_norm_by_tick('xgboost_probability')}
      + 20e-2 * {_norm_by_tick('theft_probability')} AS t_raw
  FROM scored WINDOW t AS (PARTITION BY tick)
), b AS (SELECT *, {_norm_by_tick('t_raw')} AS p_t FROM a WINDOW t AS (PARTITION BY tick))
SELECT reading_id, round_even((35e-2 * p_a + 35e-2 * p_t + 15e-2 * p_v + 15e-2 * p_n) * 1e2 * 1e2, 0) / 1e2 AS risk_score FROM b"""),
)
def _risk_tick(spark, folder):
    from meterlake.catalog.base import features, flagged

    df = theft.classify(flagged(features(spark, folder)))
    return risk.score_risk(df, by="tick", unit=("night_usage_ratio",)).select("reading_id", "risk_score")


@query(
    "risk_by_area",
    over_scored(f"""
SELECT area, {avg_sql('risk_score', 2)} AS avg_risk_score, {count_sql("risk_level = 'Critical'")} AS critical_count,
  {count_sql("risk_level = 'High'")} AS high_count, count(DISTINCT meter_id) AS meter_count FROM scored GROUP BY area"""),
)
def _risk_area(spark, folder):
    return risk.risk_by_area(scored(spark, folder))


@query(
    "risk_level_counts",
    over_scored("SELECT " + ", ".join(f"{count_sql(f'risk_level = {n!r}')} AS {n.lower()}" for n in ("Critical", "High", "Medium", "Low")) + " FROM scored"),
)
def _levels(spark, folder):
    return risk.risk_level_counts(scored(spark, folder))


@query(
    "top_risk",
    over_scored("SELECT reading_id, meter_id, risk_score, risk_level, theft_probability FROM scored ORDER BY risk_score DESC, theft_probability DESC, reading_id LIMIT 25"),
)
def _top_risk(spark, folder):
    return risk.top_risk(scored(spark, folder)).select("reading_id", "meter_id", "risk_score", "risk_level", "theft_probability")


for _name, _key in (("risk_desc", "risk_score"), ("prob_desc", "theft_probability"), ("time_desc", '"timestamp"')):

    @query(
        f"theft_sorted_{_name}",
        over_scored(f"""
SELECT row_number() OVER (ORDER BY {_key} DESC, reading_id) AS place, reading_id FROM scored
WHERE status = 'Electricity Theft' ORDER BY {_key} DESC, reading_id LIMIT 40"""),
    )
    def _sorted(spark, folder, mode=_name):
        from pyspark.sql import Window

        from meterlake.operators.clean import search_theft

        key = {"risk_desc": "risk_score", "prob_desc": "theft_probability", "time_desc": "timestamp"}[mode]
        listed = search_theft(scored(spark, folder), sort=mode).limit(40)
        place = F.row_number().over(Window.orderBy(F.desc(key), "reading_id"))  # 40 rows
        return listed.select(place.cast("bigint").alias("place"), "reading_id")


@query(
    "efficiency_metrics",
    over_statused("SELECT reading_id, efficiency_score, estimated_losses_kwh, wastage_flag FROM statused"),
)
def _efficiency(spark, folder):
    return efficiency.efficiency_metrics(readings(spark, folder)).select(
        "reading_id", "efficiency_score", "estimated_losses_kwh", "wastage_flag"
    )


@query(
    "efficiency_summary",
    over_statused(f"""
SELECT {count_sql('wastage_flag = 1')} AS low_efficiency, {round_sql(avg_sql('efficiency_score', 2), 2)} AS average_efficiency,
  {round_sql(sum_sql('estimated_losses_kwh', 3), 2)} AS estimated_losses_kwh FROM statused"""),
)
def _eff_summary(spark, folder):
    return efficiency.efficiency_summary(efficiency.efficiency_metrics(readings(spark, folder)))


@query(
    "worst_efficiency",
    over_statused("SELECT reading_id, meter_id, wastage_flag, efficiency_score FROM statused ORDER BY wastage_flag DESC, efficiency_score, reading_id LIMIT 20"),
)
def _worst(spark, folder):
    return efficiency.worst_efficiency(efficiency.efficiency_metrics(readings(spark, folder))).select(
        "reading_id", "meter_id", "wastage_flag", "efficiency_score"
    )


@query(
    "efficiency_by_area",
    over_statused(f"""
SELECT coalesce(area, 'Unknown') AS area, {avg_sql('efficiency_score', 2)} AS efficiency,
  {sum_sql('estimated_losses_kwh', 3)} AS losses FROM statused GROUP BY 1"""),
)
def _eff_area(spark, folder):
    return efficiency.efficiency_by_area(efficiency.efficiency_metrics(readings(spark, folder)))


@query(
    "mean_pf_loss",
    over_scored(f"""
SELECT {avg_sql('power_factor_loss')} AS mean_power_factor_loss FROM (
  SELECT power_factor_loss FROM scored ORDER BY wastage_flag DESC, efficiency_score, reading_id LIMIT 20)"""),
)
def _pf_loss(spark, folder):
    from meterlake.operators.features import electrical_features

    return efficiency.mean_power_factor_loss(efficiency.efficiency_metrics(electrical_features(readings(spark, folder))))
