from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import alerts, efficiency, explain, risk, rollups, theft
from meterlake.plans.radix import BITS, exact_quantile, running_totals
from meterlake.plans.ranges import ranked_by_hash
from meterlake.schema import THEFT


def test_risk_properties(spark, expanded_frame):
    rows = risk.score_risk(expanded_frame).collect()
    assert all(0 <= r.risk_score <= 100 for r in rows)
    assert {r.risk_level for r in rows} <= {"Low", "Medium", "High", "Critical"}
    mean = lambda m: np.mean([r.risk_score for r in rows if r.meter_id == m])
    assert mean("M0104") > mean("M0101")


def test_known_unit_range_changes_nothing(spark, expanded_frame):
    a = {r.reading_id: r.risk_score for r in risk.score_risk(expanded_frame).collect()}
    b = {r.reading_id: r.risk_score for r in risk.score_risk(expanded_frame, unit=("night_usage_ratio",)).collect()}
    assert a == b


def test_level_borders(spark):
    df = spark.createDataFrame([(34.99,), (35.0,), (60.0,), (80.0,), (100.0,)], "s double")
    assert [r[0] for r in df.select(risk.risk_level(F.col("s"))).collect()] == ["Low", "Medium", "High", "Critical", "Critical"]


@pytest.mark.parametrize(
    "values,expected",
    [([0.2, 1.0], [0.2, 1.0]), ([3.0, 3.0], [0.0, 0.0]), ([1.0, 2.0, 3.0], [0.0, 0.5, 1.0]), ([-1.0, 0.5], [0.0, 0.5])],
)
def test_conditional_normalising(spark, values, expected):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").withColumn("v", F.greatest("v", F.lit(0.0)))
    scaled = df.withColumn("s", df.agg(F.struct(*risk._scales({"v": (F.min("v"), F.max("v"))}))).scalar())
    got = [r[0] for r in scaled.select(risk.normalised(F.col("v"), F.col("s"), "v")).collect()]
    assert got == pytest.approx(expected)


def test_risk_of_empty_frame(spark, expanded_frame):
    assert risk.score_risk(expanded_frame.limit(0)).count() == 0


def test_efficiency_properties(spark, expanded_frame):
    rows = efficiency.efficiency_metrics(expanded_frame).collect()
    assert all(0 <= r.efficiency_score <= 100 for r in rows) and sum(r.wastage_flag for r in rows) >= 1
    zero = spark.createDataFrame([(0.0, 0.0, 0.9, 0.0)], "consumption_kwh double, expected_consumption_kwh double, power_factor double, wastage_score double")
    assert efficiency.efficiency_metrics(zero).first().efficiency_score == 0.0


def test_overview_counts_use_wastage_flag(spark):
    df = spark.createDataFrame(
        [("M1", "2026-03-12 00:00:00", 0, "Normal", 1, 1), ("M2", "2026-03-12 00:00:00", 1, THEFT, 0, 2)],
        "meter_id string, timestamp string, is_anomaly int, status string, wastage_flag int, reading_id int",
    )
    row = rollups.overview(df).first()
    assert (row.wastage, row.anomalies, row.theft, row.active_meters, row.total_meters) == (1, 1, 1, 2, 2)


@pytest.fixture(scope="module")
def queue_rows(spark):
    rows = [
        (f"M{i}", "Whitefield" if i < 3 else "Koramangala", THEFT if i < 4 else "Anomaly", int(i >= 2), 0.2 + 0.1 * i, 82.0 if i < 3 else 65.0, 0.9, i)
        for i in range(5)
    ]
    return spark.createDataFrame(
        rows, "meter_id string, area string, status string, is_anomaly int, anomaly_score double, risk_score double, theft_probability double, reading_id int"
    )


def test_summaries_ignore_the_limit(spark, queue_rows):
    assert rollups.theft_queue(queue_rows, 2).count() == 2
    summary = rollups.theft_summary(queue_rows).first()
    assert summary["count"] == 4 and summary.critical_areas == 1
    assert rollups.anomaly_queue(queue_rows, 1).count() == 1
    assert rollups.anomaly_summary(queue_rows).first()["count"] == 3


def test_candidate_promotion(spark):
    df = spark.createDataFrame(
        [("M1", "Normal", 0.12, 0.08, 0.16, 0.25, 0.05, 0.0, 1, 1), ("M2", "Anomaly", 0.28, 0.21, 0.33, 0.52, 0.12, 0.0, 1, 2)],
        "meter_id string, status string, theft_probability double, random_forest_probability double, xgboost_probability double,"
        " anomaly_score double, wastage_score double, seeded_theft_probability double, timestamp int, reading_id int",
    )
    got = {r.meter_id: r for r in theft.promote_candidate(df).collect()}
    assert got["M2"].status == THEFT and got["M2"].theft_probability >= 0.81 and got["M1"].status == "Normal"
    again = theft.promote_candidate(theft.promote_candidate(df)).where(F.col("status") == THEFT)
    assert again.count() == 1


def test_one_class_has_neutral_auc(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 0)], "theft_probability double, is_theft int")
    row = theft.classifier_metrics(df).first()
    assert row.roc_auc == 0.5 and row.precision == 0.0 and row.accuracy == 0.5


def auc_by_pairs(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))


def test_auc_equals_pair_count(spark):
    rng = np.random.default_rng(5)
    scores, labels = np.round(rng.random(700), 2), (rng.random(700) < 0.3).astype(int)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "s double, y int")
    assert theft.roc_auc(df, "s", "y").first()[0] == pytest.approx(auc_by_pairs(scores, labels), abs=1e-12)


@pytest.mark.parametrize("bits", [2, 6, BITS])
@pytest.mark.parametrize("p", [0.0, 0.15, 0.5, 0.85, 0.97, 1.0])
def test_exact_quantile(spark, bits, p):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.lognormal(0, 3, 400), np.full(250, 2.5)])  # heavy tail and a third of copies
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert exact_quantile(df, "v", p, bits).first()[0] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


@pytest.mark.parametrize("bits", [3, BITS])
def test_running_totals(spark, bits):
    values = [1.0, 5.0, 5.0, -2.0, 7.0, 5.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.cum_n for r in running_totals(df, "v", {"n": F.count("*")}, bits=bits).collect()}
    assert got == {-2.0: 1, 0.0: 2, 1.0: 3, 5.0: 6, 7.0: 7}


def test_hash_ranks_are_dense(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("g"))
    rows = ranked_by_hash(df, "g", "k", cells=16).collect()
    for g, n in ((0, 666), (1, 334)):
        assert sorted(r._rank for r in rows if r.g == g) == list(range(1, n + 1))


def test_balanced_sample_sizes(spark):
    df = spark.range(1000).select(F.col("id").alias("reading_id"), (F.col("id") < 300).cast("int").alias("is_theft"))
    got = {r.is_theft: r["count"] for r in theft.balanced_sample(df, 300).groupBy("is_theft").count().collect()}
    assert got == {1: 100, 0: 200}
    few = df.withColumn("is_theft", (F.col("reading_id") < 10).cast("int"))
    got = {r.is_theft: r["count"] for r in theft.balanced_sample(few, 300).groupBy("is_theft").count().collect()}
    assert got == {1: 10, 0: 290}
    assert theft.balanced_sample(df, 5000).count() == 1000


def test_alert_text(spark, expanded_frame):
    scored = risk.score_risk(expanded_frame)
    top = alerts.alert_messages(scored, 1).first()
    assert top.message.startswith(f"Meter {top.meter_id} in {top.area} scored ") and top.message.endswith(".")


def test_drift_alert_joins_the_feed(spark, expanded_frame):
    scored = efficiency.efficiency_metrics(risk.score_risk(expanded_frame.withColumn("is_anomaly", F.lit(0))))
    report = spark.createDataFrame([(1, 0.1234)], "drift_detected int, prediction_rate_shift double")
    feed = alerts.alert_feed(scored, report)
    drift = feed.where("category = 'Data Drift Detected'").first()
    assert drift.meter_id == "-" and drift.area == "System-wide" and drift.summary == "Concept shift 0.123"


def test_reasons(spark, expanded_frame):
    weights = {"consumption_variance": 0.0, "temperature": 1.0, "voltage": 0.001, "humidity": 10.0}
    row = explain.top_reasons(expanded_frame, weights, 2).first()
    assert row.reason == ["Humidity-linked load pattern", "Weather-driven load change"]
    assert explain.friendly_name("expected_consumption_kwh") == "Expected Consumption Kwh"


def test_histogram_of_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "v double")
    rows = rollups.histogram(df, "v").orderBy("bucket").collect()
    assert [r["count"] for r in rows] == [5, 0, 0, 0] and rows[0].high == 3.0


def test_a_sample_computes_wide_columns_for_its_own_rows_only(spark):
    """Counts and cuts come from key and label; other columns are computed once, for the rows that may be taken."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def wide(x):
        seen.add(1)
        return x

    df = spark.range(1000).select(F.col("id").alias("reading_id"), (F.col("id") % 5 == 0).cast("int").alias("is_theft"))
    rows = theft.balanced_sample(df.withColumn("wide", wide("reading_id")), 300).collect()
    assert len({r.reading_id for r in rows}) == 300 and sum(r.is_theft for r in rows) == 100 and seen.value == 300
    twice = df.unionAll(df).withColumn("reading_id", F.nullif(F.col("reading_id"), F.lit(5)))
    assert theft.balanced_sample(twice, 300).count() == 300


def test_prediction_scores_every_row_once(spark, monkeypatch):
    from types import SimpleNamespace

    from meterlake.plans import scoring
    from meterlake.sources.tables import meter_readings
    from tests.conftest import SF

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def odd(x):
        seen.add(1)
        return x

    monkeypatch.setattr(scoring, "score_models", lambda df, models: theft.classify(df.withColumn("anomaly_score", odd("anomaly_score"))))
    readings = meter_readings(spark, SF)
    out = scoring.predict(readings, SimpleNamespace(importances=lambda: {"voltage": 1.0}), keep=("reading_id",))
    rows = out.collect()
    assert len(rows) == readings.count() == seen.value
