from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlake.operators import clean, features as feats
from meterlake.sources import io
from meterlake.sources.tables import meter_readings
from tests.conftest import SF


def test_partial_row_is_flagged_and_banded(spark):
    df = spark.createDataFrame(
        [("M1", "2026-03-12T05:00:00", 2.4, 1.8, 0.78, 29.4, 70.0, 0.0, 2.1, 0.31)],
        "meter_id string, timestamp string, power double, consumption_kwh double, power_factor double, temperature double,"
        " humidity double, rainfall double, wind_speed double, wastage_score double",
    )
    row = clean.clean_readings(df).first()
    assert row.wastage_flag == 1 and row.temperature_band == "warm" and row.power_gap == 0.6


def test_band_edges(spark):
    cases = {-10.0: "nan", -9.9: "cool", 20.0: "cool", 20.1: "mild", 26.0: "mild", 32.0: "warm", 32.1: "hot", 50.0: "hot", 50.01: "nan"}
    df = spark.createDataFrame([(t,) for t in cases], "t double").withColumn("b", clean.temperature_band(F.col("t")))
    assert {r.t: r.b for r in df.collect()} == cases


def test_unreadable_values(spark):
    df = spark.createDataFrame(
        [("M1", "not a time", "1", "1", "1", "1", "1"), ("M1", "2026-01-01 00:00:00", "abc", "-4", "7", "NaN", None)],
        "meter_id string, timestamp string, power string, consumption_kwh string, power_factor string, temperature string, wastage_score string",
    )
    (row,) = clean.clean_readings(df).collect()
    assert (row.power, row.consumption_kwh, row.power_factor, row.temperature, row.wastage_score) == (0.0, 0.0, 1.0, 0.0, 0.0)


def test_feature_columns(spark, base_frame):
    df = feats.add_engineered_features(clean.clean_readings(base_frame))
    assert {"hour_of_day", "rolling_average_consumption", "night_usage_ratio"} <= set(df.columns)
    columns = feats.design_columns(df)
    assert {"area_Whitefield", "usage_profile_residential"} <= set(columns)
    encoded = feats.encode_features(df, [*columns, "region_Elsewhere"])
    assert encoded.columns[-1] == "region_Elsewhere" and encoded.agg(F.sum("region_Elsewhere")).first()[0] == 0.0
    from pyspark.ml.functions import vector_to_array

    vectors = feats.assemble(df, columns, keep=["meter_id"])
    assert vectors.select(F.size(vector_to_array("features"))).first()[0] == len(columns)


def pandas_features(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["meter_id", "timestamp", "reading_id"]).reset_index(drop=True)
    grouped = pdf.groupby("meter_id")["consumption_kwh"]
    pdf["mean"] = grouped.transform(lambda s: s.rolling(24, min_periods=1).mean())
    pdf["var"] = grouped.transform(lambda s: s.rolling(24, min_periods=2).var().fillna(0.0))
    hour = pdf["timestamp"].dt.hour
    pdf["night"] = pdf["consumption_kwh"].where((hour >= 22) | (hour <= 5), 0.0)
    night = pdf.groupby("meter_id")["night"].transform(lambda s: s.rolling(24, min_periods=1).sum())
    pdf["share"] = (night / grouped.transform(lambda s: s.rolling(24, min_periods=1).sum()).replace(0.0, np.nan)).fillna(0.0)
    pdf["peak"] = (pdf["consumption_kwh"] / grouped.transform("max").replace(0.0, np.nan)).fillna(0.0)
    return pdf.set_index("reading_id")


def check_against_pandas(rolled, source):
    want = pandas_features(source.select("reading_id", "meter_id", "timestamp", "consumption_kwh").toPandas())
    got = rolled.toPandas().set_index("reading_id").loc[want.index]
    for mine, theirs in (
        ("rolling_average_consumption", "mean"), ("consumption_variance", "var"),
        ("night_usage_ratio", "share"), ("peak_usage_ratio", "peak"),
    ):
        np.testing.assert_allclose(got[mine], want[theirs], rtol=1e-9, atol=1e-7)


def test_rolling_matches_pandas(spark):
    df = clean.clean_readings(meter_readings(spark, SF))
    check_against_pandas(feats.rolling_features(df), df)


@pytest.mark.parametrize("hot_rows", [8, 40, 200])
def test_split_meters_give_the_same_features(spark, hot_rows):
    """A meter with a third of all rows, cut into slots (some of fewer than 23 rows)."""
    df = clean.clean_readings(meter_readings(spark, SF)).select("reading_id", "meter_id", "timestamp", "consumption_kwh")
    skewed = df.withColumn("meter_id", F.when(F.col("reading_id") % 3 == 0, F.lit("M000001")).otherwise(F.col("meter_id")))
    rolled = feats.rolling_features(skewed, hot_rows=hot_rows)
    plan = rolled._jdf.queryExecution().optimizedPlan().toString()
    assert "_prior" in plan
    check_against_pandas(rolled, skewed)


def test_copies_of_one_timestamp_can_be_split(spark):
    df = spark.range(900).select(
        F.col("id").alias("reading_id"), F.lit("M1").alias("meter_id"), F.lit("2026-01-01 23:00:00").cast("timestamp").alias("timestamp"),
        (F.col("id") % 17 + 0.25).alias("consumption_kwh"),
    )
    check_against_pandas(feats.rolling_features(df, hot_rows=100), df)


def test_zero_and_single_row_meters(spark):
    df = spark.createDataFrame(
        [(1, "A", "2026-01-01 03:00:00", 0.0), (2, "A", "2026-01-01 04:00:00", 0.0), (3, "B", "2026-01-01 04:00:00", 5.0)],
        "reading_id int, meter_id string, timestamp string, consumption_kwh double",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    got = {r.reading_id: r for r in feats.rolling_features(df).collect()}
    assert got[2].peak_usage_ratio == 0.0 and got[2].night_usage_ratio == 0.0 and got[2].consumption_variance == 0.0
    assert got[3].consumption_variance == 0.0 and got[3].peak_usage_ratio == 1.0 and got[3].night_usage_ratio == 1.0


def test_tick_scope(spark, base_frame):
    got = feats.rolling_features(clean.clean_readings(base_frame), scope="tick").collect()
    assert all(r.rolling_average_consumption == pytest.approx(r.consumption_kwh, abs=1e-4) and r.peak_usage_ratio == 1.0 for r in got)


def test_one_exchange_for_all_windows(spark):
    df = clean.clean_readings(meter_readings(spark, SF)).select("reading_id", "meter_id", "timestamp", "consumption_kwh")
    plan = feats.rolling_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(meter_id") == 1


def test_missing_path_is_empty(spark, tmp_path):
    assert io.load_readings(spark, str(tmp_path / "nowhere")).count() == 0


def test_csv_round_trip_and_cap(spark, base_frame, tmp_path):
    path = str(tmp_path / "csv")
    names = [f.name for f in io.READING_SCHEMA]
    io.append_readings(base_frame.select(names), path, "csv", partition=False)
    io.append_readings(base_frame.select(names), path, "csv", partition=False)
    assert io.load_readings(spark, path).count() == 24
    assert io.load_readings(spark, path, max_rows=5).count() == 5


def test_request_defaults(spark):
    one = '{"meter_id":"M1","area":"A","consumption_kwh":2.0,"expected_consumption_kwh":0,"power_factor":0.9,"power":1.0,"temperature":21}'
    many = '[{"meter_id":"M2","timestamp":"2026-03-12T05:00:00","consumption_kwh":3.0,"expected_consumption_kwh":1.5,"power_factor":0.9,"power":1.0,"temperature":21},{"meter_id":"M3","timestamp":"2026-03-12T05:00:00","consumption_kwh":3.0,"power_factor":0.9,"power":1.0,"temperature":21,"wastage_score":0.2}]'
    rows = {r.meter_id: r for r in io.parse_requests(spark.createDataFrame([(one,), (many,)], "payload string")).collect()}
    assert rows["M1"].expected_consumption_kwh == 2.0 and rows["M1"].wastage_score == 0.0 and rows["M1"].timestamp.minute == 0
    assert rows["M2"].wastage_score == 1.0 and rows["M3"].wastage_score == 0.2 and rows["M3"].usage_profile == "residential"


def test_snapshot_table_is_replaced(spark, base_frame):
    io.save_snapshot(base_frame.select("meter_id"), "snapshot_test")
    io.save_snapshot(base_frame.select("meter_id").limit(3), "snapshot_test")
    assert spark.table("snapshot_test").count() == 3
    spark.sql("DROP TABLE snapshot_test")


def test_json_documents(spark, base_frame):
    import json

    df = base_frame.select("meter_id", "timestamp", F.lit(float("nan")).alias("x"))
    (doc,) = [json.loads(r[0]) for r in io.to_documents(io.export_records(df, 1, [F.col("meter_id"), F.col("timestamp")])).collect()]
    assert doc == {"meter_id": "M0001", "timestamp": "2026-03-12T00:00:00", "x": None}


@pytest.mark.parametrize("keys", ["number", "text", "prefixed"])
def test_copies_of_one_instant_split_by_key_in_its_own_order(spark, keys):
    key = {"number": F.col("id"), "text": F.col("id").cast("string"), "prefixed": F.concat(F.lit("r"), F.col("id").cast("string"))}[keys]
    df = spark.range(900).select(
        key.alias("reading_id"), F.lit("M1").alias("meter_id"), F.lit("2026-03-12 00:00:00").cast("timestamp").alias("timestamp"),
        (F.col("id") % 17 + 1).cast("double").alias("consumption_kwh"),
    )
    columns = ["reading_id", "rolling_average_consumption", "consumption_variance", "peak_usage_ratio", "night_usage_ratio"]
    split = feats.rolling_features(df, hot_rows=100).select(columns).orderBy("reading_id").collect()
    assert split == feats.rolling_features(df, hot_rows=None).select(columns).orderBy("reading_id").collect()
    _, levels = feats.place_in_slots(df, "timestamp", "reading_id", 100)
    assert levels


def test_ranks_keep_rows_without_a_group(spark):
    from meterlake.operators.theft import stratified_split

    df = spark.range(90).select(F.col("id").alias("reading_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("is_theft"))
    assert stratified_split(df).count() == 90
    text = df.withColumn("reading_id", F.concat(F.lit("r"), F.col("reading_id")))
    assert stratified_split(text).where("is_test = 1").count() == 18


def test_weather_joins_one_observation(spark, base_frame):
    weather = base_frame.where("meter_id = 'M0001'").select("area", "timestamp", F.lit(1.0).alias("gust"))
    joined = io.enrich_weather(base_frame, weather.unionByName(weather))
    assert joined.count() == base_frame.count()
