"""Bucketed state of feeds, sums that merge, and k-means whose restarts advance together."""

from __future__ import annotations

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import drift, segments
from meterlake.plans.session import cut_lineage
from meterlake.streaming import feeds, live
from meterlake.streaming.buckets import BucketTable
from tests.test_models_streams import feed_of

START = dt.datetime(2024, 1, 1)


def scored_rows(seed, n, hours=30):
    rng = random.Random(seed)
    names = ("north", "south", None)
    return [
        (
            i + 1000 * seed, f"M{rng.randrange(7)}", START + dt.timedelta(hours=rng.randrange(hours)), rng.choice(names), rng.choice(names), rng.choice(names),
            round(rng.random() * 9, 4), rng.random(), rng.random(), rng.random(), rng.random(), rng.random(), rng.choice([None, rng.random()]), rng.randrange(2),
        )
        for i in range(n)
    ]


SCHEMA = """reading_id long, meter_id string, timestamp timestamp, region string, area string, usage_profile string, consumption_kwh double,
night_usage_ratio double, peak_usage_ratio double, power_factor_loss double, voltage_irregularity double, theft_probability double,
anomaly_score double, is_theft int"""


def test_a_batch_touches_its_buckets_only(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 16)
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    assert table.read() is None
    table.write(rows, 0)
    one = rows.where("k = 5").withColumn("v", F.lit(1))
    (bucket,) = table.touched(one)
    for number in (1, 1, 2, 3):  # batch 1 comes twice
        old = table.read([bucket], number)
        assert old.count() == sum(r.b == bucket for r in rows.select(table.bucket().alias("b")).collect())
        table.write(old.join(one.select("k"), "k", "left_anti").unionByName(one.withColumn("v", F.lit(number))), number)
        written = [d for d in os.listdir(tmp_path / "t" / f"batch={number}") if d.startswith("bucket=")]
        assert written == [f"bucket={bucket}"]
        assert table.read().where(f"v = {number}").count() == 1 and table.read().count() == 200
    # Versions that no repeat can ask for are gone.
    assert table.versions()[bucket] == [2, 3]


def test_rolling_memory_is_written_in_proportion_to_the_news(spark, tmp_path):
    rows = [(i, f"M{i % 40:03d}", START + dt.timedelta(hours=i // 40), float(i % 7)) for i in range(400)]
    news = [(1000 + i, "M003", START + dt.timedelta(hours=20 + i), 2.0) for i in range(3)]
    schema = "reading_id long, meter_id string, timestamp timestamp, consumption_kwh double"
    out = str(tmp_path / "out")
    for stream in feed_of(spark, str(tmp_path / "in"), spark.createDataFrame(rows, schema).schema, spark.createDataFrame(rows, schema), spark.createDataFrame(news, schema)):
        feeds.run_rolling_features(stream, out, finish=False, buckets=16)
    folders = {d: sorted(os.listdir(f"{out}/memory/{d}")) for d in sorted(os.listdir(f"{out}/memory"))}
    last = [x for x in folders[max(folders, key=lambda d: int(d.split("=")[1]))] if x.startswith("bucket=")]
    first = [x for x in folders[min(folders, key=lambda d: int(d.split("=")[1]))] if x.startswith("bucket=")]
    assert len(first) > 8
    # The last batch releases what waited of all meters two hours before, or M003's alone; never a bucket without news.
    bucket = spark.createDataFrame([("M003",)], "meter_id string").select(F.pmod(F.xxhash64("meter_id"), F.lit(16))).first()[0]
    assert f"bucket={bucket}" in last


def test_late_hours_are_kept_apart(spark, tmp_path):
    schema = "timestamp timestamp, consumption_kwh double, is_anomaly int, status string"
    at = lambda h: START + dt.timedelta(hours=h)
    first = [(at(0.5), 1.0, 0, "Normal"), (at(1.2), 2.0, 1, "Normal"), (at(5.0), 4.0, 0, "Electricity Theft")]
    second = [(at(0.6), 100.0, 0, "Normal"), (at(4.5), 8.0, 0, "Normal"), (at(5.1), 16.0, 1, "Normal")]
    frames = [spark.createDataFrame(x, schema) for x in (first, second)]
    out = str(tmp_path / "out")
    for stream in feed_of(spark, str(tmp_path / "in"), frames[0].schema, *frames):
        got = feeds.run_hourly_demand(stream, out)
    rows = {r.timestamp: (r.total_consumption, r.anomalies, r.theft) for r in got.collect()}
    assert rows == {at(0): (1.0, 0, 0), at(1): (2.0, 1, 0), at(4): (8.0, 0, 0), at(5): (20.0, 1, 1)}
    late = feeds.late_hours(spark, out).collect()
    assert [(r.timestamp, r.rows) for r in late if r.rows] == [(at(0), 1)]
    empty = feeds.run_hourly_demand(feeds.read_stream(spark, str(tmp_path / "in"), frames[0].schema), str(tmp_path / "new"))
    assert empty.count() == 4


def test_profile_sums_merge_to_the_profile_of_all_rows(spark):
    parts = [spark.createDataFrame(scored_rows(s, n), SCHEMA) for s, n in ((1, 40), (2, 1), (3, 25))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = live.profile_sums(parts[0])
    for p in parts[1:]:
        merged = live.merge_profiles(merged.unionByName(live.profile_sums(p)))
    expected = segments.consumer_profile(every)
    assert sorted(live.profiles_of(merged).select(expected.columns).collect()) == sorted(expected.collect())


def test_column_sums_merge_to_the_report_of_all_rows(spark):
    parts = [spark.createDataFrame(scored_rows(s, 30), SCHEMA) for s in (4, 5, 6)]
    history = drift.merge_sums(drift.column_sums(parts[0]).unionByName(drift.column_sums(parts[1])))
    report = drift.report_of(history, drift.column_sums(parts[2]), drift.has_repeats(parts[2]))
    assert report.collect() == drift.drift_report(parts[0].unionByName(parts[1]), parts[2]).collect()


def test_live_tables_do_not_depend_on_batches(spark, tmp_path):
    rows = spark.createDataFrame(scored_rows(7, 120), SCHEMA)
    columns = ["meter_id", "timestamp", "consumption_kwh", "theft_probability", "is_theft"]
    whole = live.LiveState(spark, str(tmp_path / "whole"), columns).tables(rows, rows, 0)
    state = live.LiveState(spark, str(tmp_path / "parts"), columns)
    for number, low in enumerate((0, 10, 20)):
        part = rows.where((F.hour("timestamp") + 24 * (F.dayofmonth("timestamp") - 1) >= low) & (F.hour("timestamp") + 24 * (F.dayofmonth("timestamp") - 1) < low + 10))
        tables = state.tables(part, rows, number)
    for name, table in whole.items():
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, table.collect())), name


@pytest.mark.parametrize("k", [1, 3, 8])
def test_kmeans_comes_to_rest_at_the_cheapest_run(spark, k):
    rng = np.random.default_rng(k)
    points = np.concatenate([rng.normal(c, 0.3, (40, 2)) for c in ((0, 0), (4, 0), (0, 5))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, x double, y double").repartition(3)
    out = segments.kmeans_clusters(df, ["x", "y"], k, restarts=6)
    assert segments.kmeans_at_rest(out, ["x", "y"]).where("NOT nearest").count() == 0
    label = np.array([r.kmeans_cluster for r in out.orderBy("id").collect()])
    cost = sum(((points[label == c] - points[label == c].mean(0)) ** 2).sum() for c in set(label.tolist()))
    assert len(set(label.tolist())) == k
    if k == 3:
        assert all(len(set(label[a : a + 40].tolist())) == 1 for a in (0, 40, 80)) and cost < 3 * 40 * 0.3
    again = segments.kmeans_clusters(df.coalesce(1), ["x", "y"], k, restarts=6)
    assert [r.kmeans_cluster for r in again.orderBy("id").collect()] == label.tolist()


def test_kmeans_of_few_rows(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert {r.kmeans_cluster for r in segments.kmeans_clusters(df, ["x"], 3).collect()} <= {0, 1}
    assert segments.kmeans_clusters(df.limit(0), ["x"], 3).count() == 0


def test_a_round_of_kmeans_is_one_pass_of_arrays(spark):
    """Centres travel as data, not as a formula per round; sums are whole numbers of any size, over any partitions."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(200, 2)) * [1.0, 1e12], [[0.5, 2e12]] * 7])
    df = cut_lineage(spark.createDataFrame([tuple(map(float, r)) for r in x], "x double, y double").repartition(5))
    centres = np.stack([x[[0, 50, 100]], x[[1, 2, 3]]])
    sums = segments._advance(df, ["x", "y"], centres)
    for r in range(2):
        far = ((x[:, None, :] - centres[r][None]) ** 2).sum(2)
        for c in range(3):
            mine = x[far.argmin(1) == c]
            assert sums[r, c, 0] == len(mine)
            for i in range(2):
                low, mid, high = sums[r, c, 4 + 3 * i : 7 + 3 * i]
                assert low + mid * 2**32 + high * 2**64 == sum(int(v) for v in np.rint(mine[:, i] * 1e9))
    assert segments.kmeans_at_rest(segments.kmeans_clusters(df, ["x", "y"], 3, restarts=2), ["x"]).count() == len(x)
