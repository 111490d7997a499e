from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import drift, forecast, segments
from meterlake.operators.dbscan import dbscan
from meterlake.plans.session import cut_lineage


def brute_dbscan(points: np.ndarray, eps: float, least: int) -> list[int]:
    n = len(points)
    near = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= least
    labels, cluster = [-1] * n, 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        labels[i] = cluster
        while stack:
            for q in np.flatnonzero(near[stack.pop()]):
                if labels[q] == -1:
                    labels[q] = cluster
                    if core[q]:
                        stack.append(q)
        cluster += 1
    return labels


def point_sets():
    rng = np.random.default_rng(3)
    blobs = np.concatenate([rng.normal(c, 0.4, (30, 3)) for c in (0.0, 3.0, 9.0)] + [rng.uniform(-15, 15, (25, 3))])
    chain = np.c_[np.arange(60) * 1.1, np.zeros(60), np.zeros(60)]
    # Two dense clumps whose closest points are just within / just beyond eps, and a pile of copies.
    near_clumps = np.concatenate([rng.uniform(0, 0.5, (40, 3)), rng.uniform(0, 0.5, (40, 3)) + [1.62, 0, 0], np.full((50, 3), 7.0)])
    return {"blobs": blobs, "chain": chain, "clumps": near_clumps, "sparse": rng.uniform(-40, 40, (30, 3))}


@pytest.mark.parametrize("name", ["blobs", "chain", "clumps", "sparse"])
def test_dbscan_equals_brute_force(spark, name):
    points = point_sets()[name]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, x double, y double, z double")
    got = {r.id: r.dbscan_cluster for r in dbscan(cut_lineage(df), ["x", "y", "z"], "id", 1.15, 4).collect()}
    assert [got[i] for i in range(len(points))] == brute_dbscan(points, 1.15, 4)


@pytest.mark.parametrize("name", ["blobs", "chain", "clumps", "sparse"])
def test_dbscan_does_not_depend_on_parts_or_boxes(spark, monkeypatch, name):
    from meterlake.operators import dbscan as module

    points = point_sets()[name]
    rows = [(f"k{i:04d}", *map(float, p)) for i, p in enumerate(points)] + [("n1", None, 0.0, 0.0), ("n2", float("nan"), 1.0, 1.0)]
    df = cut_lineage(spark.createDataFrame(rows, "id string, x double, y double, z double"))
    expected = [*brute_dbscan(points, 1.15, 4), -1, -1]
    monkeypatch.setattr(module, "PART_POINTS", 12)
    tree = module._split_parts(df.select("id", F.col("x").alias("x0"), F.col("y").alias("x1"), F.col("z").alias("x2")).dropna(), ["x0", "x1", "x2"], len(points))
    assert sum(len(node) == 1 for node in tree) > 1
    # Many parts; then box by box, also with boxes split down to single pairs.
    for most, pairs in ((60_000, 4096), (1, 4096), (1, 1)):
        monkeypatch.setattr(module, "MOST_POINTS", most)
        monkeypatch.setattr(module, "PAIR_LIMIT", pairs)
        got = {r.id: (r.dbscan_cluster, r.is_core) for r in dbscan(df, ["x", "y", "z"], "id", 1.15, 4).collect()}
        assert [got[r[0]][0] for r in rows] == expected
        near = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2) <= 1.15**2
        assert [got[r[0]][1] for r in rows] == [*(near.sum(1) >= 4).astype(int).tolist(), 0, 0]


def test_dbscan_of_a_hot_cell(spark):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(0, 0.01, (4000, 3)), np.full((2000, 3), 0.5), [[0.0, 0.0, 1.1], [5.0, 5.0, 5.0]]])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, x double, y double, z double")
    got = {r.id: r.dbscan_cluster for r in dbscan(cut_lineage(df), ["x", "y", "z"], "id", 1.15, 4).collect()}
    assert set(got.values()) == {0, -1} and got[6001] == -1 and got[6000] == 0


def test_dbscan_of_two_rows_is_noise(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0)], "id int, x double")
    assert {r.dbscan_cluster for r in dbscan(df, ["x"], "id").collect()} == {-1}


def test_every_meter_has_a_segment(spark, expanded_frame):
    out = segments.cluster_consumers(expanded_frame, restarts=2, with_dbscan=True).collect()
    assert {r.meter_id for r in out} == {"M0101", "M0102", "M0103", "M0104"} and all(r.segment for r in out)
    assert next(r.segment for r in out if r.meter_id == "M0104") == "Suspicious cluster"


def test_last_known_area_skips_nulls(spark, expanded_frame):
    newest = expanded_frame.agg(F.max("timestamp")).first()[0]
    holes = expanded_frame.withColumn("area", F.when(F.col("timestamp") < F.lit(newest), F.col("area")))
    assert all(r.area for r in segments.consumer_profile(holes).collect())


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 3.0)], "a double, b double")
    rows = segments.standardise(df, ["a", "b"]).collect()
    assert [r.z_a for r in rows] == [0.0, 0.0] and sorted(r.z_b for r in rows) == [-1.0, 1.0]


def series_of(spark, n):
    start = dt.datetime(2026, 1, 1)
    return spark.createDataFrame(
        [("all", start + dt.timedelta(hours=i), float(10 + i % 24)) for i in range(n)], "series string, timestamp timestamp, consumption_kwh double"
    )


@pytest.mark.parametrize("points", [1, 23, 24, 32])
def test_short_series_forecast_zero(spark, points):
    rows = forecast.baseline_forecast(series_of(spark, points)).collect()
    assert len(rows) == 168 and all(r.forecast == 0.0 for r in rows)


@pytest.mark.parametrize("points", [33, 168, 169])
def test_seasonal_baseline(spark, points):
    series = series_of(spark, points)
    values = np.array([10.0 + i % 24 for i in range(points)])[-24:]
    rows = sorted(forecast.baseline_forecast(series).collect(), key=lambda r: r.step)
    want = [0.65 * values[i % 24] + 0.35 * values.mean() for i in range(168)]
    np.testing.assert_allclose([r.forecast for r in rows], want, rtol=1e-12)
    h = forecast.horizons(forecast.baseline_forecast(series)).first()
    assert h.next_hour == pytest.approx(want[0], abs=0.01) and h.next_week == pytest.approx(sum(want), abs=0.01)


def test_short_history_is_a_flat_mean(spark):
    series = series_of(spark, 40)
    history = forecast.history_tail(series, 10)
    rows = forecast.baseline_forecast(series, history=history, horizon=5).collect()
    assert {r.forecast for r in rows} == {np.mean([10.0 + i % 24 for i in range(30, 40)])}


def test_listed_steps(spark):
    assert forecast.listed_steps(forecast.baseline_forecast(series_of(spark, 50), horizon=12)).count() == 12


def test_lag_forecast_follows_a_periodic_series(spark):
    series = series_of(spark, 24 * 12)
    model = forecast.fit_lag_model(series)
    rows = sorted(forecast.lag_forecast(series, model, horizon=48, cap=1.5).collect(), key=lambda r: r.step)
    want = [10.0 + i % 24 for i in range(48)]
    assert np.abs(np.array([r.forecast for r in rows]) - want).max() < 1.5
    assert forecast.fit_lag_model(series_of(spark, 40)) is None


def test_every_series_has_a_lag_model_of_its_own(spark):
    rng = np.random.default_rng(4)
    rows, values = [], {}
    for name, period, hours in (("a", 24, 200), ("b", 7, 150), ("short", 24, 60)):
        values[name] = np.round(5 + np.sin(np.arange(hours) * 2 * np.pi / period) + rng.normal(0, 0.1, hours), 3)
        rows += [(name, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(v)) for i, v in enumerate(values[name])]
    series = spark.createDataFrame(rows, "series string, timestamp timestamp, consumption_kwh double").repartition(5)
    models = {r.series: r for r in forecast.fit_lag_model(series).collect()}
    assert set(models) == {"a", "b"}
    for name, model in models.items():
        v = values[name]
        x = (v - v.min()) / (v.max() - v.min())
        lags = np.stack([np.ones(len(x) - 24), *[x[24 - i : len(x) - i] for i in range(1, 25)]], 1)
        ridge = np.diag([0.0] + [forecast.PENALTY * len(lags)] * 24)
        weights = np.linalg.solve(lags.T @ lags + ridge, lags.T @ x[24:])
        assert model.windows == len(lags) and np.allclose([model.bias, *model.weights], weights, atol=1e-3) and model.residual < 1e-9
    steps = forecast.lag_forecast(series, forecast.fit_lag_model(series), horizon=30).groupBy("series").count().collect()
    assert {(r.series, r["count"]) for r in steps} == {("a", 30), ("b", 30), ("short", 30)}


def test_drift_shift_border(spark):
    old = spark.createDataFrame([("M1", 1, 100.0, 0)], "meter_id string, timestamp int, x double, is_theft int")
    at = spark.createDataFrame([("M1", 1, 112.0, 0)], old.schema)
    below = spark.createDataFrame([("M1", 1, 111.9, 0)], old.schema)
    assert drift.mean_shift(old, at, ["x"]).first().drift_detected
    assert not drift.mean_shift(old, below, ["x"]).first().drift_detected


def test_report_flags_duplicates_and_missing(spark):
    old = spark.createDataFrame([("M1", 1, 5.0, 0, 0.1)], "meter_id string, timestamp int, x double, is_theft int, theft_probability double")
    new = spark.createDataFrame([("M1", 1, 5.0, 0, 0.1), ("M1", 1, None, 0, 0.1)], old.schema)
    row = drift.drift_report(old, new).first()
    assert row.drift_detected == 1 and row.issue_count == 2 and row.current_missing_pct == 10.0 and row.concept_drift_detected == 0
    calm = drift.drift_report(old, old).first()
    assert calm.drift_detected == 0 and calm.issues == ""


def test_ks_of_shifted_samples(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 500), rng.normal(0.7, 1, 400)
    old = spark.createDataFrame([(float(v),) for v in a], "v double")
    new = spark.createDataFrame([(float(v),) for v in b], "v double")
    grid = np.sort(np.concatenate([a, b]))
    want = np.abs(np.searchsorted(np.sort(a), grid, "right") / 500 - np.searchsorted(np.sort(b), grid, "right") / 400).max()
    row = drift.distribution_drift(old, new, ["v"]).first()
    assert row.ks == pytest.approx(want, abs=1e-6) and row.psi > 0.1


def test_dbscan_where_points_crowd_in_many_dimensions(spark, monkeypatch):
    """No enumeration of 3^7 neighbouring cells: pairs of parts settle what a part does not know, whatever the number of dimensions."""
    from meterlake.operators import dbscan as module

    rng = np.random.default_rng(11)
    spread = np.concatenate([rng.normal(0, 0.8, (260, 7)), rng.normal(0, 0.8, (60, 7)) + 2.6, np.full((20, 7), 1.0)])
    monkeypatch.setattr(module, "MOST_POINTS", 1)
    monkeypatch.setattr(module, "PART_POINTS", 160)
    names = [f"c{i}" for i in range(7)]
    df = cut_lineage(spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(spread)], "id int, " + ", ".join(f"{n} double" for n in names)))
    got = {r.id: r.dbscan_cluster for r in module.dbscan(df, names, "id", 1.15, 4).collect()}
    assert not hasattr(module, "_candidate_pairs")
    assert [got[i] for i in range(len(spread))] == brute_dbscan(spread, 1.15, 4)


def test_what_parts_ask_each_other():
    from meterlake.operators import density_parts

    rng = np.random.default_rng(12)
    a, b = rng.uniform(-3, 3, (300, 4)), rng.uniform(-3, 3, (400, 4))
    near = ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2) <= 1.15**2
    numbers, mine = rng.integers(0, 50, 400), rng.integers(100, 130, 300)
    none = np.iinfo(np.int64).max
    for pairs in (1, 1 << 16):
        assert density_parts.near_counts(a, b, 1.15, pairs).tolist() == near.sum(1).tolist()
        assert density_parts.least_near(a, b, numbers, 1.15, pairs).tolist() == np.where(near, numbers[None, :], none).min(1).tolist()
        root = {x: x for x in [*mine.tolist(), *numbers.tolist()]}
        for x, y in density_parts.ties(a, mine, b, numbers, 1.15, pairs):
            assert (near & (mine == x)[:, None] & (numbers == y)[None, :]).any() or (near & (mine == y)[:, None] & (numbers == x)[None, :]).any()
            old, new = root[x], root[y]
            root = {k: new if v == old else v for k, v in root.items()}
        i, j = np.nonzero(near)
        assert all(root[x] == root[y] for x, y in zip(mine[i].tolist(), numbers[j].tolist(), strict=True))
