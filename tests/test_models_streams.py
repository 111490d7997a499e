from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import anomaly, models
from meterlake.operators.clean import clean_readings
from meterlake.operators.features import rolling_features
from meterlake.plans import export, scoring
from meterlake.plans.session import cut_lineage
from meterlake.schema import MODEL_CATEGORICAL
from meterlake.sources.tables import meter_readings
from meterlake.streaming import feeds
from tests.conftest import SF

SMALL = models.ModelSizes(isolation_trees=30, forest_trees=8, forest_depth=5, boost_rounds=4, boost_depth=3)


@pytest.fixture(scope="module")
def separable(spark):
    df = spark.range(600).select(
        F.col("id").alias("reading_id"), (F.col("id") % 5 == 0).cast("int").alias("is_theft"),
        (F.col("id") * 7919 % 1000 / 1000.0).alias("voltage"), (F.col("id") * 104729 % 997 / 997.0).alias("current"),
    )
    return df.withColumn("power", F.col("voltage") + F.col("is_theft") * 1.5).withColumn("wastage_score", F.lit(0.0)).cache()


@pytest.fixture(scope="module")
def bundle(separable):
    return models.train_models(separable, ["voltage", "current", "power"], SMALL)


def test_outliers_score_higher(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *map(float, p)) for i, p in enumerate(np.concatenate([rng.normal(0, 1, (800, 2)), [[9.0, 9.0], [-8.0, 10.0]]]))]
    df = spark.createDataFrame(rows, "reading_id int, a double, b double")
    forest = anomaly.fit_isolation_forest(df, ["a", "b"], trees=60)
    assert forest.nodes.groupby("tree").size().max() <= 511 and forest.nodes.tree.nunique() == 60
    scores = {r.reading_id: r.anomaly_score for r in anomaly.score_anomalies(df, forest).collect()}
    assert all(0 < s <= 1 for s in scores.values())
    top = sorted(scores, key=scores.get)[-2:]
    assert set(top) == {800, 801}


def test_forest_is_the_same_for_any_partitioning(spark):
    df = spark.range(500).select(F.col("id").alias("reading_id"), (F.col("id") * 37 % 101).cast("double").alias("a"))
    first = anomaly.fit_isolation_forest(df.repartition(1), ["a"], trees=5)
    second = anomaly.fit_isolation_forest(df.repartition(7, "a"), ["a"], trees=5)
    assert first.nodes.equals(second.nodes)


def test_average_depth():
    assert anomaly.average_depth([1, 2]).tolist() == [0.0, 1.0]
    assert float(anomaly.average_depth(256)) == pytest.approx(10.2448, abs=1e-3)


def test_classifiers_learn(bundle):
    assert bundle.metrics["roc_auc"] > 0.9 and 0 < bundle.threshold < 1


def test_models_survive_storage(spark, separable, bundle, tmp_path):
    models.save_models(spark, bundle, str(tmp_path / "m"))
    again = models.load_models(spark, str(tmp_path / "m"))
    columns = ["reading_id", "anomaly_score", "theft_probability", "status"]
    a = models.score_models(separable, bundle).select(columns).orderBy("reading_id").collect()
    b = models.score_models(separable, again).select(columns).orderBy("reading_id").collect()
    assert a == b
    nodes = models.tree_nodes(spark, str(tmp_path / "m" / "boost"))
    explained = models.tree_contributions(separable, nodes, bundle.columns)
    # Path attributions add up to the margin minus the weighted root values.
    roots = nodes[nodes.node == 0]
    base = float((roots.weights * roots.value).sum())
    raw = bundle.boost.transform(models.assemble(separable, bundle.columns, ["reading_id"])).select("reading_id", "boost_raw")
    margins = {r.reading_id: r.boost_raw[1] / 2 if abs(r.boost_raw[1]) != abs(base) else base for r in raw.collect()}
    rows = explained.select("reading_id", "contributions").collect()
    sums = np.array([base + sum(r.contributions) for r in rows])
    want = np.array([margins[r.reading_id] for r in rows])
    assert np.corrcoef(sums, want)[0, 1] > 0.999999


def test_tuning(separable):
    best = models.tune(separable, ["voltage", "power"], trials=2, sizes=SMALL)
    assert 8 <= best["max_depth"] <= 24 and 0.03 <= best["learning_rate"] <= 0.16 and best["best_score"] > 0.8
    assert models.tune(separable.limit(50), ["power"])["method"] == "default"
    assert models.tune(separable.where("is_theft = 0"), ["power"])["method"] == "default"


@pytest.fixture(scope="module")
def real(spark):
    return clean_readings(meter_readings(spark, SF)).cache()


def test_predict_has_twelve_fields(spark, real):
    from meterlake.operators.features import add_engineered_features
    from meterlake.schema import MODEL_NUMERIC

    trained = models.train_models(cut_lineage(add_engineered_features(real)), MODEL_NUMERIC, SMALL)
    answer = scoring.predict(meter_readings(spark, SF), trained)
    assert len(answer.columns) == 12
    row = answer.first()
    assert len(row.reason) == 3 and 0 <= row.risk_score <= 100
    assert answer.count() == real.count()


def test_queries_fit_on_all_readings(spark, monkeypatch):
    from meterlake.catalog import models as catalog

    rows = spark.range(61_000).select(
        F.col("id").alias("reading_id"), (F.col("id") % 50 == 0).cast("int").alias("is_theft"), (F.col("id") % 97).cast("double").alias("power"),
        *[F.concat(F.lit(c[0]), F.col("id") % 2).alias(c) for c in MODEL_CATEGORICAL],
    )
    monkeypatch.setattr(catalog, "readings", lambda spark, folder: rows)
    monkeypatch.setattr(catalog, "features", lambda spark, folder: rows)
    monkeypatch.setattr(catalog, "SIZES", models.ModelSizes(5, 2, 2, 2, 2))
    bundle = catalog.fitted(spark, "")
    assert bundle.metrics["training_rows"] == 61_000 and {"region_r0", "region_r1"} <= set(bundle.columns)


def test_documents(spark, real, tmp_path):
    from meterlake.catalog.base import scored

    df = scored(spark, SF)
    (row,) = export.snapshot_document(df, time_col="tick").select(F.to_json(F.struct("*"))).collect()
    document = json.loads(row[0])
    assert document["type"] == "live_tick" and len(document["meters"]) == 16 and len(document["overview"]["live_consumption"]) == 24
    manifest = {r.file: r.rows for r in export.export_samples(df, str(tmp_path / "samples")).collect()}
    assert manifest == {"predict_request": 1, "predict_response": 1, "theft_response": 5, "overview_response": 1, "top_meter_snapshot": 20}


def feed(spark, real, path, parts=4):
    """Readings as files in time order, one per batch."""
    bounds = real.approxQuantile("reading_id", [i / parts for i in range(parts + 1)], 0.0)
    for i in range(parts):
        low, high = bounds[i], bounds[i + 1] if i < parts - 1 else float("inf")
        real.where((F.col("reading_id") >= low) & (F.col("reading_id") < high)).coalesce(1).write.mode("append").parquet(path)
    return feeds.read_stream(spark, path, real.schema, files_per_batch=1)


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_streamed_rolling_features_equal_batch(spark, real, tmp_path, hot_rows):
    stream = feed(spark, real, str(tmp_path / "in"))
    columns = ["reading_id", "rolling_average_consumption", "consumption_variance", "night_usage_ratio"]
    got = feeds.run_rolling_features(stream, str(tmp_path / "out"), hot_rows=hot_rows).select(columns).orderBy("reading_id").collect()
    want = rolling_features(real).select(columns).orderBy("reading_id").collect()
    assert got == want


def test_streamed_demand_equals_batch(spark, real, tmp_path):
    from meterlake.operators.rollups import tick_totals

    marked = real.withColumns({"is_anomaly": F.lit(0), "status": F.lit("Normal")})
    stream = feed(spark, marked, str(tmp_path / "in"))
    got = feeds.run_hourly_demand(stream, str(tmp_path / "out")).orderBy("timestamp").collect()
    assert got == tick_totals(marked, "tick").orderBy("timestamp").collect()


def test_stream_without_repeats(spark, real, tmp_path):
    twice = real.unionByName(real).select("meter_id", "timestamp")
    stream = feed(spark, real.unionByName(real), str(tmp_path / "in")).select("meter_id", "timestamp")
    out = feeds.run_to_table(feeds.without_repeats(stream), str(tmp_path / "out"), "unique")
    assert out.count() == twice.distinct().count()


def test_ticks_keep_a_bounded_buffer(spark, real, tmp_path):
    stream = feed(spark, real, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    scored = feeds.run_ticks(
        stream, out, lambda df: df.withColumn("status", F.lit("Normal")),
        snapshots={"recent": lambda recent: recent}, side_outputs={"third": (3, lambda s: s)}, time_col="tick",
    )
    assert scored.count() == real.count()
    recent = feeds.newest_snapshot(spark, out, "recent")
    assert recent.select("tick").distinct().count() == 36
    assert sorted(r.batch for r in spark.read.parquet(f"{out}/third").select("batch").distinct().collect())[:2] == [0, 3]


def feed_of(spark, path, schema, *slices):
    """A folder that grows by one slice of rows a call, in several files; yields a stream each time."""
    for rows in slices:
        rows.repartition(3).write.mode("append").parquet(path)
        yield feeds.read_stream(spark, path, schema)


def test_rolling_features_do_not_depend_on_files_and_keep_late_rows_apart(spark, real, tmp_path):
    columns = ["reading_id", "rolling_average_consumption", "consumption_variance", "night_usage_ratio"]
    cut = real.agg(F.expr("min(timestamp) + (max(timestamp) - min(timestamp)) / 2")).head()[0]
    first, second = real.where(F.col("timestamp") < F.lit(cut)), real.where(F.col("timestamp") >= F.lit(cut))
    late = first.orderBy("timestamp", "reading_id").limit(5).withColumn("reading_id", F.col("reading_id") + 1_000_000)
    out = str(tmp_path / "out")
    for stream in feed_of(spark, str(tmp_path / "in"), real.schema, first, second.unionByName(late)):
        feeds.run_rolling_features(stream, out, finish=False)
    got = feeds.run_rolling_features(stream, out).select(columns).orderBy("reading_id").collect()
    assert got == rolling_features(real).select(columns).orderBy("reading_id").collect()
    assert spark.read.parquet(f"{out}/late").count() == 5


def test_a_tick_in_two_batches_is_scored_once(spark, tmp_path):
    rows = [(i, t, "M1") for t, ids in ((1, range(3)), (2, range(3, 6))) for i in ids]
    df = spark.createDataFrame(rows, "reading_id long, tick int, meter_id string")
    sizes = []

    def score(batch):
        sizes.append(sorted((r.tick, r["count"]) for r in batch.groupBy("tick").count().collect()))
        return batch

    out = str(tmp_path / "out")
    parts = [df.where("reading_id in (0, 1)"), df.where("reading_id in (2, 3)"), df.where("reading_id in (4, 5)")]
    for stream in feed_of(spark, str(tmp_path / "in"), df.schema, *parts):
        feeds.run_ticks(stream, out, score, time_col="tick", finish=False)
    scored = feeds.run_ticks(stream, out, score, time_col="tick")
    assert [s for s in sizes if s] == [[(1, 3)], [(2, 3)]] and scored.count() == 6


def test_demand_restarts_without_news(spark, real, tmp_path):
    marked = real.withColumns({"is_anomaly": F.lit(0), "status": F.lit("Normal")})
    stream = feed(spark, marked, str(tmp_path / "in"))
    first = feeds.run_hourly_demand(stream, str(tmp_path / "out")).count()
    assert feeds.run_hourly_demand(stream, str(tmp_path / "out")).count() == first


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from meterlake.plans.session import only_local

    assert only_local("local") and only_local("local[4]")
    assert not any(map(only_local, ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host")))
