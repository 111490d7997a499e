"""Fitting, tuning, storing and applying the theft and anomaly models."""

from __future__ import annotations

import json
import random
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.anomaly import (
    IsolationForest,
    fit_isolation_forest,
    flag_anomalies,
    rescale_scores,
    score_anomalies,
    score_threshold,
)
from meterlake.operators.explain import ranked_reasons
from meterlake.operators.features import assemble, encode_features
from meterlake.operators.theft import class_weights, classifier_metrics, classify, stratified_split
from meterlake.plans.session import cut_lineage
from meterlake.schema import MODEL_CATEGORICAL


@dataclass
class ModelSizes:
    """Sizes of the learners; the defaults are the full ones."""

    isolation_trees: int = 220
    forest_trees: int = 240
    forest_depth: int = 16
    boost_rounds: int = 220
    boost_depth: int = 6
    boost_rate: float = 0.08


@dataclass
class DetectionModels:
    columns: list[str]
    isolation: IsolationForest
    threshold: float
    forest: RandomForestClassificationModel
    boost: GBTClassificationModel
    metrics: dict = field(default_factory=dict)

    def importances(self) -> dict[str, float]:
        """Importance of every feature in the boosted trees, by name."""
        return dict(zip(self.columns, (float(v) for v in self.boost.featureImportances.toArray())))


def _forest(sizes: ModelSizes, label: str, seed: int) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="class_weight", numTrees=sizes.forest_trees,
        maxDepth=sizes.forest_depth, minInstancesPerNode=2, seed=seed, probabilityCol="forest_p",
        predictionCol="forest_y", rawPredictionCol="forest_raw",
    )


def _boost(sizes: ModelSizes, label: str, seed: int) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label, featuresCol="features", maxIter=sizes.boost_rounds, maxDepth=sizes.boost_depth,
        stepSize=sizes.boost_rate, subsamplingRate=0.85, featureSubsetStrategy="0.9", seed=seed, predictionCol="boost_y",
    ).setProbabilityCol("boost_p").setRawPredictionCol("boost_raw")


def positive(col: str) -> Column:
    return vector_to_array(F.col(col))[1]


def _probabilities(vectors: DataFrame, forest, boost) -> DataFrame:
    out = boost.transform(forest.transform(vectors))
    scored = out.withColumns({"random_forest_probability": positive("forest_p"), "xgboost_probability": positive("boost_p")})
    return scored.drop("features", "forest_p", "forest_y", "forest_raw", "boost_p", "boost_y", "boost_raw")


def _split(df: DataFrame, columns: list[str], label: str, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, read from the checkpoint folder by every fit that follows; they are written as they are and encoded when read."""
    needed = {key, label, *columns, *MODEL_CATEGORICAL}
    narrow = df.select([F.col(f"`{c}`") for c in df.columns if c in needed])
    parts = encode_features(cut_lineage(stratified_split(narrow, label=label, key=key, seed=seed)), columns, keep=[key, label, "is_test"])
    return parts.where(F.col("is_test") == 0), parts.where(F.col("is_test") == 1)


def _normal(train: DataFrame, label: str, least: int = 1) -> DataFrame:
    normal = train.where(F.col(label) == 0)
    return normal if normal.limit(least).count() >= least else train


def train_models(
    df: DataFrame, columns: list[str], sizes: ModelSizes | None = None, label: str = "is_theft", key: str = "reading_id", seed: int = 42
) -> DetectionModels:
    """Fit the isolation forest on normal training rows, both classifiers on all, measure on the rest."""
    sizes = sizes or ModelSizes()
    train, test = _split(df, columns, label, key, seed)
    normal = _normal(train, label)
    isolation = fit_isolation_forest(normal, columns, key, trees=sizes.isolation_trees, seed=seed)
    threshold = score_threshold(cut_lineage(score_anomalies(normal, isolation).select("anomaly_score"))).first()["threshold"]
    vectors = assemble(class_weights(train, label), columns, keep=[key, label, "class_weight"])
    forest = _forest(sizes, label, seed).fit(vectors)
    boost = _boost(sizes, label, seed).fit(vectors)
    checked = _probabilities(assemble(test, columns, keep=[key, label]), forest, boost)
    metrics = classifier_metrics(cut_lineage(classify(checked).select("theft_probability", label)), label=label).first().asDict()
    metrics.update(training_rows=train.count() + test.count(), feature_count=len(columns))
    return DetectionModels(list(columns), isolation, float(threshold), forest, boost, metrics)


def score_models(df: DataFrame, models: DetectionModels) -> DataFrame:
    """Add anomaly score and flag, both probabilities, their blend and the status."""
    named = encode_features(df, models.columns, keep=[F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")])
    scored = score_anomalies(named, models.isolation, "_anomaly")
    vectors = assemble(scored, models.columns, keep=["_row", "_anomaly"])
    out = _probabilities(vectors, models.forest, models.boost)
    added = ("anomaly_score", "threshold", "is_anomaly", "random_forest_probability", "xgboost_probability")
    kept = [c for c in df.columns if c not in added]
    flat = out.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in kept], F.col("_anomaly").alias("anomaly_score"),
        "random_forest_probability", "xgboost_probability",
    )
    return classify(flag_anomalies(flat, models.threshold).drop("threshold"))


# Parameters used when tuning is not possible.
DEFAULT_PARAMETERS = {"contamination": 0.05, "max_depth": 16, "learning_rate": 0.08, "best_score": None, "method": "default"}


def tune(
    df: DataFrame, columns: list[str], trials: int = 10, sizes: ModelSizes | None = None, label: str = "is_theft",
    key: str = "reading_id", seed: int = 42,
) -> dict:
    """Seeded random search over forest depth and boosting rate; too few rows or one class give the
    defaults. Contamination does not change any score here, so it is carried but not searched."""
    classes = df.select(label).distinct().limit(2).count()
    if df.limit(100).count() < 100 or classes < 2:
        return dict(DEFAULT_PARAMETERS)
    sizes = sizes or ModelSizes(isolation_trees=160, forest_trees=180, boost_rounds=180)
    train, test = _split(df, columns, label, key, 42)
    isolation = fit_isolation_forest(_normal(train, label, 10), columns, key, trees=sizes.isolation_trees)
    vectors = cut_lineage(assemble(class_weights(train, label), columns, keep=[key, label, "class_weight"]))
    odd = rescale_scores(score_anomalies(test, isolation))
    checked = cut_lineage(assemble(odd, columns, keep=[key, label, "scaled_score"]))
    pick = random.Random(seed)
    best = dict(DEFAULT_PARAMETERS)
    for _ in range(trials):
        depth, rate = pick.randint(8, 24), pick.uniform(0.03, 0.16)
        tried = ModelSizes(**{**sizes.__dict__, "forest_depth": depth, "boost_rate": rate})
        scored = _probabilities(checked, _forest(tried, label, 42).fit(vectors), _boost(tried, label, 42).fit(vectors))
        blend = (
            F.lit(0.25) * F.col("scaled_score") + F.lit(0.30) * F.col("random_forest_probability")
            + F.lit(0.45) * F.col("xgboost_probability")
        )
        row = classifier_metrics(cut_lineage(scored.select(label, blend.alias("blend"))), "blend", label).first()
        value = 0.55 * row["f1_score"] + 0.45 * row["roc_auc"]
        if best["best_score"] is None or value > best["best_score"]:
            best = {"contamination": 0.05, "max_depth": depth, "learning_rate": round(rate, 4), "best_score": round(value, 4), "method": "random search"}
    return best


def save_models(spark: SparkSession, models: DetectionModels, path: str) -> None:
    models.forest.write().overwrite().save(f"{path}/forest")
    models.boost.write().overwrite().save(f"{path}/boost")
    spark.createDataFrame(models.isolation.nodes).coalesce(1).write.mode("overwrite").parquet(f"{path}/isolation")
    facts = {
        "columns": models.columns, "threshold": models.threshold, "sample": models.isolation.sample, "metrics": models.metrics,
    }
    spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def load_models(spark: SparkSession, path: str) -> DetectionModels:
    facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
    nodes = spark.read.parquet(f"{path}/isolation").toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
    return DetectionModels(
        facts["columns"], IsolationForest(nodes, facts["sample"], facts["columns"]), facts["threshold"],
        RandomForestClassificationModel.load(f"{path}/forest"), GBTClassificationModel.load(f"{path}/boost"), facts["metrics"],
    )


def tree_nodes(spark: SparkSession, boost_path: str) -> pd.DataFrame:
    """Node table of stored boosted trees: bounded by rounds x 2^(depth + 1) rows."""
    data = spark.read.parquet(f"{boost_path}/data")
    weights = spark.read.parquet(f"{boost_path}/treesMetadata").toDF("tree", "about", "weights").select("tree", "weights")
    nodes = data.select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("cut"),
    )
    return nodes.join(F.broadcast(weights), "tree").toPandas().sort_values(["tree", "node"]).reset_index(drop=True)


def tree_contributions(df: DataFrame, nodes: pd.DataFrame, columns: list[str], top_k: int = 3) -> DataFrame:
    """Per-row path attribution: each split credits its feature with the change of the node's value.

    Contributions are computed over Arrow batches against the broadcast nodes; ranking them is left
    to the JVM. Adds `contributions`, `reason` and `reason_summary`.
    """
    trees = []
    for _, part in nodes.groupby("tree", sort=True):
        part = part.set_index("node")
        leaf = part["left"].to_numpy() < 0
        at = np.arange(len(part))
        trees.append(
            (
                part["feature"].to_numpy(), part["cut"].fillna(0.0).to_numpy(), np.where(leaf, at, part["left"].to_numpy()),
                np.where(leaf, at, part["right"].to_numpy()), part["value"].to_numpy(), leaf, float(part["weights"].iloc[0]),
            )
        )
    shared = df.sparkSession.sparkContext.broadcast(trees)
    width = len(columns)

    @F.pandas_udf("array<double>")
    def attribute(x: pd.Series) -> pd.Series:
        matrix = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, width))
        total = np.zeros_like(matrix)
        rows = np.arange(len(matrix))
        for feature, cut, left, right, value, leaf, weight in shared.value:
            at = np.zeros(len(matrix), dtype=np.int64)
            while not leaf[at].all():
                live = ~leaf[at]
                f = np.maximum(feature[at], 0)
                step = np.where(matrix[rows, f] <= cut[at], left[at], right[at])
                np.add.at(total, (rows[live], f[live]), weight * (value[step] - value[at])[live])
                at = step
        return pd.Series(list(total))

    out = df.withColumn("contributions", attribute(F.array(*[F.col(f"`{c}`").cast("double") for c in columns])))
    return ranked_reasons(out, {c: F.col("contributions")[i] for i, c in enumerate(columns)}, top_k)
