"""Isolation forest, score threshold and rescaling.

The forest is small by construction (trees x 2 * sample nodes), so it is fitted on a bounded sample
drawn by hashes and scored as a broadcast node table over Arrow batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.numeric import round_to
from meterlake.plans.radix import exact_quantile
from meterlake.plans.ranges import approximate_quantile

THRESHOLD_QUANTILE = 0.97
NODE_SCHEMA = "tree int, node int, feature int, cut double, yes int, no int, depth double"


def average_depth(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    deep = 2.0 * (np.log(np.maximum(safe - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, deep))


@dataclass
class IsolationForest:
    """Node table of a fitted forest: one row per node, leaves have feature -1."""

    nodes: pd.DataFrame
    sample: int
    columns: list[str]


def _grow(tree: int, rows: np.ndarray, seed: int, limit: int) -> pd.DataFrame:
    rng = np.random.default_rng([seed, tree])
    table: list[tuple] = []
    open_nodes = [(0, rows, 0)]
    used = 1
    while open_nodes:
        node, part, depth = open_nodes.pop()
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (None, None)
        splittable = np.flatnonzero(high > low) if len(part) > 1 and depth < limit else []
        if len(splittable) == 0:
            table.append((tree, node, -1, 0.0, node, node, depth + float(average_depth(len(part)))))
            continue
        feature = int(rng.choice(splittable))
        cut = rng.uniform(low[feature], high[feature])
        left = part[:, feature] <= cut
        table.append((tree, node, feature, float(cut), used, used + 1, 0.0))
        open_nodes += [(used, part[left], depth + 1), (used + 1, part[~left], depth + 1)]
        used += 2
    return pd.DataFrame(table, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def fit_isolation_forest(
    df: DataFrame, columns: list[str], key: str = "reading_id", trees: int = 220, sample: int = 256, seed: int = 42
) -> IsolationForest:
    """Each tree sees `sample` rows in the order of a hash of (key, tree).

    A large frame is thinned by the hash before anything is shuffled, each row going to one tree; a
    small one offers its rows to as many trees as it takes. At most about 2 x trees x sample rows
    are shuffled, and each grouped task holds `sample` rows.
    """
    n = df.count()
    wanted = 2 * trees * sample
    copies = min(trees, max(1, math.ceil(wanted / max(n, 1))))
    keep = min(1.0, wanted / max(n * copies, 1)) if copies == 1 else 1.0
    drawn = (
        df.select(key, F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("x"))
        .where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < F.lit(int(keep * (1 << 30))))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("tree", F.pmod(F.xxhash64(key, F.lit(seed + 1)) % trees + F.col("copy"), F.lit(trees)).cast("int"))
    )
    order = Window.partitionBy("tree").orderBy(F.xxhash64(key, "tree", F.lit(seed + 2)), key)
    picked = drawn.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample).select("tree", key, "x")
    limit = math.ceil(math.log2(max(2, min(sample, max(n, 2)))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.vstack(pdf.sort_values(key)["x"].to_numpy())
        return _grow(int(pdf["tree"].iloc[0]), rows, seed, limit)

    nodes = picked.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()  # <= trees x 2 x sample rows
    return IsolationForest(nodes.sort_values(["tree", "node"]).reset_index(drop=True), min(sample, max(n, 2)), list(columns))


def _flatten(forest: IsolationForest) -> dict[str, np.ndarray]:
    """Node arrays with absolute positions, so that all trees are walked at once."""
    nodes = forest.nodes
    start = nodes.groupby("tree")["node"].size().cumsum().shift(fill_value=0)
    base = nodes["tree"].map(start).to_numpy()
    return {
        "roots": start.to_numpy().astype(np.int64),
        "feature": nodes["feature"].to_numpy().astype(np.int64),
        "cut": nodes["cut"].to_numpy(),
        "yes": nodes["yes"].to_numpy() + base,
        "no": nodes["no"].to_numpy() + base,
        "depth": nodes["depth"].to_numpy(),
    }


def score_rows(forest: dict[str, np.ndarray], x: np.ndarray, sample: int, levels: int) -> np.ndarray:
    """2^(-mean path / c(sample)) for a block of rows; higher is odder."""
    at = np.broadcast_to(forest["roots"], (len(x), len(forest["roots"]))).copy()
    rows = np.arange(len(x))[:, None]
    for _ in range(levels):
        feature = forest["feature"][at]
        value = x[rows, np.maximum(feature, 0)]
        at = np.where(value <= forest["cut"][at], forest["yes"][at], forest["no"][at])  # leaves point at themselves
    mean = forest["depth"][at].mean(axis=1)
    return np.power(2.0, -mean / float(average_depth(sample)))


def score_anomalies(df: DataFrame, forest: IsolationForest, score: str = "anomaly_score") -> DataFrame:
    """Add the isolation score of every row; the other columns never leave the JVM."""
    shared = df.sparkSession.sparkContext.broadcast(_flatten(forest))
    sample, levels = forest.sample, math.ceil(math.log2(max(2, forest.sample)))

    @F.pandas_udf("double")
    def isolation(x: pd.Series) -> pd.Series:
        matrix = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        parts = [score_rows(shared.value, matrix[i : i + 2048], sample, levels) for i in range(0, len(matrix), 2048)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    vector = F.array(*[F.col(f"`{c}`").cast("double") for c in forest.columns])
    return df.withColumn(score, isolation(vector))


def score_threshold(df: DataFrame, score: str = "anomaly_score", p: float = THRESHOLD_QUANTILE, exact: bool = True) -> DataFrame:
    """Cut-off above which a score counts as an anomaly, as a one-row frame (`threshold`)."""
    found = (exact_quantile if exact else approximate_quantile)(df, score, p)
    return found.select(round_to(F.col("quantile"), 6).alias("threshold"))


def flag_anomalies(df: DataFrame, threshold: DataFrame | float, score: str = "anomaly_score") -> DataFrame:
    cut: Column = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold.select("threshold").scalar()
    out = df.withColumn("threshold", cut)
    return out.withColumn("is_anomaly", (F.col(score) >= F.col("threshold")).cast("int"))


def rescale_scores(df: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """Scores to [0, 1] by the range of the frame; constant scores stay as they are."""
    limits = df.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi")).alias("r")).scalar()
    out = df.withColumn("_r", limits)
    span = F.col("_r.hi") - F.col("_r.lo")
    return out.withColumn(
        "scaled_score", F.when(span > 0, (F.col(score) - F.col("_r.lo")) / F.nullif(span, F.lit(0e0))).otherwise(F.col(score))
    ).drop("_r")
