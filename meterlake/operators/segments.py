"""Consumer profiles, k-means segments and their summaries."""

from __future__ import annotations

import functools
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import exact_avg, with_default
from meterlake.operators.features import UNITS
from meterlake.operators.rollups import last_rows
from meterlake.plans.radix import exact_quantile
from meterlake.plans.ranges import approximate_quantile
from meterlake.schema import PROFILE_FEATURES, SEGMENTS, SUSPICIOUS


def consumer_profile(df: DataFrame, time_col: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """One row per meter from a frame with engineered features.

    A single aggregation with map-side combine. The last known region, area and profile are the
    ones with the greatest (time, key) among the non-null ones.
    """
    order = F.struct(time_col, tie)

    def last(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), order)).alias(name)

    units = F.rint(F.col("consumption_kwh") * UNITS)
    n = F.count("consumption_kwh").cast("double")
    sx = F.sum(units.cast("decimal(20,0)")).cast("double")
    sxx = F.sum((units * units).cast("decimal(30,0)")).cast("double")
    spread = F.sqrt(F.greatest(sxx - sx * sx / n, F.lit(0e0)) / F.nullif(n - 1e0, F.lit(0e0))) / UNITS

    def best(name: str) -> Column:
        found = F.max(name) if name in df.columns else exact_avg(F.col("consumption_kwh"))
        return found.alias(name)

    return df.groupBy("meter_id").agg(
        last("region"),
        last("area"),
        last("usage_profile"),
        exact_avg(F.col("consumption_kwh")).alias("avg_consumption_kwh"),
        F.max("consumption_kwh").alias("peak_consumption_kwh"),
        F.coalesce(spread, F.lit(0e0)).alias("consumption_std"),
        *[
            exact_avg(F.col(c)).alias(c)
            for c in ("night_usage_ratio", "peak_usage_ratio", "power_factor_loss", "voltage_irregularity")
        ],
        best("theft_probability"),
        best("anomaly_score"),
    )


def standardise(df: DataFrame, columns: list[str] = PROFILE_FEATURES, prefix: str = "z_") -> DataFrame:
    """Z-scores with the population deviation; a constant column becomes 0."""
    scale = 1e6
    n = F.count("*").cast("double")
    parts = []
    for c in columns:
        units = F.rint(F.coalesce(c, F.lit(0e0)) * scale).cast("decimal(20,0)")
        sx = F.sum(units).cast("double")
        sxx = F.sum((units * units).cast("decimal(38,0)")).cast("double")
        flat = F.min(units) == F.max(units)
        deviation = F.when(flat, F.lit(0e0)).otherwise(F.sqrt(F.greatest(sxx - sx * sx / n, F.lit(0e0)) / n) / scale)
        parts += [(sx / n / scale).alias(f"{c}_mean"), deviation.alias(f"{c}_dev")]
    limits = df.agg(F.struct(*parts).alias("s")).scalar()
    out = df.withColumn("_s", limits)
    z = {
        f"{prefix}{c}": F.coalesce(
            (F.coalesce(c, F.lit(0e0)) - F.col(f"_s.{c}_mean")) / F.nullif(F.col(f"_s.{c}_dev"), F.lit(0e0)), F.lit(0e0)
        )
        for c in columns
    }
    return out.withColumns(z).drop("_s")


#: Rows that first centres are drawn from; Lloyd's rounds always use all rows.
SEED_ROWS = 4096
CENTRE_SCALE = 1e9


def _first_centres(sample: np.ndarray, k: int, restarts: int, seed: int) -> np.ndarray:
    """restarts x k x d: each further centre is drawn with the squared distance to the nearest one so far as its weight."""
    out = np.empty((restarts, k, sample.shape[1]))
    for r in range(restarts):
        pick = np.random.default_rng(seed + r)
        out[r, 0] = sample[pick.integers(len(sample))]
        for j in range(1, k):
            weight = ((sample[:, None, :] - out[r, None, :j]) ** 2).sum(2).min(1)
            total = weight.sum()
            out[r, j] = sample[pick.choice(len(sample), p=weight / total) if total > 0 else pick.integers(len(sample))]
    return out


def _distances(columns: list[str], centres: np.ndarray) -> list[Column]:
    out = []
    for centre in centres:
        parts = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, centre, strict=True)]
        out.append(functools.reduce(operator.add, parts))
    return out


def _nearest(columns: list[str], centres: np.ndarray) -> Column:
    """Number and squared distance of the nearest centre, the first of equal ones."""
    far = F.array(*_distances(columns, centres))
    return F.struct((F.array_position(far, F.array_min(far)) - 1).cast("int").alias("c"), F.array_min(far).alias("d"))


LIMB = 2.0**32
#: Rows whose distances are in memory at once; sums of that many limbs are exact in a double.
BLOCK_ROWS = 8192


def _limbs(units: np.ndarray) -> list[np.ndarray]:
    """A whole number held in a double as three digits of base 2^32, the last one signed: low + mid * 2^32 + high * 2^64."""
    up = np.floor(units / LIMB)
    high = np.floor(up / LIMB)
    return [units - up * LIMB, up - high * LIMB, high]


def _round_of_rows(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """runs x k x (rows, limbs of the cost, limbs of every column's sum) of a block of rows, each counted with its nearest centre, the first
    of equal ones."""
    runs, k, width = centres.shape
    units = [np.rint(x[:, i] * CENTRE_SCALE) for i in range(width)]
    columns = [limb for u in units for limb in _limbs(u)]
    out = np.empty((runs, k, 4 + 3 * width))
    for r in range(runs):
        far = np.zeros((len(x), k))
        for i in range(width):  # added from the first column to the last, as a formula would
            step = x[:, i, None] - centres[r, None, :, i]
            far += step * step
        at = far.argmin(1)
        measures = [None, *_limbs(np.rint(far[np.arange(len(x)), at] * CENTRE_SCALE)), *columns]
        for j, measure in enumerate(measures):
            out[r, :, j] = np.bincount(at, weights=measure, minlength=k)
    return out


def _advance(df: DataFrame, columns: list[str], centres: np.ndarray) -> np.ndarray:
    """runs x k x (rows, limbs of the cost, limbs of every column's sum) of all rows: summed in the tasks, of which there are as many as
    the cluster runs at once, and then over their few numbers."""

    def run(batches):
        total = None
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            for i in range(0, len(values), BLOCK_ROWS):
                part = _round_of_rows(values[i : i + BLOCK_ROWS], centres).astype("int64")
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    tasks = df.select(*columns).coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism))
    shape = (*centres.shape[:2], 4 + 3 * centres.shape[2])
    found = [np.frombuffer(row["sums"], "int64").reshape(shape).astype(object) for row in tasks.mapInArrow(run, "sums binary").collect()]
    return sum(found, np.zeros(shape, object))


def fit_kmeans(df: DataFrame, columns: list[str], k: int, restarts: int = 10, seed: int = 42) -> np.ndarray | None:
    """Centres of the cheapest of several runs, at rest: each is the mean of the rows nearest to it. None without rows.

    All restarts advance together: a round is one aggregate of restarts x k rows over a single read of the points, in whole units, so
    centres do not depend on partitions. Centres travel as an array, so every round has the same plan. A centre without rows stays where
    it is.
    """
    sample = df.orderBy(*[F.hash(*columns)], *columns).limit(SEED_ROWS).select(*columns).toPandas().to_numpy(dtype=float)
    if not len(sample):
        return None
    k = max(1, min(k, len(sample)))
    centres = _first_centres(sample, k, restarts, seed)
    active = list(range(restarts))
    cost = np.zeros(restarts)

    while active:
        moved = centres.copy()
        for run, sums in zip(active, _advance(df, columns, centres[active]), strict=True):
            low, mid, high = (sums[:, 1 + j :: 3] for j in range(3))
            whole = low + mid * 2**32 + high * 2**64
            cost[run] = float(whole[:, 0].sum()) / CENTRE_SCALE
            for c in np.flatnonzero(sums[:, 0] > 0):
                moved[run, c] = [float(v) / sums[c, 0] / CENTRE_SCALE for v in whole[c, 1:]]
        active = [r for r in active if not np.array_equal(moved[r], centres[r])]
        centres = moved
    return centres[int(np.argmin(cost))]


def kmeans_clusters(df: DataFrame, columns: list[str], k: int = 3, restarts: int = 10, seed: int = 42) -> DataFrame:
    """Add `kmeans_cluster`: the cheapest of several seeded fits, k no greater than the row count. `df` is read once a round."""
    centres = fit_kmeans(df, columns, k, restarts, seed)
    return df.withColumn("kmeans_cluster", F.lit(0) if centres is None else _nearest(columns, centres)["c"])


def kmeans_at_rest(df: DataFrame, columns: list[str], cluster: str = "kmeans_cluster") -> DataFrame:
    """Add `nearest`: is the mean of the row's own cluster as near as any cluster's mean (to 10^-9)?"""
    means = df.groupBy(F.col(cluster).alias("_c")).agg(*[exact_avg(F.col(c), 9).alias(c) for c in columns])
    centres = means.agg(F.collect_list(F.struct("_c", F.array(*columns).alias("m")))).scalar()  # k rows
    own = F.array(*columns)

    def far(mean: Column) -> Column:
        return F.aggregate(F.zip_with(own, mean, lambda a, b: (a - b) * (a - b)), F.lit(0e0), lambda s, v: s + v)

    measured = df.withColumn("_means", centres)
    measured = measured.withColumn("_all", F.transform("_means", lambda e: F.struct(far(e["m"]).alias("d"), e["_c"].alias("c"))))
    mine = F.filter("_all", lambda e: e["c"] == F.col(cluster))[0]["d"]
    return measured.withColumn("nearest", mine <= F.array_min(F.transform("_all", lambda e: e["d"])) + 1e-9).drop("_all", "_means")


def segment_labels(df: DataFrame, cluster: str = "kmeans_cluster", value: str = "avg_consumption_kwh") -> DataFrame:
    """Name clusters by rising mean consumption; a handful of rows, joined back by broadcast."""
    from pyspark.sql import Window

    means = df.groupBy(cluster).agg(exact_avg(F.col(value)).alias("_mean"))  # k rows
    place = F.least(F.row_number().over(Window.orderBy("_mean", cluster)), F.lit(len(SEGMENTS)))
    names = means.select(cluster, F.element_at(F.array(*[F.lit(s) for s in SEGMENTS]), place).alias("segment"))
    return df.join(F.broadcast(names), cluster, "left").withColumn("segment", F.coalesce("segment", F.lit(SEGMENTS[0])))


def mark_suspicious(df: DataFrame, exact: bool = True) -> DataFrame:
    """Override the segment of meters with theft >= 0.75 or an anomaly score in the top 15 %."""
    quantile = (exact_quantile if exact else approximate_quantile)(df, "anomaly_score", 0.85).scalar()
    out = df.withColumn("_cut", quantile)
    suspicious = (F.coalesce("theft_probability", F.lit(0e0)) >= 0.75) | (
        F.coalesce("anomaly_score", F.lit(0e0)) >= F.rint(F.col("_cut") * 1e6) / 1e6
    )
    out = with_default(out, "segment", SEGMENTS[0])
    return out.withColumn("segment", F.when(suspicious, F.lit(SUSPICIOUS)).otherwise(F.col("segment"))).drop("_cut")


def cluster_profiles(profile: DataFrame, k: int = 3, restarts: int = 10, with_dbscan: bool = False) -> DataFrame:
    """Cluster and name meters from their profiles."""
    from meterlake.operators.dbscan import dbscan
    from meterlake.plans.session import cut_lineage

    profile = cut_lineage(standardise(profile))
    z = [f"z_{c}" for c in PROFILE_FEATURES]
    out = segment_labels(kmeans_clusters(profile, z, k, restarts))
    if with_dbscan:
        out = out.join(dbscan(profile, z, "meter_id"), "meter_id", "left")
    return mark_suspicious(out).drop(*z)


def cluster_consumers(df: DataFrame, k: int = 3, restarts: int = 10, with_dbscan: bool = False) -> DataFrame:
    """Profile, cluster and name the meters of a frame with engineered features."""
    return cluster_profiles(consumer_profile(df), k, restarts, with_dbscan)


def segment_summary(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("segment")
        .agg(F.countDistinct("meter_id").alias("meter_count"), exact_avg(F.col("avg_consumption_kwh")).alias("avg_consumption_kwh"))
        .orderBy(F.desc("meter_count"), "segment")
    )


def clustering_source(history: DataFrame, recent: DataFrame, rows: int | None = None) -> DataFrame:
    """The history (its newest rows only, if asked for) together with the recent rows; absent columns become null."""
    return (history if rows is None else last_rows(history, rows)).unionByName(recent, allowMissingColumns=True)


def suspicious_members(df: DataFrame, limit: int = 20) -> DataFrame:
    return df.where(F.col("segment") == SUSPICIOUS).orderBy(F.desc("theft_probability"), "meter_id").limit(limit)


def segment_highlights(df: DataFrame) -> DataFrame:
    """Meters, suspicious meters, the biggest segment and the greatest segment mean."""
    by_segment = segment_summary(df).select("segment", "meter_count", "avg_consumption_kwh")
    return by_segment.agg(
        F.sum("meter_count").alias("meters"),
        F.coalesce(F.sum(F.when(F.col("segment") == SUSPICIOUS, F.col("meter_count"))), F.lit(0)).alias("suspicious"),
        F.min_by("segment", F.struct(-F.col("meter_count"), F.col("segment"))).alias("dominant_segment"),
        F.max("avg_consumption_kwh").alias("highest_mean"),
    )
