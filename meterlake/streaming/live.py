"""What a live view keeps of all ticks so far, as sums that merge: profiles of meters, demand per hour, column sums.

A batch adds its own sums to the buckets it touches; consumer segments, forecasts and the drift report follow from the sums, so no history
is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import drift, forecast, segments
from meterlake.operators.features import UNITS
from meterlake.plans.session import cut_lineage
from meterlake.streaming.buckets import BucketTable

MEANS = ("night_usage_ratio", "peak_usage_ratio", "power_factor_loss", "voltage_irregularity")
LAST = ("region", "area", "usage_profile")
SCALE = 1e6


def _units(column: Column, scale: float = SCALE) -> Column:
    return F.rint(column * F.lit(scale)).cast("decimal(20,0)")


def profile_sums(df: DataFrame, time_col: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """One row per meter: counts, sums, squares, maxima, and the last known names with their time."""
    kwh = F.col("consumption_kwh")
    fine = _units(kwh, UNITS)

    def last(name: str) -> Column:
        return F.max(F.when(F.col(name).isNotNull(), F.struct(F.col(time_col).alias("t"), F.col(tie).alias("k"), F.col(name).alias("v")))).alias(f"last_{name}")

    means = [x for c in ("consumption_kwh", *MEANS) for x in (F.sum(_units(F.col(c))).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}"))]
    return df.groupBy("meter_id").agg(
        *means,
        F.sum(fine).alias("sum_fine"),
        F.sum((fine * fine).cast("decimal(38,0)")).alias("sum_squares"),
        F.max("consumption_kwh").alias("peak"),
        F.max("theft_probability").alias("theft_probability"),
        F.max("anomaly_score").alias("anomaly_score"),
        *[last(c) for c in LAST],
    )


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Rows of `profile_sums` of several batches as one row per meter."""
    kind = dict(parts.dtypes)
    sums = [c for c in parts.columns if c.startswith(("sum_", "n_"))]
    most = [c for c in parts.columns if c not in sums and c != "meter_id"]
    return parts.groupBy("meter_id").agg(*[F.sum(c).cast(kind[c]).alias(c) for c in sums], *[F.max(c).alias(c) for c in most]).select(parts.columns)


def profiles_of(sums: DataFrame) -> DataFrame:
    """The consumer profile, as `segments.consumer_profile` has it from the rows themselves."""

    def mean(name: str) -> Column:
        return F.try_divide(F.col(f"sum_{name}").cast("double") / F.lit(SCALE), F.col(f"n_{name}").cast("double"))

    n, sx, sxx = F.col("n_consumption_kwh").cast("double"), F.col("sum_fine").cast("double"), F.col("sum_squares").cast("double")
    spread = F.sqrt(F.greatest(sxx - sx * sx / n, F.lit(0e0)) / F.nullif(n - 1e0, F.lit(0e0))) / UNITS
    return sums.select(
        "meter_id",
        *[F.col(f"last_{c}.v").alias(c) for c in LAST],
        mean("consumption_kwh").alias("avg_consumption_kwh"),
        F.col("peak").alias("peak_consumption_kwh"),
        F.coalesce(spread, F.lit(0e0)).alias("consumption_std"),
        *[mean(c).alias(c) for c in MEANS],
        "theft_probability",
        "anomaly_score",
    )


def demand_sums(df: DataFrame, by: str = "area", time_col: str = "timestamp") -> DataFrame:
    """Whole units of consumption per series and hour."""
    hour = F.date_trunc("hour", time_col)
    return df.groupBy(F.col(by).alias("series"), hour.alias("timestamp"), F.to_date(hour).alias("day")).agg(F.sum(_units(F.col("consumption_kwh"))).alias("units"))


def demand_of(sums: DataFrame) -> DataFrame:
    return sums.select("series", "timestamp", (F.col("units").cast("double") / F.lit(SCALE)).alias("consumption_kwh"))


def merge_demand(parts: DataFrame) -> DataFrame:
    kind = dict(parts.dtypes)["units"]
    return parts.groupBy("series", "timestamp", "day").agg(F.sum("units").cast(kind).alias("units"))


class LiveState:
    """The sums of a feed below a folder, and the tables that follow from them after each batch."""

    TABLES = ("consumer_segments", "forecast_snapshots", "drift_reports")

    def __init__(
        self, spark: SparkSession, folder: str, columns: list[str], time_col: str = "timestamp", clusters: int = 3, names: tuple[str, ...] = TABLES
    ):
        self.columns, self.time_col, self.clusters, self.names = columns, time_col, clusters, names
        self.profiles = BucketTable(spark, f"{folder}/profile_sums", ["meter_id"])
        self.demand = BucketTable(spark, f"{folder}/demand_sums", ["series", "day"])
        self.sums = BucketTable(spark, f"{folder}/column_sums", ["feature"], 1)

    @staticmethod
    def _add(table: BucketTable, new: DataFrame, merge, number: int) -> DataFrame:
        """Add the sums of a batch to the touched buckets; all rows of the table as they are then."""
        new = cut_lineage(new)
        old = table.read(table.touched(new), number)
        table.write(merge(new if old is None else new.unionByName(old)), number)
        return table.read(before=number + 1)

    def _segments(self, scored: DataFrame, recent: DataFrame, number: int) -> DataFrame:
        sums = self._add(self.profiles, profile_sums(scored, self.time_col), merge_profiles, number)
        return segments.cluster_profiles(profiles_of(sums), self.clusters, with_dbscan=True)

    def _forecasts(self, scored: DataFrame, recent: DataFrame, number: int) -> DataFrame:
        series = cut_lineage(demand_of(self._add(self.demand, demand_sums(scored, time_col=self.time_col), merge_demand, number)))
        return forecast.forecast_snapshot({n: forecast.baseline_forecast(series, *w) for n, w in forecast.BASELINES.items()})

    def _drift(self, scored: DataFrame, recent: DataFrame, number: int) -> DataFrame:
        history = self._add(self.sums, drift.column_sums(scored.select(self.columns)), drift.merge_sums, number)
        current = cut_lineage(drift.column_sums(recent.select(self.columns)))
        return drift.report_of(history, current, drift.has_repeats(recent, self.time_col))

    def tables(self, scored: DataFrame, recent: DataFrame, number: int) -> dict[str, DataFrame]:
        """The tables named, after a batch of scored ticks."""
        build = dict(zip(self.TABLES, (self._segments, self._forecasts, self._drift), strict=True))
        return {name: build[name](scored, recent, number) for name in self.names}
