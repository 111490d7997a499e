"""Demand series, seasonal baselines, a learned lag forecaster and forecast tables.

A series has at most one row per hour, so windows over one series stay small whatever the number of
readings behind it; many series are spread by their key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.numeric import exact_sum, round_to
from meterlake.plans.session import cut_lineage

LOOKBACK = 24
HISTORY = 168
HORIZON = 168
LISTED = 48
# Weights of the seasonal value and of the window mean.
BASELINES = {"lstm": (0.65, 0.35), "transformer": (0.6, 0.4)}


def demand_series(df: DataFrame, by: str | None = None, time_col: str = "timestamp") -> DataFrame:
    """Consumption per hour: one series for the whole frame, or one per value of `by`."""
    key = F.lit("all") if by is None else F.col(by)
    return df.groupBy(key.alias("series"), F.date_trunc("hour", time_col).alias("timestamp")).agg(
        exact_sum(F.col("consumption_kwh")).alias("consumption_kwh")
    )


def series_range(series: DataFrame) -> DataFrame:
    """Length, minimum and maximum per series, and whether it is long enough to learn from."""
    return series.groupBy("series").agg(
        F.count("*").alias("points"),
        F.min("consumption_kwh").alias("low"),
        F.max("consumption_kwh").alias("high"),
        (F.count("*") > LOOKBACK + 8).alias("eligible"),
    )


def scale_series(series: DataFrame) -> DataFrame:
    """Add `scaled` in [0, 1] by the range of the series (0 for a constant one)."""
    ranged = series.join(series_range(series), "series")
    span = F.col("high") - F.col("low")
    return ranged.withColumn("scaled", F.coalesce((F.col("consumption_kwh") - F.col("low")) / F.nullif(span, F.lit(0e0)), F.lit(0e0)))


def unscale(value: Column, low: Column, high: Column) -> Column:
    return F.when(high == low, low).otherwise(value * (high - low) + low)


def history_tail(series: DataFrame, rows: int = HISTORY) -> DataFrame:
    """Last values of every eligible series, newest last: rounded, and scaled for the last window."""
    backwards = Window.partitionBy("series").orderBy(F.desc("timestamp"))
    return (
        scale_series(series)
        .where(F.col("eligible"))
        .withColumn("back", F.row_number().over(backwards))
        .where(F.col("back") <= rows)
        .select(
            "series",
            "timestamp",
            "back",
            round_to(F.col("consumption_kwh"), 3).alias("value"),
            F.when(F.col("back") <= LOOKBACK, round_to(F.col("scaled"), 6)).alias("scaled"),
        )
    )


def lag_matrix(series: DataFrame, value: str = "consumption_kwh", lags: int = LOOKBACK) -> DataFrame:
    """`lag_1` .. `lag_n` next to the target; the first `lags` points of a series have no full window."""
    order = Window.partitionBy("series").orderBy("timestamp")
    lagged = series.withColumns({f"lag_{i}": F.lag(value, i).over(order) for i in range(1, lags + 1)})
    return lagged.where(F.col(f"lag_{lags}").isNotNull())


def baseline_forecast(
    series: DataFrame, seasonal: float = 0.65, level: float = 0.35, horizon: int = HORIZON, history: DataFrame | None = None
) -> DataFrame:
    """Step i of the forecast mixes the value i % 24 of the last 24 with their mean.

    Fewer than 24 values of history give their flat mean, none gives 0. The history of a series is
    at most 168 values, kept as an array.
    """
    tail = history_tail(series) if history is None else history
    values = tail.groupBy("series").agg(
        F.transform(F.sort_array(F.collect_list(F.struct(-F.col("back"), "value"))), lambda e: e["value"]).alias("h")
    )
    joined = series.select("series").distinct().join(values, "series", "left").withColumn("h", F.coalesce("h", F.array().cast("array<double>")))

    def mean(a: Column) -> Column:
        units = F.aggregate(a, F.lit(0e0), lambda acc, v: acc + F.rint(v * 1e3))
        return units / 1e3 / F.size(a)

    size = F.size("h")
    window = F.slice("h", F.greatest(size - 23, F.lit(1)), F.lit(24))
    staged = joined.withColumn("w", window).withColumn("m", F.when(size > 0, mean(F.col("w"))))
    value = (
        F.when(size == 0, F.lit(0e0))
        .when(size < 24, F.col("m"))
        .otherwise(F.lit(seasonal) * F.element_at("w", F.col("step") % 24 + 1) + F.lit(level) * F.col("m"))
    )
    return staged.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1)))).select(
        "series", (F.col("step") + 1).alias("step"), value.alias("forecast")
    )


def horizons(forecast: DataFrame) -> DataFrame:
    """Next hour, day and week of every series (shorter forecasts count what there is)."""
    f = F.col("forecast")
    return forecast.groupBy("series").agg(
        round_to(F.max(F.when(F.col("step") == 1, f)), 2).alias("next_hour"),
        round_to(exact_sum(F.when(F.col("step") <= 24, f)), 2).alias("next_day"),
        round_to(exact_sum(F.when(F.col("step") <= 168, f)), 2).alias("next_week"),
    )


def listed_steps(forecast: DataFrame, steps: int = LISTED) -> DataFrame:
    return forecast.where(F.col("step") <= steps).select("series", "step", round_to(F.col("forecast"), 2).alias("forecast_kwh"))


def ensemble_horizons(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mean and distance of two models at each horizon."""
    a, b = horizons(first), horizons(second)
    names = ("next_hour", "next_day", "next_week")
    joined = a.select("series", *[F.col(c).alias(f"a_{c}") for c in names]).join(
        b.select("series", *[F.col(c).alias(f"b_{c}") for c in names]), "series"
    )
    return joined.select(
        "series",
        *[round_to((F.col(f"a_{c}") + F.col(f"b_{c}")) / 2e0, 2).alias(c) for c in names],
        *[F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")).alias(f"{c}_delta") for c in names],
    )


def compare_steps(first: DataFrame, second: DataFrame, steps: int = 12) -> DataFrame:
    """Both models step by step; a missing step counts as 0."""
    a = listed_steps(first).select("series", "step", F.col("forecast_kwh").alias("first_kwh"))
    b = listed_steps(second).select("series", "step", F.col("forecast_kwh").alias("second_kwh"))
    zero = F.lit(0e0)
    return (
        a.join(b, ["series", "step"], "full_outer")
        .where(F.col("step") <= steps)
        .select("series", "step", F.coalesce("first_kwh", zero).alias("first_kwh"), F.coalesce("second_kwh", zero).alias("second_kwh"))
        .withColumn("delta", F.col("second_kwh") - F.col("first_kwh"))
    )


def forecast_snapshot(forecasts: dict[str, DataFrame]) -> DataFrame:
    """Long table of the listed steps of every model."""
    parts = [listed_steps(f).withColumn("model_name", F.lit(name)) for name, f in forecasts.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Scaled values in whole units, so that sums of products are whole numbers and do not depend on the order of rows.
LAG_UNITS = 1e6
PENALTY = 1e-4


def lag_equations(series: DataFrame) -> DataFrame:
    """series, windows, gram, moments: sums of products of (1, lag 1 .. 24) with themselves and with the scaled value, for each eligible series.

    One mergeable aggregate of whole numbers: `gram` holds the upper triangle row by row (325 sums), `moments` 25.
    """
    scaled = scale_series(series).where(F.col("eligible"))
    unit = F.lit(LAG_UNITS)
    matrix = lag_matrix(scaled, "scaled")
    terms = [F.lit(int(LAG_UNITS)).cast("bigint"), *[F.rint(F.col(f"lag_{i}") * unit).cast("bigint") for i in range(1, LOOKBACK + 1)]]
    rows = matrix.select("series", F.array(*terms).alias("x"), F.rint(F.col("scaled") * unit).cast("bigint").alias("y"))
    n = LOOKBACK + 1
    gram = [F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(n) for j in range(i, n)]
    moments = [F.sum(F.col("x")[i] * F.col("y")) for i in range(n)]
    return rows.groupBy("series").agg(F.count("*").alias("windows"), F.array(*gram).alias("gram"), F.array(*moments).alias("moments"))


def _solve(windows: int, gram: list[int], moments: list[int]) -> tuple[np.ndarray, float]:
    """Coefficients (the constant first) of the ridge equations, and how far they are from holding."""
    n = len(moments)
    g = np.zeros((n, n))
    g[np.triu_indices(n)] = np.array(gram, float) / LAG_UNITS**2 / windows
    g = g + np.triu(g, 1).T
    g[np.arange(1, n), np.arange(1, n)] += PENALTY
    b = np.array(moments, float) / LAG_UNITS**2 / windows
    weights = np.linalg.solve(g, b)
    return weights, float(np.abs(g @ weights - b).max())


def fit_lag_model(series: DataFrame, min_rows: int = 64) -> DataFrame | None:
    """A linear model of the scaled value on its 24 lags for each series with `min_rows` windows: series, windows, bias, weights, residual.

    The equations of a series are one row; tasks solve them. `residual` is the largest gap left between their two sides. The models, a row
    a series, are written; None where no series has enough windows.
    """
    schema = "series string, windows long, bias double, weights array<double>, residual double"

    def run(frames):
        for frame in frames:
            solved = [_solve(*row) for row in zip(frame["windows"], frame["gram"], frame["moments"], strict=True)]
            yield pd.DataFrame(
                {
                    "series": frame["series"], "windows": frame["windows"], "bias": [float(w[0]) for w, _ in solved],
                    "weights": [w[1:].tolist() for w, _ in solved], "residual": [r for _, r in solved],
                },
            )

    models = cut_lineage(lag_equations(series).where(F.col("windows") >= min_rows).mapInPandas(run, schema))
    return None if models.isEmpty() else models


def lag_forecast(series: DataFrame, model: DataFrame | None, horizon: int = HORIZON, cap: float | None = None) -> DataFrame:
    """Recursive forecast of every series with its own fitted lag model; a series without one has its seasonal baseline.

    The recursion folds over the steps inside the JVM: the state is the window of the last 24 scaled
    values and the list of predictions so far. `cap` limits a scaled prediction to [0, cap].
    """
    if model is None:
        return baseline_forecast(series, horizon=horizon)
    newest_first = (
        history_tail(series, LOOKBACK)
        .groupBy("series")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("back", "scaled"))), lambda e: e["scaled"]).alias("w"))
    )

    def step(state: Column, _) -> Column:
        dot = F.aggregate(F.zip_with(state["w"], F.col("weights"), lambda x, c: x * c), F.col("bias"), lambda acc, v: acc + v)
        value = dot if cap is None else F.least(F.greatest(dot, F.lit(0e0)), F.lit(cap))
        return F.struct(
            F.slice(F.concat(F.array(value), state["w"]), 1, LOOKBACK).alias("w"),
            F.concat(state["out"], F.array(value)).alias("out"),
        )

    start = F.struct(F.col("w").alias("w"), F.array().cast("array<double>").alias("out"))
    fitted = newest_first.join(model.select("series", "bias", "weights"), "series")
    folded = fitted.withColumn("p", F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["out"])
    ranged = folded.join(series_range(series), "series")
    learned = ranged.select("series", "low", "high", F.posexplode("p").alias("i", "s")).select(
        "series", (F.col("i") + 1).alias("step"), unscale(F.col("s"), F.col("low"), F.col("high")).alias("forecast")
    )
    return learned.unionByName(baseline_forecast(series.join(model.select("series"), "series", "left_anti"), horizon=horizon))

