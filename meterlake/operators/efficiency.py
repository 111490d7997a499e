"""Energy efficiency, losses and their rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import (
    clip,
    column_or,
    count_if,
    exact_avg,
    exact_sum,
    ratio,
    round_to,
)


def efficiency_metrics(df: DataFrame) -> DataFrame:
    """Add `efficiency_score`, `estimated_losses_kwh` and the efficiency form of `wastage_flag`."""
    expected = column_or(df, "expected_consumption_kwh" if "expected_consumption_kwh" in df.columns else "consumption_kwh")
    used = clip(column_or(df, "consumption_kwh"), low=0.0)
    factor = clip(column_or(df, "power_factor", 1.0), 0.0, 1.0)
    useful = F.least(expected, used)
    share = ratio(useful, F.nullif(F.greatest(expected, used), F.lit(0e0))) * factor
    losses = F.greatest(used - useful, F.lit(0e0)) + (F.lit(1e0) - factor) * used
    out = df.withColumns(
        {
            "efficiency_score": round_to(clip(share, 0.0, 1.0) * 1e2, 2),
            "estimated_losses_kwh": round_to(losses, 3),
        }
    )
    flag = (F.col("efficiency_score") < 72e0) | (column_or(df, "wastage_score") >= 0.25)
    return out.withColumn("wastage_flag", flag.cast("int"))


def efficiency_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        count_if(F.col("wastage_flag") == 1).alias("low_efficiency"),
        F.coalesce(round_to(exact_avg(F.col("efficiency_score"), 2), 2), F.lit(0e0)).alias("average_efficiency"),
        F.coalesce(round_to(exact_sum(F.col("estimated_losses_kwh"), 3), 2), F.lit(0e0)).alias("estimated_losses_kwh"),
    )


def worst_efficiency(df: DataFrame, limit: int = 20, tie: str = "reading_id") -> DataFrame:
    return df.orderBy(F.desc("wastage_flag"), "efficiency_score", tie).limit(limit)


def efficiency_by_area(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.coalesce("area", F.lit("Unknown")).alias("area"))
        .agg(
            exact_avg(F.col("efficiency_score"), 2).alias("efficiency"),
            exact_sum(F.col("estimated_losses_kwh"), 3).alias("losses"),
        )
        .orderBy("efficiency", "area")
    )


def mean_power_factor_loss(df: DataFrame, limit: int = 20) -> DataFrame:
    """Mean power-factor loss over the worst records (0 when there are none)."""
    loss = F.coalesce("power_factor_loss", F.lit(0e0))
    return worst_efficiency(df, limit).agg(F.coalesce(exact_avg(loss), F.lit(0e0)).alias("mean_power_factor_loss"))
