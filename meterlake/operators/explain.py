"""Why a reading scored as it did: the features that contributed most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.features import encode_features

# Reader-friendly names by feature prefix, first match wins.
FRIENDLY = {
    "consumption_kwh": "Sudden consumption shift",
    "night_usage_ratio": "High night-time usage",
    "voltage_irregularity": "Voltage irregularity",
    "current_power_gap": "Power-current mismatch",
    "power_factor_loss": "Power factor loss",
    "wastage_score": "Abnormal energy wastage",
    "rolling_average_consumption": "Deviation from normal rolling demand",
    "temperature": "Weather-driven load change",
    "humidity": "Humidity-linked load pattern",
    "rainfall": "Rainfall effect on electricity usage",
}


def friendly_name(feature: str) -> str:
    known = next((text for prefix, text in FRIENDLY.items() if feature.startswith(prefix)), None)
    return known or feature.replace("_", " ").title()


def top_reasons(df: DataFrame, importances: dict[str, float], top_k: int = 3) -> DataFrame:
    """Add `reason` (the k strongest features by |value x importance|) and `reason_summary`.

    The ranking happens inside each row on an array as long as the feature list: no shuffle, and all
    rows are explained at once. Equal contributions keep the order of the feature list.
    """
    names = list(importances)
    work = encode_features(df, names, keep=[F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")])
    return ranked_reasons(work, {n: F.col(f"`{n}`") * F.lit(float(importances[n])) for n in names}, top_k).select(
        "_row.*", "reason", "reason_summary"
    )


def ranked_reasons(df: DataFrame, contributions: dict[str, Column], top_k: int = 3) -> DataFrame:
    ranked = F.array_sort(
        F.array(
            *[
                F.struct((-F.abs(c)).alias("weight"), F.lit(i).alias("place"), F.lit(friendly_name(n)).alias("label"))
                for i, (n, c) in enumerate(contributions.items())
            ]
        )
    )
    out = df.withColumn("reason", F.transform(F.slice(ranked, 1, top_k), lambda e: e["label"]))
    return out.withColumn("reason_summary", F.array_join("reason", ", "))


def explain_highest(df: DataFrame, importances: dict[str, float], limit: int = 5, tie: str = "reading_id") -> DataFrame:
    keys = [F.desc(c) for c in ("theft_probability", "anomaly_score") if c in df.columns]
    return top_reasons(df.orderBy(*keys, tie).limit(limit), importances)
