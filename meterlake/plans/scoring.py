"""The whole scoring chain as one plan: clean, features, models, risk, efficiency, reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import round_to
from meterlake.operators.clean import clean_readings
from meterlake.operators.efficiency import efficiency_metrics
from meterlake.operators.explain import top_reasons
from meterlake.operators.features import add_engineered_features
from meterlake.operators.models import DetectionModels, score_models
from meterlake.operators.risk import INPUTS, score_risk
from meterlake.plans.session import cut_lineage


def score_readings(
    df: DataFrame, models: DetectionModels, by: str | None = None, scope: str = "history", tie: str = "reading_id"
) -> DataFrame:
    """Raw readings to scored readings."""
    features = add_engineered_features(clean_readings(df), tie=tie, scope=scope)
    return efficiency_metrics(score_risk(score_models(features, models), by=by, unit=("night_usage_ratio",)))


#: What the answer to a scoring request needs of a scored reading, besides the risk that is made of it.
ANSWER = ("meter_id", "region", "area", "latitude", "longitude", "status", "efficiency_score", "reason")


def predict(df: DataFrame, models: DetectionModels, tie: str = "reading_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """The answer to a scoring request: twelve fields per reading, rounded.

    Risk normalises over all rows, so rows are read twice once they are scored; what the answer needs of them is written between, and the
    models score each row once.
    """
    features = add_engineered_features(clean_readings(df), tie=tie)
    explained = top_reasons(efficiency_metrics(score_models(features, models)), models.importances())
    narrow = cut_lineage(explained.select(*dict.fromkeys([*keep, *ANSWER, *INPUTS.values()])))
    scored = score_risk(narrow, unit=("night_usage_ratio",))
    return scored.select(
        *keep,
        "meter_id",
        "region",
        "area",
        "latitude",
        "longitude",
        "status",
        round_to(F.col("theft_probability"), 4).alias("theft_probability"),
        round_to(F.col("anomaly_score"), 4).alias("anomaly_score"),
        round_to(F.col("risk_score"), 2).alias("risk_score"),
        "risk_level",
        round_to(F.col("efficiency_score"), 2).alias("efficiency_score"),
        "reason",
    )
