"""Alert rows, the alert feed and insight lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import column_or, round_to, with_default
from meterlake.schema import THEFT


def _text(col: Column, digits: int) -> Column:
    """Fixed-point text of a number, rounded half to even first."""
    return F.format_string(f"%.{digits}f", round_to(col, digits))


def alert_eligible(df: DataFrame) -> DataFrame:
    return df.where(F.col("risk_level").isin("High", "Critical"))


def alert_messages(df: DataFrame, limit: int = 5, tie: str = "reading_id") -> DataFrame:
    """Title and text of the riskiest rows."""
    keys = [F.desc(c) for c in ("risk_score", "theft_probability") if c in df.columns]
    df = with_default(df, "status", "Unknown")
    score = column_or(df, "risk_score")
    return (
        df.orderBy(*keys, tie)
        .limit(limit)
        .select(
            F.when(F.col("status") == THEFT, F.lit("Electricity Theft Detected")).otherwise("Smart Grid Risk Alert").alias("title"),
            "meter_id",
            "area",
            round_to(score, 2).alias("risk_score"),
            F.concat(
                F.lit("Meter "), "meter_id", F.lit(" in "), "area", F.lit(" scored "), _text(score, 1), F.lit(" with status "), "status", F.lit(".")
            ).alias("message"),
        )
    )


def alert_feed(df: DataFrame, drift: DataFrame | None = None) -> DataFrame:
    """Theft, anomaly, wastage and drift alerts in one list.

    One pass over the readings: a row yields an array of the alerts it deserves. `drift` is a report
    row (`drift_detected`, `prediction_rate_shift`), dated by its `generated_at` when it has one.
    """

    def alert(severity: str, category: str, summary: Column) -> Column:
        return F.struct(F.lit(severity).alias("severity"), F.lit(category).alias("category"), summary.alias("summary"))

    theft = alert(
        "Critical",
        "Electricity Theft Detected",
        F.concat(F.lit("Risk "), _text(column_or(df, "risk_score"), 1), F.lit(" | Probability "), _text(column_or(df, "theft_probability"), 2)),
    )
    anomaly = alert(
        "High",
        "Anomaly Detected",
        F.concat(F.lit("Anomaly "), _text(column_or(df, "anomaly_score"), 3), F.lit(" | Status "), "status"),
    )
    wastage = alert(
        "Medium",
        "Energy Wastage",
        F.concat(
            F.lit("Efficiency "), _text(column_or(df, "efficiency_score"), 1), F.lit("% | Losses "),
            _text(column_or(df, "estimated_losses_kwh"), 2), F.lit(" kWh"),
        ),
    )
    due = F.array_compact(
        F.array(
            F.when(F.col("status") == THEFT, theft),
            F.when((F.col("is_anomaly") == 1) | (F.col("status") == "Anomaly"), anomaly),
            F.when(column_or(df, "wastage_flag") == 1, wastage),
        )
    )
    feed = df.select("meter_id", "area", "timestamp", F.explode(due).alias("a")).select(
        "a.severity", "a.category", "meter_id", "area", "a.summary", "timestamp"
    )
    if drift is not None:
        stamp = F.col("generated_at").cast("timestamp") if "generated_at" in drift.columns else F.lit(None).cast("timestamp")
        feed = feed.unionByName(
            drift.where(F.col("drift_detected").cast("int") == 1).select(
                F.lit("High").alias("severity"),
                F.lit("Data Drift Detected").alias("category"),
                F.lit("-").alias("meter_id"),
                F.lit("System-wide").alias("area"),
                F.concat(F.lit("Concept shift "), _text(F.col("prediction_rate_shift"), 3)).alias("summary"),
                stamp.alias("timestamp"),
            )
        )
    return feed


def newest_alerts(feed: DataFrame, limit: int = 16) -> DataFrame:
    return feed.orderBy(F.desc("timestamp"), "severity", "category", "meter_id").limit(limit)


def alert_counts(feed: DataFrame) -> DataFrame:
    """Counts by severity and by category in one pass over the feed."""
    return (
        feed.groupingSets([[F.col("severity")], [F.col("category")]], "severity", "category")
        .agg(F.count("*").alias("alerts"))
        .select(
            F.when(F.col("severity").isNotNull(), F.lit("severity")).otherwise("category").alias("grouping"),
            F.coalesce("severity", "category").alias("name"),
            "alerts",
        )
    )


def insight_rows(facts: DataFrame) -> DataFrame:
    """Label / value lines from a one-row frame of facts (top_area, top_load, top_risk_area, top_risk,
    next_hour, low_efficiency, losses, drift, anomalies, theft)."""
    lines = {
        "Peak load area": F.concat("top_area", F.lit(" | "), _text(F.col("top_load"), 2), F.lit(" kWh")),
        "Top risk concentration": F.concat("top_risk_area", F.lit(" | risk "), _text(F.col("top_risk"), 1)),
        "Forecast next hour": F.concat(_text(F.col("next_hour"), 2), F.lit(" kWh")),
        "Efficiency pressure": F.concat(
            F.col("low_efficiency").cast("string"), F.lit(" low-efficiency meters | "), _text(F.col("losses"), 2), F.lit(" kWh estimated losses")
        ),
        "Data drift watch": F.when(F.col("drift") == 1, F.lit("Incoming data drift detected")).otherwise("Distribution stable"),
        "Anomaly posture": F.concat(F.col("anomalies").cast("string"), F.lit(" anomalies vs "), F.col("theft").cast("string"), F.lit(" theft alerts")),
    }
    pairs = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(k).alias("label"), v.alias("value")) for i, (k, v) in enumerate(lines.items())])
    return facts.select(F.explode(pairs).alias("r")).select("r.*")
