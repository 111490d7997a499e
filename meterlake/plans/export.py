"""Nested documents: the overview, the composite snapshot and the sample export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators import efficiency, risk, rollups
from meterlake.plans.session import cut_lineage
from meterlake.sources.io import export_records, to_documents, write_table


def gathered(df: DataFrame, order: list[str]) -> Column:
    """A short list of rows as one array column, in the order of the named columns.

    Only for rollups and top-k lists, whose length a limit or a dimension bounds.
    """
    keyed = df.select(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("o"), F.struct(*df.columns).alias("r"))
    listed = keyed.agg(F.sort_array(F.collect_list(F.struct("o", "r"))).alias("l"))
    return listed.select(F.transform("l", lambda e: e["r"])).scalar()


def overview_document(df: DataFrame, forecast: DataFrame | None = None, time_col: str = "timestamp") -> DataFrame:
    """Counts, timeline, area consumption, risk distribution and forecast in one row."""
    counts = rollups.overview(df)
    summary = counts.select(F.struct(*counts.columns).alias("summary"))
    out = summary.withColumns(
        {
            "timestamp": df.agg(F.date_format(F.max(time_col), "yyyy-MM-dd'T'HH:mm:ss")).scalar(),
            "live_consumption": gathered(export_records(rollups.live_timeline(df, time_col=time_col)), ["timestamp"]),
            "region_consumption": gathered(rollups.consumption_by_area(df), ["area"]),
            "risk_distribution": gathered(risk.risk_by_area(df), ["area"]),
        }
    )
    if forecast is not None:
        out = out.withColumn("forecast", gathered(forecast, ["series", "step"]))
    return out


def snapshot_document(df: DataFrame, segments: DataFrame | None = None, time_col: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """Every payload of the live view in one nested row.

    A dozen rollups read the same rows, so these are written to the checkpoint folder once.
    """
    used = [
        tie, "meter_id", "area", time_col, "timestamp", "consumption_kwh", "wastage_score", "humidity", "temperature_band", "is_anomaly",
        "status", "anomaly_score", "theft_probability", "risk_score", "risk_level", "efficiency_score", "estimated_losses_kwh", "wastage_flag",
    ]
    df = cut_lineage(df.select(list(dict.fromkeys(used))))
    overview = overview_document(df, time_col=time_col)
    out = overview.select(F.lit("live_tick").alias("type"), F.struct(*overview.columns).alias("overview"))
    levels = risk.risk_level_counts(df)
    summary = efficiency.efficiency_summary(df)
    brief = ["reading_id", "meter_id", "area", "status", "risk_score", "theft_probability", "efficiency_score"]
    lists = {
        "theft": rollups.theft_queue(df, 8, tie).select(brief),
        "meters": df.orderBy(F.desc("theft_probability"), F.desc("anomaly_score"), tie).limit(16).select(brief),
        "risk": risk.top_risk(df, 12, tie).select(brief),
        "efficiency": efficiency.worst_efficiency(df, 10, tie).select(brief),
        "weather": rollups.weather_impact(df),
    }
    columns = {name: gathered(rows, [rows.columns[0]]) for name, rows in lists.items()}
    columns["risk_levels"] = levels.select(F.struct(*levels.columns)).scalar()
    columns["efficiency_summary"] = summary.select(F.struct(*summary.columns)).scalar()
    if segments is not None:
        columns["segments"] = gathered(segments, [segments.columns[0]])
    return out.withColumns(columns)


def export_samples(df: DataFrame, path: str, tie: str = "reading_id", forecast: DataFrame | None = None) -> DataFrame:
    """Write the sample bundle below `path` and return its manifest (file, rows).

    The best row as request and as response, up to five theft rows, the overview and a 20-row CSV.
    """
    df = cut_lineage(df)  # read by every file of the bundle
    order = [F.desc("theft_probability"), F.desc("anomaly_score"), F.col(tie)]
    request = [
        "meter_id", "timestamp", "region", "area", "latitude", "longitude", "voltage", "current", "power", "consumption_kwh",
        "power_factor", "temperature", "humidity", "rainfall", "wind_speed", "weather_condition", "is_theft",
        "expected_consumption_kwh", "wastage_score", "usage_profile", "theft_type", "seeded_theft_probability",
    ]
    response = ["meter_id", "region", "area", "latitude", "longitude", "status", "theft_probability", "anomaly_score", "reason"]
    theft = df.where(F.col("status") == "Electricity Theft")
    best = df.orderBy(*order).limit(1)
    files = {
        "predict_request": best.select([c for c in request if c in df.columns]),
        "predict_response": best.select([c for c in response if c in df.columns]),
        "theft_response": theft.orderBy(*order).limit(5),
        "overview_response": overview_document(df, forecast),
    }
    for name, rows in files.items():
        to_documents(export_records(rows)).write.mode("overwrite").text(f"{path}/{name}")
    simple = [c for c, t in df.dtypes if not t.startswith(("array", "struct", "map"))]
    top = df.orderBy(*order).limit(20).select(simple)
    write_table(export_records(top), f"{path}/top_meter_snapshot", "csv")
    spark = df.sparkSession
    written = [(n, spark.read.text(f"{path}/{n}").count()) for n in files]
    written.append(("top_meter_snapshot", spark.read.option("header", True).csv(f"{path}/top_meter_snapshot").count()))
    manifest = spark.createDataFrame(written, "file string, rows bigint")
    write_table(manifest, f"{path}/manifest", "json")
    return manifest
