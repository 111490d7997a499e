"""Typing, clipping and flagging of raw readings; simple predicates over scored ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import clip, number, round_to
from meterlake.schema import NUMERIC_COLUMNS, THEFT


def temperature_band(temperature: Column) -> Column:
    """Right-closed bands; what no band covers is the text "nan"."""
    return (
        F.when((temperature > -10e0) & (temperature <= 20e0), F.lit("cool"))
        .when((temperature > 20e0) & (temperature <= 26e0), F.lit("mild"))
        .when((temperature > 26e0) & (temperature <= 32e0), F.lit("warm"))
        .when((temperature > 32e0) & (temperature <= 50e0), F.lit("hot"))
        .otherwise(F.lit("nan"))
    )


def typed_timestamp(df: DataFrame, name: str = "timestamp") -> Column:
    kind = dict(df.dtypes)[name]
    if kind == "timestamp":
        return F.col(name)
    if kind == "string":
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def clean_readings(df: DataFrame) -> DataFrame:
    """Drop rows without a readable timestamp, make every known measure a clipped double, add
    `wastage_flag`, `power_gap` and `temperature_band`. All row-wise: nothing is shuffled."""
    df = df.withColumn("timestamp", typed_timestamp(df)).where(F.col("timestamp").isNotNull())
    numeric = {c: number(F.col(c)) for c in NUMERIC_COLUMNS if c in df.columns}
    numeric["power_factor"] = clip(numeric["power_factor"], 0.0, 1.0)
    numeric["consumption_kwh"] = clip(numeric["consumption_kwh"], low=0.0)
    numeric["wastage_score"] = clip(numeric["wastage_score"], low=0.0)
    if "is_theft" in numeric:
        numeric["is_theft"] = numeric["is_theft"].cast("int")
    return df.withColumns(numeric).withColumns(
        {
            "wastage_flag": ((F.col("wastage_score") >= 0.25) | (F.col("power_factor") < 0.8)).cast("int"),
            "power_gap": round_to(F.col("power") - F.col("consumption_kwh"), 3),
            "temperature_band": temperature_band(F.col("temperature")),
        }
    )


def select_present(df: DataFrame, preferred: list[str]) -> DataFrame:
    """Projection to the preferred columns that exist, in that order."""
    return df.select([c for c in preferred if c in df.columns])


def at_latest(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Rows of the newest timestamp; the maximum is a subquery, so the filter reaches the scan."""
    newest = df.agg(F.max(time_col).alias("t")).scalar()
    return df.where(F.col(time_col) == newest)


def theft_rows(df: DataFrame) -> DataFrame:
    """Theft rows by the best evidence the schema offers: status, probability, label."""
    if "status" in df.columns:
        return df.where(F.col("status") == THEFT)
    if "theft_probability" in df.columns:
        return df.where(F.col("theft_probability") >= 0.75)
    if "is_theft" in df.columns:
        return df.where(F.col("is_theft") == 1)
    return df


def search_theft(df: DataFrame, text: str = "", area: str | None = None, sort: str = "risk_desc", tie: str = "reading_id") -> DataFrame:
    """Case-insensitive search over meter and area within theft rows, in one of three orders."""
    needle = text.strip().lower()
    found = theft_rows(df)
    if needle:
        found = found.where(
            F.lower(F.coalesce("meter_id", F.lit(""))).contains(needle) | F.lower(F.coalesce("area", F.lit(""))).contains(needle)
        )
    if area is not None:
        found = found.where(F.col("area") == area)
    key = {"risk_desc": "risk_score", "prob_desc": "theft_probability", "time_desc": "timestamp"}[sort]
    return found.orderBy(F.desc(key), tie)


def drop_repeats(df: DataFrame, time_col: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """Keep one row per meter and timestamp, the one with the smallest key."""
    from pyspark.sql import Window

    order = Window.partitionBy("meter_id", time_col).orderBy(tie)
    return df.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") == 1).drop("_nth")
