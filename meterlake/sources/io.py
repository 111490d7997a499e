"""Readers and writers: CSV, Parquet, JSON, tables, record export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from meterlake.functions.numeric import clip
from meterlake.operators.clean import clean_readings
from meterlake.schema import READING_SCHEMA


def text_schema(columns: list[str] | None = None) -> T.StructType:
    """Every column as text, so that one bad cell never costs the row."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns or READING_SCHEMA.fieldNames()])


def load_readings(spark: SparkSession, path: str, fmt: str = "csv", max_rows: int | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned readings of a CSV, JSON or Parquet folder; a missing path gives an empty frame."""
    columns = [*READING_SCHEMA.fieldNames(), *extra]
    try:
        if fmt == "csv":
            raw = spark.read.schema(text_schema(columns)).option("header", True).option("enforceSchema", True).csv(path)
        elif fmt == "json":
            raw = spark.read.schema(text_schema(columns)).json(path)
        else:
            raw = spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raw = spark.createDataFrame([], text_schema(columns))
    if max_rows is not None:
        raw = raw.limit(max_rows)
    return clean_readings(raw)


def append_readings(df: DataFrame, path: str, fmt: str = "parquet", partition: bool = True) -> None:
    """Append readings as one distributed write, by event date unless told otherwise."""
    out = df.withColumn("event_date", F.to_date("timestamp")) if partition else df
    # In the order of meter and time, so that file statistics prune by meter.
    out = out.sortWithinPartitions(*(["event_date"] if partition else []), "meter_id", "timestamp")
    writer = out.write.mode("append").format(fmt)
    if partition:
        writer = writer.partitionBy("event_date")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def save_snapshot(df: DataFrame, table: str) -> None:
    """Replace a catalog table with the frame."""
    df.write.mode("overwrite").saveAsTable(table)


def run_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Ad-hoc SQL over named frames."""
    return spark.sql(sql, **frames)


def iso_time(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")


def export_records(df: DataFrame, limit: int | None = None, order: list[Column] | None = None) -> DataFrame:
    """Rows ready for JSON: ISO timestamps, NaN as null, optionally the first rows of an order."""
    if order:
        df = df.orderBy(*order)
    if limit is not None:
        df = df.limit(limit)
    out = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind in ("timestamp", "timestamp_ntz"):
            col = iso_time(col)
        elif kind in ("double", "float"):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(name))
    return df.select(*out)


def to_documents(df: DataFrame, name: str = "document") -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias(name))


def save_json(df: DataFrame, path: str) -> None:
    export_records(df).write.mode("overwrite").json(path)


REQUEST_SCHEMA = T.StructType([*READING_SCHEMA.fields])


def parse_requests(df: DataFrame, json: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON readings (one object or a list per row) to cleaned readings with defaults filled in.

    A missing timestamp becomes the current hour; a missing or zero expectation the consumption; a
    missing wastage score the relative over-consumption.
    """
    fields = ", ".join(f"{f.name}:{'string' if f.name == 'timestamp' else f.dataType.simpleString()}" for f in REQUEST_SCHEMA)
    listed = F.when(F.ltrim(json).startswith("["), F.from_json(json, f"array<struct<{fields}>>")).otherwise(
        F.array(F.from_json(json, f"struct<{fields}>"))
    )
    rows = df.select(*keep, F.explode(listed).alias("r")).select(*keep, "r.*")
    return clean_readings(fill_request_defaults(rows))


def fill_request_defaults(rows: DataFrame) -> DataFrame:
    used = F.col("consumption_kwh")
    rows = rows.withColumns(
        {
            "timestamp": F.coalesce(
                F.nullif("timestamp", F.lit("")), F.date_trunc("hour", F.current_timestamp()).cast("string")
            ),
            "expected_consumption_kwh": F.coalesce(F.nullif("expected_consumption_kwh", F.lit(0e0)), used),
            "region": F.coalesce("region", F.lit("Bengaluru")),
            "is_theft": F.coalesce("is_theft", F.lit(0)),
            "usage_profile": F.coalesce("usage_profile", F.lit("residential")),
            "theft_type": F.coalesce("theft_type", F.lit("unknown")),
            "seeded_theft_probability": F.coalesce("seeded_theft_probability", F.lit(0e0)),
        }
    )
    expected = F.greatest("expected_consumption_kwh", F.lit(0.1))
    return rows.withColumn("wastage_score", F.coalesce("wastage_score", clip((used - expected) / expected, low=0.0)))


WEATHER_JSON = (
    "struct<main:struct<temp:double,humidity:double>,wind:struct<speed:double>,rain:map<string,double>,"
    "weather:array<struct<main:string>>>"
)


def parse_weather(df: DataFrame, json: str = "payload") -> DataFrame:
    """Nested weather observation to flat columns; rain and wind default to 0."""
    parsed = df.withColumn("_w", F.from_json(json, WEATHER_JSON))
    return parsed.withColumns(
        {
            "temperature": F.col("_w.main.temp"),
            "humidity": F.col("_w.main.humidity"),
            "rainfall": F.coalesce(F.try_element_at("_w.rain", F.lit("1h")), F.lit(0e0)),
            "wind_speed": F.coalesce("_w.wind.speed", F.lit(0e0)),
            "weather_condition": F.try_element_at("_w.weather", F.lit(1))["main"],
            "source": F.lit("openweather"),
        }
    ).drop("_w", json)


def live_slice(df: DataFrame, catalog: DataFrame, meters: int = 120, days: int = 10) -> DataFrame:
    """Readings of the first meters of the catalog within the last days: a semi join, no duplicates."""
    chosen = catalog.select("meter_id").orderBy("meter_id").limit(meters)
    start = df.agg(F.max("timestamp") - F.make_dt_interval(F.lit(days))).scalar()
    return df.join(F.broadcast(chosen), "meter_id", "left_semi").where(F.col("timestamp") >= start)


def enrich_weather(df: DataFrame, weather: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Attach area weather to readings by area and hour, one observation each. Adaptive execution picks the join by size."""
    hourly = weather.dropDuplicates(["area", "timestamp"]).withColumnRenamed("timestamp", "_hour").withColumnRenamed("area", "_area")
    here = (F.col("area") == F.col("_area")) & (F.date_trunc("hour", time_col) == F.col("_hour"))
    return df.join(hourly, here, "left").drop("_area", "_hour")

