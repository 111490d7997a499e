"""Operational rollups over scored readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.numeric import count_if, exact_avg, exact_sum, round_to, with_default
from meterlake.operators.clean import at_latest, theft_rows
from meterlake.schema import ANOMALY, THEFT


def latest_per_meter(df: DataFrame, limit: int | None = None, time_col: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """Newest row of every meter. Spark keeps one row per meter and task before the shuffle."""
    newest = Window.partitionBy("meter_id").orderBy(F.desc(time_col), F.desc(tie))
    out = df.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") == 1).drop("_nth")
    return out if limit is None else out.orderBy(F.desc(time_col), F.desc(tie)).limit(limit)


def last_rows(df: DataFrame, n: int, time_col: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """The n newest rows (a distributed top-n, no full sort)."""
    return df.orderBy(F.desc(time_col), F.desc(tie)).limit(n)


def overview(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Meter and incident counts over the newest row of each meter."""
    for name, value in (("is_anomaly", 0), ("status", "Normal"), ("wastage_flag", 0)):
        df = with_default(df, name, value)
    total = (df if history is None else history).agg(F.countDistinct("meter_id")).scalar()
    return latest_per_meter(df).agg(
        F.count("meter_id").alias("active_meters"),
        count_if(F.col("is_anomaly") == 1).alias("anomalies"),
        count_if(F.col("status") == THEFT).alias("theft"),
        count_if(F.col("wastage_flag") == 1).alias("wastage"),
    ).withColumn("total_meters", total)


def consumption_by_area(df: DataFrame) -> DataFrame:
    df = with_default(with_default(df, "area", "Unknown"), "consumption_kwh", 0.0)
    return (
        df.where(F.col("area").isNotNull())
        .groupBy("area")
        .agg(exact_sum(F.col("consumption_kwh")).alias("consumption_kwh"))
        .orderBy(F.desc("consumption_kwh"), "area")
    )


def weather_impact(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("temperature_band")
        .agg(
            exact_avg(F.col("consumption_kwh")).alias("avg_consumption"),
            exact_avg(F.col("wastage_score")).alias("avg_wastage"),
            exact_avg(F.col("humidity")).alias("avg_humidity"),
        )
        .orderBy("temperature_band")
    )


def tick_totals(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    for name, value in (("consumption_kwh", 0.0), ("is_anomaly", 0), ("status", "Normal")):
        df = with_default(df, name, value)
    return df.groupBy(F.col(time_col).alias("timestamp")).agg(
        exact_sum(F.col("consumption_kwh")).alias("total_consumption"),
        count_if(F.col("is_anomaly") == 1).alias("anomalies"),
        count_if(F.col("status") == THEFT).alias("theft"),
    )


def live_timeline(df: DataFrame, ticks: int = 24, time_col: str = "timestamp") -> DataFrame:
    """Totals of the last ticks, oldest first."""
    return tick_totals(df, time_col).orderBy(F.desc("timestamp")).limit(ticks).orderBy("timestamp")


def tick_timeline(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return df.select(F.col(time_col).alias("timestamp")).distinct().orderBy("timestamp")


def anomaly_rows(df: DataFrame) -> DataFrame:
    return df.where((F.col("is_anomaly") == 1) | (F.col("status") == ANOMALY))


def anomaly_queue(df: DataFrame, limit: int = 25, tie: str = "reading_id") -> DataFrame:
    return anomaly_rows(df).orderBy(F.desc("anomaly_score"), F.desc("risk_score"), tie).limit(limit)


def anomaly_summary(df: DataFrame) -> DataFrame:
    """Counts over all anomalies, whatever part of them a queue lists."""
    zero = F.lit(0e0)
    return anomaly_rows(df).agg(
        F.count("*").alias("count"),
        F.coalesce(round_to(exact_avg(F.col("anomaly_score")), 3), zero).alias("average_score"),
        F.coalesce(round_to(F.max("anomaly_score"), 3), zero).alias("highest_score"),
        F.countDistinct("area").alias("impacted_areas"),
    )


def theft_queue(df: DataFrame, limit: int = 20, tie: str = "reading_id") -> DataFrame:
    return df.where(F.col("status") == THEFT).orderBy(F.desc("risk_score"), F.desc("theft_probability"), tie).limit(limit)


def theft_summary(df: DataFrame) -> DataFrame:
    zero = F.lit(0e0)
    return df.where(F.col("status") == THEFT).agg(
        F.count("*").alias("count"),
        F.coalesce(round_to(exact_avg(F.col("risk_score"), 2), 2), zero).alias("average_risk_score"),
        F.coalesce(round_to(exact_avg(F.col("theft_probability")), 4), zero).alias("average_theft_probability"),
        F.countDistinct(F.when(F.col("risk_score") >= 80e0, F.col("area"))).alias("critical_areas"),
    )


def weather_scatter(history: DataFrame, recent: DataFrame, history_rows: int | None = None, points: int = 240, tie: str = "reading_id") -> DataFrame:
    """The history (its newest rows only, if asked for) followed by the recent rows; of these the last `points`."""
    columns = ["timestamp", tie, "temperature", "consumption_kwh", "wastage_score", "area"]
    old = (history if history_rows is None else last_rows(history, history_rows, tie=tie)).select(*columns, F.lit(0).alias("_part"))
    new = recent.select(*columns, F.lit(1).alias("_part"))
    both = old.unionByName(new)
    return both.orderBy(F.desc("_part"), F.desc("timestamp"), F.desc(tie)).limit(points).drop("_part")


def live_kpis(df: DataFrame, ticks: int = 24, time_col: str = "timestamp") -> DataFrame:
    """Latest load, peak over the shown ticks, mean voltage and biggest area of the latest tick."""
    line = live_timeline(df, ticks, time_col)
    now = at_latest(df, time_col)
    loads = line.agg(
        F.max_by("total_consumption", "timestamp").alias("latest_load"),
        F.max("total_consumption").alias("peak_load"),
    )
    voltage = now.agg(exact_avg(F.col("voltage")).alias("v")).scalar()
    area = consumption_by_area(now).limit(1).select("area").scalar()
    return loads.withColumns({"mean_voltage": voltage, "top_area": area})


def top_power(df: DataFrame, limit: int = 12, tie: str = "reading_id") -> DataFrame:
    return df.orderBy(F.desc("power"), tie).limit(limit)


def hotspots(df: DataFrame, limit: int = 10) -> DataFrame:
    """Meters, theft and anomaly rows per area in one aggregation, worst areas first."""
    area = F.coalesce("area", F.lit("Unknown"))
    return (
        df.groupBy(area.alias("area"))
        .agg(
            F.count("*").alias("meters"),
            count_if(F.col("status") == THEFT).alias("theft"),
            count_if((F.col("is_anomaly") == 1) | (F.col("status") == ANOMALY)).alias("anomalies"),
        )
        .orderBy(F.desc(F.col("theft") + F.col("anomalies")), "area")
        .limit(limit)
    )


def heat_points(df: DataFrame, markers: int = 150, time_col: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """Weighted points of the latest tick's theft rows; the heaviest ones are markers."""
    points = theft_rows(at_latest(df, time_col)).select(
        tie,
        "meter_id",
        "area",
        F.coalesce("latitude", F.lit(0e0)).alias("latitude"),
        F.coalesce("longitude", F.lit(0e0)).alias("longitude"),
        F.coalesce("theft_probability", F.lit(0e0)).alias("weight"),
    )
    top = points.orderBy(F.desc("weight"), tie).limit(markers).select(tie, F.lit(1).alias("is_marker"))
    return points.join(top, tie, "left").withColumn("is_marker", F.coalesce("is_marker", F.lit(0)))


def report_tables(df: DataFrame, weather_rows: int | None = None, tie: str = "reading_id") -> DataFrame:
    """The four tables of the daily report in long form: section, position, label, value."""
    latest = latest_per_meter(df, tie=tie)
    counts = overview(latest)
    order = ["active_meters", "anomalies", "theft", "wastage", "total_meters"]
    summary = counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("label"), F.col(c).cast("double").alias("value")) for i, c in enumerate(order)])
        ).alias("r")
    ).select(F.lit("overview").alias("section"), "r.*")

    def listed(rows: DataFrame, section: str, label: str, value: str, keys: list[Column]) -> DataFrame:
        position = Window.orderBy(*keys)  # a handful of rows
        return rows.select(
            F.lit(section).alias("section"),
            F.row_number().over(position).alias("position"),
            F.col(label).alias("label"),
            F.col(value).alias("value"),
        )

    areas = listed(consumption_by_area(latest).limit(8), "areas", "area", "consumption_kwh", [F.desc("consumption_kwh"), F.col("area")])
    weather = listed(weather_impact(df if weather_rows is None else last_rows(df, weather_rows, tie=tie)), "weather", "temperature_band", "avg_consumption", [F.col("temperature_band")])
    theft = listed(
        latest.where(F.col("status") == THEFT).orderBy("meter_id").limit(10), "theft", "meter_id", "theft_probability", [F.col("meter_id")]
    )
    return summary.unionByName(areas).unionByName(weather).unionByName(theft)


def histogram(df: DataFrame, value: str) -> DataFrame:
    """Equal-width histogram with min(8, max(4, ceil(sqrt(n)))) buckets, empty ones included."""
    x = F.coalesce(F.col(value), F.lit(0e0))
    stats = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count("*").alias("n")).withColumn(
        "buckets", F.least(F.lit(8), F.greatest(F.lit(4), F.ceil(F.sqrt(F.col("n").cast("double"))))).cast("int")
    )
    flat = F.col("hi") == F.col("lo")
    stats = stats.withColumn("span", F.when(flat, F.lit(1e0)).otherwise((F.col("hi") - F.col("lo")) / F.col("buckets").cast("double")))
    one = stats.select(F.struct("lo", "hi", "buckets", "span").alias("s")).scalar()
    placed = df.withColumn("_s", one).withColumn(
        "bucket",
        F.when(F.col("_s.hi") == F.col("_s.lo"), F.lit(0)).otherwise(
            F.least(F.col("_s.buckets") - 1, F.floor((x - F.col("_s.lo")) / F.col("_s.span")).cast("int"))
        ),
    )
    counts = placed.groupBy("bucket").agg(F.count("*").alias("count"))
    frame = stats.where(F.col("n") > 0).select("lo", "span", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    return frame.join(counts, "bucket", "left").select(
        "bucket",
        (F.col("lo") + F.col("bucket").cast("double") * F.col("span")).alias("low"),
        (F.col("lo") + (F.col("bucket") + 1).cast("double") * F.col("span")).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def weather_demand(weather: DataFrame, demand: DataFrame) -> DataFrame:
    """Area weather with the area's demand next to it (0 where there is none)."""
    return weather.join(demand.select("area", F.col("consumption_kwh").alias("demand")), "area", "left").withColumn(
        "demand", F.coalesce("demand", F.lit(0e0))
    )


def weather_demand_summary(joined: DataFrame) -> DataFrame:
    return joined.agg(
        exact_avg(F.col("temperature")).alias("mean_temperature"),
        exact_avg(F.col("humidity")).alias("mean_humidity"),
        count_if(F.col("rainfall") > 0).alias("rainy_areas"),
        F.max_by("area", F.struct("demand", "area")).alias("sensitive_area"),
    )


def data_summary(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows, meters, sorted areas and theft / wastage rates. Areas are made distinct before they are
    gathered, so the list is as long as the area dimension and no longer."""
    areas = catalog.select("area").where(F.col("area").isNotNull()).distinct().agg(F.sort_array(F.collect_list("area")).alias("a"))
    out = df.agg(
        F.count("*").alias("records"),
        round_to(F.avg(F.col("is_theft").cast("double")), 4).alias("theft_rate"),
        round_to(F.avg((F.col("wastage_score") > 0.25).cast("double")), 4).alias("wastage_rate"),
    )
    return out.withColumns(
        {"meters": catalog.agg(F.countDistinct("meter_id")).scalar(), "areas": areas.select(F.array_join("a", ", ")).scalar()}
    )
