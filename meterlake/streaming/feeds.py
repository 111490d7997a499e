"""Streams of readings: hourly demand, duplicate removal, rolling features, scored ticks.

A source is any streaming frame with the readings' columns. Batches write below a folder that all
executors share; every write is named by its batch number and replaces itself when a batch is
repeated, so a restarted query does not count anything twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.functions.numeric import count_if, ratio
from meterlake.operators.features import HOT_ROWS, WINDOW_ROWS, rolling_features
from meterlake.plans.session import cut_lineage
from meterlake.schema import THEFT
from meterlake.streaming.buckets import BUCKETS, BucketTable, read_if_any, remove

LATE = "2 hours"


def read_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None, only: str | None = None
) -> DataFrame:
    """Files of a folder as a stream; `only` is a pattern their names must match."""
    reader = spark.readStream.schema(schema).format(fmt)
    if only is not None:
        reader = reader.option("pathGlobFilter", only)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _start(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def hourly_parts(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Whole units of consumption, anomalies and theft per hour; parts of an hour add up."""
    hour = F.date_trunc("hour", time_col)
    return df.groupBy(hour.alias("timestamp"), F.to_date(hour).alias("day")).agg(
        F.sum(F.rint(F.col("consumption_kwh") * F.lit(1e6)).cast("decimal(20,0)")).cast("decimal(30,0)").alias("units"),
        count_if(F.col("is_anomaly") == 1).alias("anomalies"),
        count_if(F.col("status") == THEFT).alias("theft"),
        F.count("*").alias("rows"),
        F.max(time_col).alias("newest"),
    )


def run_hourly_demand(df: DataFrame, folder: str, time_col: str = "timestamp", late: str = LATE) -> DataFrame:
    """Consumption, anomalies and theft per hour of a feed, driven to its end; a run without news returns the last result.

    Every batch adds the parts of its hours to the table's rows of the same hours: only the days it has news for are read and written,
    and no other state is kept. An hour that is over by more than `late` before the newest time of earlier batches is closed; what still
    comes for it goes to the table `late_hours`, as a stream's watermark would drop it.
    """
    spark = df.sparkSession
    table = BucketTable(spark, f"{folder}/demand", ["day"])

    def store(batch: DataFrame, number: int) -> None:
        parts = cut_lineage(hourly_parts(batch, time_col))  # an hour a row
        newest = parts.agg(F.max("newest")).head()[0]
        if newest is None:
            return
        clock = _last(spark, f"{folder}/demand_clock", number)
        passed = None if clock is None else clock.head()[0]
        if passed is not None:
            closed = F.col("timestamp") + F.expr("INTERVAL 1 HOUR") + F.expr(f"INTERVAL {late}") <= F.lit(passed)
            parts.where(closed).drop("newest").write.mode("overwrite").parquet(f"{folder}/late_hours/batch={number}")
            parts = parts.where(~closed)
            newest = max(newest, passed)
        old = table.read(table.touched(parts), number)
        names = {"units": "decimal(30,0)", "anomalies": "bigint", "theft": "bigint", "rows": "bigint"}
        parts = parts.drop("newest")
        every = parts if old is None else parts.unionByName(old)
        table.write(every.groupBy("timestamp", "day").agg(*[F.sum(c).cast(t).alias(c) for c, t in names.items()]), number)
        parts.sparkSession.range(1).select(F.lit(newest).alias("newest")).write.mode("overwrite").parquet(f"{folder}/demand_clock/batch={number}")

    _start(df, store, f"{folder}/demand-progress").awaitTermination()
    return hourly_table(spark, folder) or _demand_of(hourly_parts(spark.createDataFrame([], df.schema), time_col))


def _demand_of(hours: DataFrame) -> DataFrame:
    return hours.select("timestamp", (F.col("units").cast("double") / F.lit(1e6)).alias("total_consumption"), "anomalies", "theft")


def hourly_table(spark: SparkSession, folder: str) -> DataFrame | None:
    """The hours as the last batch left them."""
    hours = BucketTable(spark, f"{folder}/demand", ["day"]).read()
    return None if hours is None else _demand_of(hours)


def late_hours(spark: SparkSession, folder: str) -> DataFrame | None:
    """What came too late for its hour: an hour a row and batch."""
    return read_if_any(spark, f"{folder}/late_hours")


def without_repeats(df: DataFrame, time_col: str = "timestamp", late: str = LATE) -> DataFrame:
    """First row of every meter and timestamp, remembered as long as late rows may come."""
    return df.withWatermark(time_col, late).dropDuplicatesWithinWatermark(["meter_id", time_col])


def run_to_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Append a stream to a Parquet table with the exactly-once file sink and read the table."""
    path = f"{folder}/{name}"
    (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{folder}/{name}-progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return df.sparkSession.read.parquet(path)


def _last(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The table of the newest batch (below `before`), if there is one; folders that no repeated batch can ask for go."""
    table = read_if_any(spark, path)
    if table is None:
        return None
    batches = sorted({int(n) for n in re.findall(r"/batch=(\d+)/", "".join(table.inputFiles()))})
    known = [n for n in batches if before is None or n < before]
    for old in known[:-1] if before is not None else []:
        remove(spark, f"{path}/batch={old}")
    return spark.read.parquet(f"{path}/batch={known[-1]}") if known else None


def run_rolling_features(
    df: DataFrame, folder: str, time_col: str = "timestamp", tie: str = "reading_id", hot_rows: int | None = HOT_ROWS,
    late: str = LATE, finish: bool = True, buckets: int = BUCKETS,
) -> DataFrame:
    """Rolling features over a feed, in the order of event time whatever the order of files and rows.

    A row waits until the newest time seen is `late` past it, so rows that come out of order by less than that are put right;
    later ones are kept apart in `late`. `finish` releases what waits at the end; a feed that goes on is run without it. Between
    batches only the waiting rows and the last readings of each meter are kept, these in buckets of meters, of which a batch reads and
    writes those it has news for. The peak is the running one, since a stream does not know the future.
    """
    spark = df.sparkSession
    table = BucketTable(spark, f"{folder}/memory", ["meter_id"], buckets)
    columns = ["meter_id", time_col, tie, "consumption_kwh"]

    def release(ready: DataFrame, number: int) -> None:
        new = ready.select(*columns, F.lit(True).alias("_new"), F.lit(None).cast("double").alias("_running"))
        memory = table.read(table.touched(new), number)
        known = new if memory is None else new.unionByName(memory.withColumn("_new", F.lit(False)))
        upto = Window.partitionBy("meter_id").orderBy(time_col, tie).rowsBetween(Window.unboundedPreceding, 0)
        known = cut_lineage(known.withColumn("_running", F.max(F.greatest("_running", "consumption_kwh")).over(upto)))
        out = rolling_features(known, time_col, tie, hot_rows=hot_rows).where("_new")
        running = ratio(F.col("consumption_kwh"), F.nullif(F.col("_running"), F.lit(0e0)))
        out = out.select(
            "meter_id", time_col, tie, "rolling_average_consumption", "consumption_variance", running.alias("peak_usage_ratio"), "night_usage_ratio"
        )
        out.write.mode("overwrite").parquet(f"{folder}/rolled/batch={number}")
        back = Window.partitionBy("meter_id").orderBy(F.desc(time_col), F.desc(tie))
        kept = known.withColumn("_nth", F.row_number().over(back)).where(F.col("_nth") < WINDOW_ROWS)
        table.write(kept.select(*columns, "_running"), number)

    def advance(batch: DataFrame, number: int) -> None:
        waiting = _last(spark, f"{folder}/waiting", number)
        clock = _last(spark, f"{folder}/clock", number)
        passed = None if clock is None else clock.head()[0]
        rows = cut_lineage(batch.select(*columns))
        if passed is not None:
            rows.where(F.col(time_col) <= F.lit(passed)).write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
            rows = rows.where(F.col(time_col) > F.lit(passed))
        every = rows if waiting is None else rows.unionByName(waiting)
        now = cut_lineage(every.agg((F.max(time_col) - F.expr(f"INTERVAL {late}")).alias("at")))
        at = now.head()[0]
        at = passed if at is None or (passed is not None and at < passed) else at
        if at is not None:
            release(every.where(F.col(time_col) <= F.lit(at)), number)
            every = every.where(F.col(time_col) > F.lit(at))
            now.select(F.lit(at).alias("at")).write.mode("overwrite").parquet(f"{folder}/clock/batch={number}")
        every.write.mode("overwrite").parquet(f"{folder}/waiting/batch={number}")

    query = _start(df.select(*columns), advance, f"{folder}/rolled-progress")
    query.awaitTermination()
    waiting = _last(spark, f"{folder}/waiting") if finish else None
    if waiting is not None:
        number = 1 + spark.read.parquet(f"{folder}/waiting").agg(F.max("batch")).head()[0]
        release(waiting, number)
        waiting.limit(0).write.mode("overwrite").parquet(f"{folder}/waiting/batch={number}")
    return spark.read.parquet(f"{folder}/rolled").drop("batch")


def recent_buffer(df: DataFrame, ticks: int = 36, time_col: str = "timestamp") -> DataFrame:
    """All rows of the last `ticks` timestamps."""
    oldest = df.select(time_col).distinct().orderBy(F.desc(time_col)).limit(ticks).agg(F.min(time_col)).scalar()
    return df.where(F.col(time_col) >= oldest)


def run_ticks(
    df: DataFrame,
    folder: str,
    score: Callable[[DataFrame], DataFrame],
    snapshots: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    side_outputs: dict[str, tuple[int, Callable[[DataFrame], DataFrame]]] | None = None,
    time_col: str = "timestamp",
    finish: bool = True,
    state: Callable[[DataFrame, DataFrame, int], dict[str, DataFrame]] | None = None,
) -> DataFrame:
    """Score a feed tick by tick and keep the tables a live view reads.

    The newest timestamp of a batch waits for the next one, so a tick that comes in several batches is scored once and whole;
    rows of a tick already scored are kept apart in `late`. `finish` releases the last tick. `score` turns readings into scored
    ones (windows and normalisation per timestamp). Scored batches form the history. `snapshots` are tables rebuilt from the
    recent buffer after every batch; the buffer is carried from batch to batch, so the history is not read again.
    `side_outputs` are tables from the batch, written every n-th batch only. `state` adds the batch (its scored rows and the recent ones)
    to sums of its own and returns tables that follow from them.
    """
    spark = df.sparkSession

    def release(ready: DataFrame, number: int) -> None:
        path = f"{folder}/scored/batch={number}"
        score(ready).write.mode("overwrite").parquet(path)
        scored = spark.read.parquet(path)
        buffer = _last(spark, f"{folder}/recent_buffer", number)
        both = scored if buffer is None else scored.unionByName(buffer)
        recent_buffer(both, time_col=time_col).write.mode("overwrite").parquet(f"{folder}/recent_buffer/batch={number}")
        recent = spark.read.parquet(f"{folder}/recent_buffer/batch={number}")
        for name, build in (snapshots or {}).items():
            build(recent).write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        for name, table in (state(scored, recent, number) if state else {}).items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        for name, (every, build) in (side_outputs or {}).items():
            if number % every == 0:
                build(scored).write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")

    def tick(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        waiting = _last(spark, f"{folder}/waiting", number)
        buffer = _last(spark, f"{folder}/recent_buffer", number)
        passed = None if buffer is None else buffer.agg(F.max(time_col)).head()[0]
        rows = cut_lineage(batch)
        if passed is not None:
            rows.where(F.col(time_col) <= F.lit(passed)).write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
            rows = rows.where(F.col(time_col) > F.lit(passed))
        every = rows if waiting is None else rows.unionByName(waiting)
        newest = every.agg(F.max(time_col)).head()[0]
        ready = every.where(F.col(time_col) < F.lit(newest))
        if not ready.isEmpty():
            release(ready, number)
        every.where(F.col(time_col) == F.lit(newest)).write.mode("overwrite").parquet(f"{folder}/waiting/batch={number}")

    _start(df, tick, f"{folder}/ticks-progress").awaitTermination()
    waiting = _last(spark, f"{folder}/waiting") if finish else None
    if waiting is not None and not waiting.isEmpty():
        number = 1 + spark.read.parquet(f"{folder}/waiting").agg(F.max("batch")).head()[0]
        release(waiting, number)
        waiting.limit(0).write.mode("overwrite").parquet(f"{folder}/waiting/batch={number}")
    if _last(spark, f"{folder}/recent_buffer") is not None:
        return spark.read.parquet(f"{folder}/scored")
    # Nothing is complete yet.
    return score(spark.createDataFrame([], df.schema)).withColumn("batch", F.lit(0))


def newest_snapshot(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The snapshot of the last batch that wrote one."""
    newest = _last(spark, f"{folder}/{name}")
    if newest is None:
        raise FileNotFoundError(f"{folder}/{name}: no batch has written it")
    return newest

