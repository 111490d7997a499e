"""Per-meter rolling features, electrical ratios and the model design matrix.

All windows share one order per meter. A meter with very many rows is cut into slots, each slot is
a window partition of its own, and the last rows before a slot travel to it as a short array, so
the result is the same as with one partition per meter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from meterlake.functions.numeric import column_or, ratio
from meterlake.plans.session import cut_lineage
from meterlake.schema import MODEL_CATEGORICAL, MODEL_NUMERIC

WINDOW_ROWS = 24
HOT_ROWS = 5_000_000
# Energy is summed in units of 0.1 Wh: whole numbers, so sums do not depend on row order.
UNITS = 1e4


def _is_night(hour: Column) -> Column:
    return (hour >= 22) | (hour <= 5)


def calendar_features(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """`hour_of_day` and `day_of_week` (Monday is 0)."""
    return df.withColumns(
        {"hour_of_day": F.hour(time_col).cast("int"), "day_of_week": F.weekday(time_col).cast("int")}
    )


def electrical_features(df: DataFrame) -> DataFrame:
    """Row-wise ratios of weather, power factor, voltage and power."""
    weather_load = (
        F.abs("temperature") + F.col("humidity") / 1e2 + F.col("rainfall") * 0.8 + F.col("wind_speed") * 0.6 + 1e0
    )
    return df.withColumns(
        {
            "weather_consumption_ratio": ratio(F.col("consumption_kwh"), weather_load),
            "power_factor_loss": F.coalesce(1e0 - F.least(F.greatest("power_factor", F.lit(0e0)), F.lit(1e0)), F.lit(0e0)),
            "voltage_irregularity": F.coalesce(F.abs(F.col("voltage") - 230e0) / 230e0, F.lit(0e0)),
            "current_power_gap": F.coalesce(F.abs(F.col("power") - F.col("consumption_kwh")), F.lit(0e0)),
        }
    )


SLOT_LEVELS = ("_s1", "_s2", "_s3")


def _position(df: DataFrame, tie: str) -> Column:
    """A number that never falls along the order of `tie`: numbers as they are, text by its first six bytes."""
    kind = df.schema[tie].dataType
    if isinstance(kind, NumericType):
        return F.col(tie).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return F.unix_micros(F.col(tie).cast("timestamp")).cast("double")
    head = F.hex(F.substring(F.encode(F.col(tie).cast("string"), "UTF-8"), 1, 6))
    return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")


def place_in_slots(df: DataFrame, time_col: str, tie: str, hot_rows: int) -> tuple[DataFrame, list[str]]:
    """Cut the series of meters with more than `hot_rows` rows into slots; the levels that were needed.

    Level one cuts a meter's time span into equal parts; a part that is still too big (a burst) is cut again by its own
    span, and one that is a single instant (copies) by the positions of its keys. Slots are numbered in the order of
    (time, key), everything else is slot 0, and levels end as soon as no part is too big.
    """
    stamp = F.unix_micros(F.col(time_col).cast("timestamp"))
    out = df.withColumns({"_at": stamp.cast("double"), "_key": _position(df, tie), "_hot": F.lit(False), "_peak": F.lit(None).cast("double")})
    keys: list[str] = ["meter_id"]
    used: list[str] = []
    for level in SLOT_LEVELS:
        counts = (out.where("_hot") if used else out).groupBy(*keys).agg(
            F.count("*").alias("_n"), F.max("consumption_kwh").alias("_top"),
            F.min("_at").alias("_t0"), F.max("_at").alias("_t1"), F.min("_key").alias("_k0"), F.max("_key").alias("_k1"),
        )
        instant = F.coalesce(F.col("_t0") == F.col("_t1"), F.lit(True))
        # At most one row for each `hot_rows` rows of the input.
        big = cut_lineage(
            counts.where(F.col("_n") > hot_rows).select(
                *keys, "_top", instant.alias("_by_key"), F.when(instant, F.col("_k0")).otherwise(F.col("_t0")).alias("_from"),
                F.greatest(F.when(instant, F.col("_k1") - F.col("_k0")).otherwise(F.col("_t1") - F.col("_t0")), F.lit(1e0)).alias("_span"),
                F.ceil(F.col("_n") * 4 / F.lit(hot_rows)).cast("double").alias("_parts"),
            )
        )
        if big.isEmpty():
            break
        at = F.when(F.col("_by_key"), F.col("_key")).otherwise(F.col("_at"))
        part = F.least(F.floor((at - F.col("_from")) / F.col("_span") * F.col("_parts")), F.col("_parts") - 1).cast("int")
        out = (
            out.join(big, keys, "left")
            .withColumns(
                {
                    level: F.coalesce(part, F.lit(0)),
                    "_hot": F.col("_hot") | F.col("_parts").isNotNull(),
                    "_peak": F.coalesce("_peak", "_top"),
                }
            )
            .drop("_top", "_by_key", "_from", "_span", "_parts")
        )
        keys.append(level)
        used.append(level)
    return out.drop("_at", "_key"), used


def rolling_features(
    df: DataFrame,
    time_col: str = "timestamp",
    tie: str = "reading_id",
    rows: int = WINDOW_ROWS,
    hot_rows: int | None = HOT_ROWS,
    scope: str = "history",
) -> DataFrame:
    """Rolling mean, sample variance and night share over the last `rows` readings of a meter, and
    the share of the meter's peak. `scope="tick"` restarts the windows at every timestamp.

    Meters are counted first; those of more than `hot_rows` rows are cut into slots. `hot_rows=None` leaves the
    count out, for inputs known to hold no such meter.
    """
    units = F.rint(F.col("consumption_kwh") * UNITS)
    night = F.when(_is_night(F.hour(time_col)), units).otherwise(F.lit(0e0))
    base = df.withColumns({"_x": units, "_night": night})
    levels: list[str] = []
    placed = base
    if scope == "history" and hot_rows is not None:
        placed, levels = place_in_slots(base, time_col, tie, hot_rows)
    if levels:
        keys = ["meter_id", *levels]
        # Asked for by name: an input already partitioned by meter would count as good enough.
        placed = placed.repartition(*keys)
    else:
        keys = ["meter_id"] if scope == "history" else ["meter_id", time_col]
        placed = placed.drop("_hot").withColumn("_peak", F.lit(None).cast("double"))

    ordered = Window.partitionBy(*keys).orderBy(time_col, tie)
    recent = ordered.rowsBetween(-(rows - 1), 0)
    out = placed.withColumns(
        {
            "_n": F.count("*").over(recent).cast("double"),
            "_sx": F.sum("_x").over(recent),
            "_sxx": F.sum(F.col("_x") * F.col("_x")).over(recent),
            "_sn": F.sum("_night").over(recent),
            "_top": F.coalesce("_peak", F.max("consumption_kwh").over(Window.partitionBy(*keys))),
        }
    )
    if levels:
        out = _with_rows_before_slot(out, placed, levels, ordered, time_col, tie, rows)

    n, sx, sxx, sn = (F.col(c) for c in ("_n", "_sx", "_sxx", "_sn"))
    variance = F.greatest(sxx - sx * sx / n, F.lit(0e0)) / F.nullif(n - 1e0, F.lit(0e0)) / (UNITS * UNITS)
    out = out.withColumns(
        {
            "rolling_average_consumption": sx / UNITS / n,
            "consumption_variance": F.coalesce(variance, F.lit(0e0)),
            "peak_usage_ratio": ratio(F.col("consumption_kwh"), F.nullif(F.col("_top"), F.lit(0e0))),
            "night_usage_ratio": ratio(sn, F.nullif(sx, F.lit(0e0))),
        }
    )
    return out.drop("_x", "_night", "_hot", "_peak", *SLOT_LEVELS, "_n", "_sx", "_sxx", "_sn", "_top")


def _with_rows_before_slot(out: DataFrame, placed: DataFrame, levels: list[str], ordered, time_col: str, tie: str, rows: int) -> DataFrame:
    """Add to the first rows of a slot what the window still misses from the slots before it."""
    need = rows - 1
    slot = ["meter_id", *levels]
    backwards = Window.partitionBy(*slot).orderBy(F.desc(time_col), F.desc(tie))
    tails = (
        placed.where("_hot")
        .select(*slot, time_col, tie, "_x", "_night")
        .withColumn("_back", F.row_number().over(backwards))
        .where(F.col("_back") <= need)
    )
    # From here on a meter has `need` rows per slot at most, however many readings.
    history = Window.partitionBy("meter_id").orderBy(time_col, tie).rowsBetween(-(need - 1), 0)
    following = Window.partitionBy("meter_id").orderBy(*levels)
    halo = (
        tails.withColumn("_prior", F.collect_list(F.struct(F.col("_x").alias("x"), F.col("_night").alias("n"))).over(history))
        .where(F.col("_back") == 1)
        .withColumn("_next", F.lead(F.struct(*levels)).over(following))
        .where(F.col("_next").isNotNull())
        .select("meter_id", *[F.col(f"_next.{c}").alias(c) for c in levels], "_prior")
    )
    joined = out.withColumn("_pos", F.row_number().over(ordered)).join(halo, slot, "left")
    missing = F.least(F.lit(rows) - F.col("_pos"), F.size("_prior"))
    used = F.slice("_prior", F.size("_prior") - missing + 1, missing)
    short = F.col("_prior").isNotNull() & (F.col("_pos") < rows)

    def extra(value) -> Column:
        total = F.aggregate(used, F.lit(0e0), lambda acc, e: acc + value(e))
        return F.when(short, total).otherwise(F.lit(0e0))

    return joined.withColumns(
        {
            "_sx": F.col("_sx") + extra(lambda e: e["x"]),
            "_sxx": F.col("_sxx") + extra(lambda e: e["x"] * e["x"]),
            "_sn": F.col("_sn") + extra(lambda e: e["n"]),
            "_n": F.col("_n") + F.when(short, missing.cast("double")).otherwise(F.lit(0e0)),
        }
    ).drop("_prior", "_pos")


def add_engineered_features(
    df: DataFrame,
    time_col: str = "timestamp",
    tie: str = "reading_id",
    hot_rows: int | None = HOT_ROWS,
    scope: str = "history",
) -> DataFrame:
    """All derived features of a cleaned readings frame."""
    out = rolling_features(df, time_col, tie, hot_rows=hot_rows, scope=scope)
    return electrical_features(calendar_features(out, time_col))


def design_columns(df: DataFrame, categorical: list[str] = MODEL_CATEGORICAL) -> list[str]:
    """Names of the design matrix: the numeric inputs, then one `column_value` per category seen.

    The list is as long as the matrix is wide, so it is a bounded thing to bring to the driver.
    """
    names = [c for c in MODEL_NUMERIC if c in df.columns]
    for column in categorical:
        seen = df.select(F.col(column).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
        names += [f"{column}_{r.v}" for r in seen.orderBy("v").collect()]
    return names


def one_hot(df: DataFrame, column: str, value: str) -> Column:
    return F.coalesce((F.col(column) == value).cast("double"), F.lit(0e0)) if column in df.columns else F.lit(0e0)


def encode_features(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Project to exactly `columns`: numerics as they are, `category_value` as 0/1, the rest 0."""
    out = []
    for name in columns:
        category = next((c for c in MODEL_CATEGORICAL if name.startswith(f"{c}_") and name not in df.columns), None)
        value = one_hot(df, category, name[len(category) + 1 :]) if category else column_or(df, name)
        out.append(value.alias(name))
    return df.select(*keep, *out)


def assemble(df: DataFrame, columns: list[str], keep: list[str] = (), vector: str = "features") -> DataFrame:
    """Feature vector for the learners, next to the columns in `keep`."""
    from pyspark.ml.feature import VectorAssembler

    kept = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    encoded = encode_features(df, columns, kept)
    vectors = VectorAssembler(inputCols=[f"`{c}`" if "." in c else c for c in columns], outputCol=vector, handleInvalid="error").transform(encoded)
    return vectors.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)], vector)
