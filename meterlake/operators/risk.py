"""Composite risk score, level, dominant factor and area distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.numeric import clip, column_or, count_if, exact_avg, round_to, with_default
from meterlake.plans.session import cut_lineage

# Component weights and the text of each dominant factor, in tie order.
WEIGHTS = {"anomaly": 0.35, "theft": 0.35, "voltage": 0.15, "night": 0.15}
SUMMARIES = {
    "anomaly": "Anomaly-driven risk",
    "theft": "Theft probability dominated",
    "voltage": "Voltage irregularity dominated",
    "night": "High night usage dominated",
}
INPUTS = {
    "anomaly": "anomaly_score",
    "rf": "random_forest_probability",
    "boost": "xgboost_probability",
    "theft_raw": "theft_probability",
    "voltage": "voltage_irregularity",
    "night": "night_usage_ratio",
}


def _scale(low: Column, high: Column) -> tuple[Column, Column]:
    """What to subtract and divide by: nothing up to a maximum of 1, everything (an infinite divisor)
    where minimum and maximum agree, and the range otherwise."""
    same = F.abs(high - low) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(low)
    within = high <= 1e0
    shift = F.when(within, F.lit(0e0)).otherwise(low)
    span = F.when(within, F.lit(1e0)).when(same, F.lit(float("inf"))).otherwise(high - low)
    return shift, span


def normalised(value: Column, scale: Column, name: str) -> Column:
    """Rescaled to [0, 1]; the value occurs once, so nested uses do not multiply in the plan."""
    return clip((value - scale[f"{name}_shift"]) / scale[f"{name}_span"], 0.0, 1.0)


def _scales(limits: dict[str, tuple[Column, Column]]) -> list[Column]:
    parts = []
    for name, (low, high) in limits.items():
        shift, span = _scale(low, high)
        parts += [shift.alias(f"{name}_shift"), span.alias(f"{name}_span")]
    return parts


THEFT_PARTS, THEFT_WEIGHTS = ("_rf", "_boost", "_theft_raw"), (0.45, 0.55, 0.20)


def _blend(parts: list[Column]) -> Column:
    rf, boost, raw = (F.lit(w) * p for w, p in zip(THEFT_WEIGHTS, parts, strict=True))
    return rf + boost + raw


def _normalisers(work: DataFrame, by: str | None) -> DataFrame:
    """The scaling of every component, one row per group of `by` (or one), as a struct `_s`.

    One aggregate finds all limits, those of the theft blend too wherever its parts need no scaling (no maximum above 1, as probabilities
    have it). Only groups with scaled parts are looked at again, by four narrow columns.
    """
    keys = [] if by is None else [by]
    names = ("_anomaly", *THEFT_PARTS, "_voltage", "_night")
    plain = _blend([clip(F.col(c), 0.0, 1.0) for c in THEFT_PARTS])
    limits = [f(F.col(c)).alias(f"{n}{c}") for c in names for n, f in (("lo", F.min), ("hi", F.max))]
    limits += [F.min(plain).alias("lo_theft"), F.max(plain).alias("hi_theft")]
    first = work.groupBy(*keys).agg(*limits)
    scaled = F.greatest(*[F.col(f"hi{c}") for c in THEFT_PARTS]) > 1e0
    struct = F.struct(*_scales({c: (F.col(f"lo{c}"), F.col(f"hi{c}")) for c in names})).alias("_s")
    again = first.where(scaled).select(*keys, struct)
    if by is None:
        first = cut_lineage(first)  # one row; tells whether the rows must be read again
        if first.where(scaled).isEmpty():
            again = None
        else:
            again = work.select(*THEFT_PARTS).withColumn("_s", first.select(struct).scalar())
    else:
        again = work.select(by, *THEFT_PARTS).join(again, by)
    ends = {"lo": F.col("lo_theft"), "hi": F.col("hi_theft")}
    if again is not None:
        blend = _blend([normalised(F.col(c), F.col("_s"), c) for c in THEFT_PARTS])
        second = again.groupBy(*keys).agg(F.min(blend).alias("_lo2"), F.max(blend).alias("_hi2"))
        first = first.join(second, by, "left") if by is not None else first.withColumns({c: second.select(c).scalar() for c in ("_lo2", "_hi2")})
        ends = {n: F.coalesce(f"_{n}2", c) for n, c in ends.items()}
    every = {c: (F.col(f"lo{c}"), F.col(f"hi{c}")) for c in names} | {"_theft": (ends["lo"], ends["hi"])}
    return first.select(*keys, F.struct(*_scales(every)).alias("_s"))


def risk_level(score: Column) -> Column:
    return (
        F.when(score < 35e0, F.lit("Low"))
        .when(score < 60e0, F.lit("Medium"))
        .when(score < 80e0, F.lit("High"))
        .otherwise(F.lit("Critical"))
    )


def score_risk(df: DataFrame, by: str | None = None, unit: tuple[str, ...] = ()) -> DataFrame:
    """Add `risk_score`, `risk_level` and `risk_summary`.

    `by=None` normalises over the whole frame, `by="timestamp"` over each tick on its own: one equi-join of the frame with one row per tick,
    which adaptive execution broadcasts only where it turns out small, and splits where a tick is hot. Columns named in `unit` are known
    to lie in [0, 1], where normalising changes nothing; their range is not looked for, which spares what computes them.
    """
    work = df.withColumns({f"_{k}": clip(column_or(df, c), low=0.0) for k, c in INPUTS.items()})
    known = [f"_{k}" for k, c in INPUTS.items() if c in unit]
    looked = work.withColumns({c: F.lit(0e0) for c in known})
    scales = _normalisers(looked, by)
    work = work.withColumn("_s", scales.select("_s").scalar()) if by is None else work.join(scales, by)

    def norm(name: str) -> Column:
        return clip(F.col(name), 0.0, 1.0) if name in known else normalised(F.col(name), F.col("_s"), name)

    work = work.withColumn("_theft", _blend([norm(c) for c in THEFT_PARTS]))
    work = work.withColumns({c: norm(c) for c in ("_theft", "_anomaly", "_voltage", "_night")})
    weighted = sum((F.lit(w) * F.col(f"_{k}") for k, w in list(WEIGHTS.items())[1:]), F.lit(0.35) * F.col("_anomaly"))
    top = F.greatest(*[F.col(f"_{k}") for k in WEIGHTS])
    summary = F.coalesce(*[F.when(F.col(f"_{k}") == top, F.lit(text)) for k, text in SUMMARIES.items()])
    out = work.withColumns({"risk_score": round_to(weighted * 1e2, 2), "risk_summary": summary})
    return out.withColumn("risk_level", risk_level(F.col("risk_score"))).drop("_s", *THEFT_PARTS, *[f"_{k}" for k in WEIGHTS])


def risk_by_area(df: DataFrame) -> DataFrame:
    """Mean score, critical and high rows and distinct meters per area, riskiest first."""
    df = with_default(df, "area", "Unknown")
    if "risk_level" not in df.columns:
        df = df.withColumn("risk_level", risk_level(column_or(df, "risk_score")))
    return (
        df.where(F.col("area").isNotNull())
        .groupBy("area")
        .agg(
            exact_avg(F.col("risk_score"), 2).alias("avg_risk_score"),
            count_if(F.col("risk_level") == "Critical").alias("critical_count"),
            count_if(F.col("risk_level") == "High").alias("high_count"),
            F.countDistinct("meter_id").alias("meter_count"),
        )
        .orderBy(F.desc("avg_risk_score"), F.desc("critical_count"), "area")
    )


def risk_level_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        *[count_if(F.col("risk_level") == name).alias(name.lower()) for name in ("Critical", "High", "Medium", "Low")]
    )


def top_risk(df: DataFrame, limit: int = 25, tie: str = "reading_id") -> DataFrame:
    keys = [F.desc(c) for c in ("risk_score", "theft_probability") if c in df.columns]
    return df.orderBy(*keys, tie).limit(limit)
