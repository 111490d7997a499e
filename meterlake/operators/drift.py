"""Drift and data-quality comparison of a reference frame with a current one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.numeric import column_or, count_if, exact_avg, round_to
from meterlake.plans.radix import accumulated, counted, digit
from meterlake.plans.session import cut_lineage

SHIFT_CUT = 0.12
NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def common_numeric(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns that are numeric on both sides; read from the schemas."""
    right = dict(current.dtypes)
    return [
        c for c, t in reference.dtypes
        if (t in NUMERIC or t.startswith("decimal")) and (right.get(c) in NUMERIC or str(right.get(c)).startswith("decimal"))
    ]


#: Whole units that sums are kept in, so that they merge without regard to order.
SCALE = 1e6
#: Rows of `column_sums` that are no column: rows, cells, null cells, and the two rates with nulls as 0.
ROWS, CELLS, NULLS, THEFT_RATE, PREDICTED = "#rows", "#cells", "#nulls", "#is_theft", "#theft_probability"


def column_sums(df: DataFrame) -> DataFrame:
    """Sum (in millionths) and count of every numeric column, and what the report needs besides, as rows (feature, units, n).

    One pass; rows of several frames add up (`merge_sums`).
    """
    def units(value: Column) -> Column:
        return F.coalesce(F.sum(F.rint(value * F.lit(SCALE)).cast("decimal(20,0)")), F.lit(0)).cast("decimal(30,0)")

    def whole(value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("decimal(30,0)")

    numeric = [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]
    nulls = sum((F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in df.columns), F.lit(0)).cast("bigint")
    count = F.count(F.lit(1))
    facts = {c: (units(column_or_null(df, c)), F.count(column_or_null(df, c))) for c in numeric}
    facts |= {ROWS: (whole(count), count), CELLS: (whole(count * len(df.columns)), count), NULLS: (whole(F.sum(nulls)), count)}
    facts |= {THEFT_RATE: (units(column_or(df, "is_theft")), count), PREDICTED: (units(column_or(df, "theft_probability")), count)}
    wide = df.agg(*[F.struct(u.alias("units"), n.alias("n")).alias(c) for c, (u, n) in facts.items()])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`.units").alias("units"), F.col(f"`{c}`.n").alias("n")) for c in facts]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merge_sums(parts: DataFrame) -> DataFrame:
    """Sums of several frames as those of all their rows."""
    return parts.groupBy("feature").agg(F.sum("units").cast("decimal(30,0)").alias("units"), F.sum("n").alias("n"))


def _mean() -> Column:
    return F.coalesce(F.try_divide(F.col("units").cast("double") / F.lit(SCALE), F.col("n").cast("double")), F.lit(0e0))


def column_or_null(df: DataFrame, name: str) -> Column:
    from meterlake.functions.numeric import number

    return number(F.col(f"`{name}`"), None)


def shifts_of(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Shift of the mean of every column that both sums have."""
    r = reference.select("feature", _mean().alias("r"))
    c = current.select("feature", _mean().alias("c"))
    joined = r.join(F.broadcast(c), "feature").where(~F.startswith("feature", F.lit("#")))  # one row per column
    shift = F.abs(F.col("c") - F.col("r")) / F.greatest(F.abs("r"), F.lit(1e-6))
    return joined.select(
        "feature",
        round_to(F.col("r"), 4).alias("reference_mean"),
        round_to(F.col("c"), 4).alias("current_mean"),
        round_to(shift, 4).alias("relative_shift"),
        (shift >= SHIFT_CUT).alias("drift_detected"),
    )


def mean_shift(reference: DataFrame, current: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Relative shift of every common numeric column's mean, biggest first; one pass per side."""
    columns = [f"`{c}`" for c in columns or common_numeric(reference, current)]
    return shifts_of(column_sums(reference.select(columns)), column_sums(current.select(columns))).orderBy(F.desc("relative_shift"), "feature")


def _concept(old: Column, new: Column) -> tuple[Column, Column, Column]:
    """Shift of the theft rate, of the predicted probability, and whether either counts; sides are maps of means."""
    rate, prob = (F.coalesce(new[c], F.lit(0e0)) - F.coalesce(old[c], F.lit(0e0)) for c in (THEFT_RATE, PREDICTED))
    return rate, prob, (F.abs(rate) >= 0.05) | (F.abs(prob) >= 0.08)


def _means_map(sums: DataFrame) -> DataFrame:
    """One row with the maps of means and of units."""
    pairs = F.collect_list(F.struct("feature", _mean().alias("m"), "units"))
    row = sums.agg(pairs.alias("p"))  # one row per column
    as_map = lambda field: F.map_from_entries(F.transform("p", lambda e: F.struct(e["feature"], e[field])))
    return row.select(as_map("m").alias("mean"), as_map("units").alias("units"))


def concept_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Shift of the theft rate and of the mean predicted probability."""
    def side(df: DataFrame, name: str) -> DataFrame:
        used = [c for c in ("is_theft", "theft_probability") if c in df.columns]
        return _means_map(column_sums(df.select(used or df.columns[:1]))).select(F.col("mean").alias(name))

    both = side(current, "c").withColumn("r", side(reference, "r").scalar())
    rate, prob, detected = _concept(F.col("r"), F.col("c"))
    return both.select(round_to(rate, 4).alias("theft_rate_shift"), round_to(prob, 4).alias("prediction_rate_shift"), detected.alias("detected"))


def missing_pct(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean share of nulls over the columns, in percent."""
    columns = columns or df.columns
    nulls = sum((F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in columns), F.lit(0)).cast("bigint")
    return df.agg(F.coalesce(F.sum(nulls).cast("double") / F.nullif(F.count("*") * len(columns), F.lit(0)), F.lit(0e0)).alias("share")).select(
        round_to(F.col("share") * 1e2, 3).alias("missing_pct"), (F.col("share") >= 0.03).alias("elevated")
    )


def duplicate_keys(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return (
        df.groupBy("meter_id", F.col(time_col).alias("timestamp")).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
    )


def has_repeats(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """One row (`repeats`): does any meter have two rows of one time?"""
    return duplicate_keys(df.select("meter_id", time_col), time_col).limit(1).agg((F.count("*") > 0).alias("repeats"))


def report_of(reference: DataFrame, current: DataFrame, repeats: DataFrame) -> DataFrame:
    """The report as one flat row, from the column sums of both sides; the overall flag looks at every feature and issue."""
    shifts = shifts_of(reference, current).agg(
        F.struct(F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("any"), count_if(F.col("drift_detected")).alias("n")).alias("s")
    )

    def missing(units: Column) -> Column:
        return F.coalesce(F.try_divide(units[NULLS].cast("double"), units[CELLS].cast("double")), F.lit(0e0))

    row = _means_map(current).select(F.struct("*").alias("c")).withColumns(
        {"r": _means_map(reference).select(F.struct("*")).scalar(), "_repeats": repeats.select("repeats").scalar(), "_shifts": shifts.scalar()}
    )
    rate, prob, detected = _concept(F.col("r.mean"), F.col("c.mean"))
    row = row.withColumns({"_rate": rate, "_prob": prob, "_concept": detected, "_old": missing(F.col("r.units")), "_new": missing(F.col("c.units"))})
    issues = F.array_compact(
        F.array(
            F.when(F.col("_new") >= 0.03, F.lit("Incoming data has elevated missing-value ratio.")),
            F.when(F.col("_repeats"), F.lit("Duplicate meter/timestamp rows detected in current data.")),
        )
    )
    row = row.withColumn("issues", F.array_join(issues, " ")).withColumn("issue_count", F.size(issues))
    return row.select(
        (F.col("_shifts.any") | F.col("_concept") | (F.col("issue_count") > 0)).cast("int").alias("drift_detected"),
        F.col("_shifts.n").alias("drifted_features"),
        round_to(F.col("_old") * 1e2, 3).alias("reference_missing_pct"),
        round_to(F.col("_new") * 1e2, 3).alias("current_missing_pct"),
        "issue_count",
        "issues",
        round_to(F.col("_rate"), 4).alias("theft_rate_shift"),
        round_to(F.col("_prob"), 4).alias("prediction_rate_shift"),
        F.col("_concept").cast("int").alias("concept_drift_detected"),
    )


def drift_report(reference: DataFrame, current: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """The whole comparison as one flat row: one pass over the reference, one over the current rows, and one for repeated keys."""
    # A row per column each: written, so that no part of the report reads the frames again.
    old, new = cut_lineage(column_sums(reference)), cut_lineage(column_sums(current))
    return report_of(old, new, has_repeats(current, time_col))


def _both_sides(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    def side(df: DataFrame, old: int) -> DataFrame:
        values = [F.col(f"`{c}`").cast("double").alias(c) for c in columns]
        return df.select(*values).unpivot([], columns, "feature", "value").withColumns(
            {"old": F.lit(old).cast("bigint"), "new": F.lit(1 - old).cast("bigint")}
        )

    return side(reference, 1).unionByName(side(current, 0))


#: Bits of the mantissa in a bucket of the first pass: at most 2^18 buckets a column, a few hundred in practice.
DRIFT_BITS = 6


def distribution_drift(reference: DataFrame, current: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Two-sample KS distance and population stability index of each column, by default of all that are numeric on both sides.

    The first pass counts both sides in buckets of values. The gap between the two distributions is then known at the end of every bucket,
    and bounded inside it: it cannot pass the gap at the start plus the reference's share of the bucket, nor fall below it by more than the
    current share. Buckets that cannot hold the greatest gap are done, unless a bin of the stability index (a tenth of the reference rows)
    may begin inside them; the second pass counts the values of the others only. Empty bins count as one ten-thousandth.
    """
    columns = columns or common_numeric(reference, current)
    both = _both_sides(reference, current, columns).where(F.col("value").isNotNull()).withColumn("_d1", digit(F.col("value"), DRIFT_BITS))
    coarse = both.groupBy("feature", "_d1").agg(F.sum("old").alias("o"), F.sum("new").alias("n"))
    upto = Window.partitionBy("feature").orderBy("_d1").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("feature")
    coarse = coarse.withColumns({f"cum_{c}": F.sum(c).over(upto) for c in "on"} | {f"all_{c}": F.sum(c).over(whole) for c in "on"})
    coarse = coarse.withColumn("gap", F.abs(_gap())).withColumn("best", F.max("gap").over(whole))
    start = {c: F.col(f"cum_{c}") - F.col(c) for c in "on"}
    before = start["o"] / F.col("all_o") - start["n"] / F.col("all_n")
    reach = F.greatest(F.abs(before + F.col("o") / F.col("all_o")), F.abs(before - F.col("n") / F.col("all_n")))
    bin_of = lambda rows: F.least(F.floor(rows * 10 / F.col("all_o")), F.lit(9)).cast("int")
    # A little is added to the bound, as shares are rounded.
    refine = (reach + 1e-9 > F.col("best")) | (bin_of(start["o"]) != bin_of(F.col("cum_o")))
    coarse = coarse.withColumns({"refine": refine & ((F.col("o") + F.col("n")) > 1), "_b_o": start["o"], "_b_n": start["n"]})
    # At most 2^18 rows a column, 30 bytes each.
    chosen = F.broadcast(coarse.where("refine").select("feature", "_d1"))
    fine = counted(both.join(chosen, ["feature", "_d1"]).drop("_d1"), "value", {"o": F.sum("old"), "n": F.sum("new")}, ["feature"], DRIFT_BITS)
    starts = coarse.where("refine").select("feature", "_d1", "_b_o", "_b_n")
    fine = accumulated(fine, "value", ["o", "n"], ["feature"], starts).select("feature", "o", "n", "cum_o", "cum_n")
    sizes = coarse.groupBy("feature").agg(F.max("all_o").alias("all_o"), F.max("all_n").alias("all_n"))
    rows = coarse.where("NOT refine").select("feature", "o", "n", "cum_o", "cum_n").unionByName(fine)
    joined = rows.join(F.broadcast(sizes), "feature").withColumn("gap", F.abs(_gap()))  # one row per column
    per_bin = joined.groupBy("feature", bin_of(F.col("cum_o") - F.col("o")).alias("bin")).agg(
        F.max("gap").alias("gap"),
        F.greatest(F.sum("o") / F.max("all_o"), F.lit(1e-4)).alias("p"),
        F.greatest(F.sum("n") / F.max("all_n"), F.lit(1e-4)).alias("q"),
    )
    return per_bin.groupBy("feature").agg(
        round_to(F.max("gap"), 6).alias("ks"),
        round_to(F.sum(F.rint((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p")) * 1e9)) / 1e9, 6).alias("psi"),
    )


def _gap() -> Column:
    return F.col("cum_o") / F.col("all_o") - F.col("cum_n") / F.col("all_n")


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, nulls, mean, minimum and maximum of each numeric column, in one pass."""
    stats = {"present": F.count, "missing": lambda c: count_if(c.isNull()), "mean": exact_avg, "low": F.min, "high": F.max}
    wide = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{c}|{n}") for c in columns for n, f in stats.items()])
    rows = [F.struct(F.lit(c).alias("feature"), *[F.col(f"`{c}|{n}`").alias(n) for n in stats]) for c in columns]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
