"""Order statistics without a sort: values are dealt to digits of an order-preserving code, and only digits that matter are refined.

A double falls into a bucket by its sign, its binary exponent and the next BITS bits of its mantissa: at most a few million buckets, whatever
the rows hold, and a few hundred in practice. Two finer digits (of FINER bits, then the value itself) order what is inside one. So every
window over buckets, or over what is inside a bucket, has a bounded number of rows, no value is sampled, and no rows are sorted. The digits
decide where counts are kept, never what the result is.

Nulls have no place; NaN comes last, after infinity; zeros of either sign are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS, FINER = 10, 21
#: Exponents are moved to be positive; values below 2^-LEAST share a bucket, and only the last digit orders them.
LEAST = 900
INFINITE, NOT_A_NUMBER = 1 << 61, 1 << 62


def _scaled(size: Column, exponent: Column, bits: int) -> Column:
    """size / 2^exponent in units of 2^-bits, rounded down; exact, as powers of two only move the point."""
    return F.floor(size * F.pow(F.lit(2e0), F.lit(float(bits)) - exponent))


def _exponent(size: Column) -> Column:
    # A logarithm may be off next to a power of two, but it never falls as the value rises, and no more is asked of it.
    return F.greatest(F.floor(F.log2(size)), F.lit(-LEAST)).cast("double")


def digit(value: Column, bits: int = BITS) -> Column:
    """Bucket of a double: rises with the value."""
    size = F.abs(value)
    exponent = _exponent(size)
    plain = ((exponent.cast("bigint") + LEAST + 1) * F.lit(1 << (bits + 2)) + _scaled(size, exponent, bits)) * F.signum(value).cast("bigint")
    return (
        F.when(value.isNull(), F.lit(None).cast("bigint"))
        .when(F.isnan(value), F.lit(NOT_A_NUMBER))
        .when(size == float("inf"), F.signum(value).cast("bigint") * F.lit(INFINITE))
        .when(value == 0, F.lit(0).cast("bigint"))
        .otherwise(plain)
    )


def finer_digit(value: Column, bits: int = BITS) -> Column:
    """Second digit: rises with the value among values of one bucket."""
    size = F.abs(value)
    inside = _scaled(size, _exponent(size), bits + FINER) * F.signum(value).cast("bigint")
    return F.when(F.isnan(value) | (size == float("inf")) | (value == 0), F.lit(0).cast("bigint")).otherwise(inside)


def _sums(names: list[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _before(rows: DataFrame, keys: list[str], order: str, names: list[str], offsets: dict[str, str] | None = None) -> DataFrame:
    """Add `_b_<name>`: the sum over all smaller rows of the same keys, on top of the offsets of the level above."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = {n: F.col(offsets[n]) if offsets else F.lit(0) for n in names}
    return rows.withColumns({f"_b_{n}": F.coalesce(F.sum(n).over(window), F.lit(0)) + start[n] for n in names})


def counted(df: DataFrame, value: str, measures: dict[str, Column], by: list[str], bits: int = BITS) -> DataFrame:
    """One row per distinct value and group: the measures and both digits."""
    known = df.where(F.col(value).isNotNull())
    grouped = known.groupBy(*by, value).agg(*[m.alias(n) for n, m in measures.items()])
    number = F.col(value).cast("double")
    return grouped.withColumns({"_d1": digit(number, bits), "_d2": finer_digit(number, bits)})


def accumulated(values: DataFrame, value: str, names: list[str], by: list[str], starts: DataFrame | None = None) -> DataFrame:
    """Distinct values (as `counted` gives them) with `cum_<name>`, the running total up to and including each.

    `starts` (by, _d1, _b_<name>) gives totals before each bucket where `values` holds some buckets only.
    """
    fine = values.groupBy(*by, "_d1", "_d2").agg(*_sums(names))
    before = {n: f"_b_{n}" for n in names}
    if starts is None:
        starts = _before(fine.groupBy(*by, "_d1").agg(*_sums(names)), by, "_d1", names).select(*by, "_d1", *before.values())
    above = {f"_b_{n}": f"_above_{n}" for n in names}
    placed = fine.join(starts.withColumnsRenamed(above), [*by, "_d1"])
    placed = _before(placed, [*by, "_d1"], "_d2", names, {n: f"_above_{n}" for n in names}).select(*by, "_d1", "_d2", *before.values())
    inside = Window.partitionBy(*by, "_d1", "_d2").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    total = {f"cum_{n}": F.sum(n).over(inside) + F.col(f"_b_{n}") for n in names}
    return values.join(placed, [*by, "_d1", "_d2"]).withColumns(total).select(*by, value, *names, *total)


def running_totals(df: DataFrame, value: str, measures: dict[str, Column], by: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """One row per distinct value: each measure, and `cum_<measure>` up to and including that value; groups of `by` are kept apart."""
    by = by or []
    return accumulated(counted(df, value, measures, by, bits), value, list(measures), by)


def exact_quantile(df: DataFrame, value: str, p: float, bits: int = BITS) -> DataFrame:
    """Linearly interpolated quantile as a one-row frame (`quantile`; null over nothing).

    The rows are read once for the counts of all buckets and once for the counts inside the one or two buckets that hold the ranks next to
    the quantile; a third time only where a bucket of the second digit still holds different values. Each time one or two rows of counts
    come to the driver.
    """
    rows = df.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()).withColumn("_d1", digit(F.col("_v"), bits))
    n = F.count(F.lit(1)).alias("n")
    level = _before(rows.groupBy("_d1").agg(n), [], "_d1", ["n"]).withColumn("_all", F.sum("n").over(Window.partitionBy()))
    at = (F.col("_all") - 1) * F.lit(float(p))

    def holders(level: DataFrame, ranks: list[Column]) -> list:
        hit = [(F.col("_b_n") <= r) & (F.col("_b_n") + F.col("n") > r) for r in ranks]
        return level.where(hit[0] | hit[1]).collect()

    first = holders(level, [F.floor(at), F.ceil(at)])
    spark = df.sparkSession
    if not first:
        return spark.range(1).select(F.lit(None).cast("double").alias("quantile"))
    position = (first[0]["_all"] - 1) * float(p)
    low, high = int(position // 1), int(-(-position // 1))
    ranks = [F.lit(low), F.lit(high)]
    inside = rows.where(F.col("_d1").isin([r["_d1"] for r in first])).withColumn("_d2", finer_digit(F.col("_v"), bits))
    level = inside.groupBy("_d1", "_d2").agg(n, F.min("_v").alias("least"), F.max("_v").alias("most"))
    start = F.coalesce(*[F.when(F.col("_d1") == r["_d1"], F.lit(r["_b_n"])) for r in first])
    second = holders(_before(level.withColumn("_s_n", start), ["_d1"], "_d2", ["n"], {"n": "_s_n"}), ranks)
    found: dict[int, float] = {}
    open_ = []
    for row in second:
        for rank in {low, high}:
            if row["_b_n"] <= rank < row["_b_n"] + row["n"]:
                if row["least"] == row["most"] or row["least"] != row["least"]:
                    found[rank] = row["least"]
                else:
                    open_.append((row["_d1"], row["_d2"], row["_b_n"]))
    if open_:
        wanted = F.lit(False)
        start = F.lit(None).cast("bigint")
        for a, b, before in open_:
            here = (F.col("_d1") == a) & (F.col("_d2") == b)
            wanted, start = wanted | here, F.when(here, F.lit(before)).otherwise(start)
        level = inside.where(wanted).groupBy("_d1", "_d2", "_v").agg(n).withColumn("_s_n", start)
        for row in holders(_before(level, ["_d1", "_d2"], "_v", ["n"], {"n": "_s_n"}), ranks):
            found |= {rank: row["_v"] for rank in {low, high} if row["_b_n"] <= rank < row["_b_n"] + row["n"]}
    quantile = found[low] + (found[high] - found[low]) * (position - low) if high > low else found[low]
    return spark.range(1).select(F.lit(quantile).cast("double").alias("quantile"))
