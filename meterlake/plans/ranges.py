"""Ranks of all rows without a sort in one task: places within a partition or cell, on top of the counts of those before it.

Exact quantiles and running totals of numbers are in `plans/radix.py`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.numeric import order_hash
from meterlake.plans.session import cut_lineage


def in_order(df: DataFrame, column: str) -> DataFrame:
    """Add `place`, from 0, in the order of a column without repeats: Spark's ranges, a rank in each, and the sizes of those before."""
    spark = df.sparkSession
    ranges = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), column)
    dealt = cut_lineage(ranges.withColumn("_range", F.spark_partition_id()))
    # One row per partition.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(column)
    ranked = dealt.withColumn("_nth", F.row_number().over(inside) - 1).join(F.broadcast(sizes), "_range")
    return ranked.withColumn("place", F.col("_nth") + F.col("_before")).drop("_range", "_nth", "_before")


def ranked_by_hash(df: DataFrame, by: str, key: str, seed: int = 42, cells: int = 4096) -> DataFrame:
    """Add `_rank` (from 1, in seeded hash order) and `_size` of the row's group.

    Every group is spread over hash cells; ranks are offsets of the cell plus a rank inside it, so
    the biggest group is never sorted in one task.
    """
    place = order_hash(F.col(key), seed)
    spread = df.withColumn("_h", place).withColumn(
        "_cell", F.floor(F.col("_h") * F.lit(cells) / F.lit(2147483648)).cast("int")
    )
    per_cell = spread.groupBy(by, "_cell").agg(F.count("*").alias("_n"))
    sofar = Window.partitionBy(by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_cell.select(
        by,
        "_cell",
        F.coalesce(F.sum("_n").over(sofar), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(by)).alias("_size"),
    )
    within = Window.partitionBy(by, "_cell").orderBy("_h", key)
    return (
        spread.join(
            offsets.withColumnsRenamed({by: "_by", "_cell": "_at"}), F.col(by).eqNullSafe(F.col("_by")) & F.col("_cell").eqNullSafe(F.col("_at"))
        )
        .withColumn("_rank", F.col("_before") + F.row_number().over(within))
        .drop("_h", "_cell", "_before", "_by", "_at")
    )


def approximate_quantile(df: DataFrame, value: str, p: float, accuracy: int = 100_000) -> DataFrame:
    """Sketch-based alternative: one pass, bounded memory, rank error about 1/accuracy."""
    return df.agg(F.percentile_approx(value, F.lit(float(p)), F.lit(accuracy)).alias("quantile"))


