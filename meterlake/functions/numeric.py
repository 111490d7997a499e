"""Rounding, coercion and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_to(col: Column, digits: int) -> Column:
    """Scale, round half to even, scale back (what array libraries do; `F.round` is half-up)."""
    scale = F.lit(float(10**digits))
    return F.rint(col * scale) / scale


def number(col: Column, default: float | None = 0.0) -> Column:
    """Anything to double; unparseable, NaN and null become `default`."""
    value = col.try_cast("double")
    value = F.when(~F.isnan(value), value)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def clip(col: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        col = F.greatest(col, F.lit(float(low)))
    if high is not None:
        col = F.least(col, F.lit(float(high)))
    return col


def ratio(num: Column, den: Column) -> Column:
    """num / den, or 0 where the divisor is 0 or anything is null."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def exact_sum(col: Column, digits: int = 6) -> Column:
    """Sum that does not depend on the order of rows: the addends are whole units of 10^-digits.

    Floating-point sums change with the number of partitions; decimal ones do not.
    """
    scale = float(10**digits)
    units = F.rint(col * F.lit(scale)).cast("decimal(20,0)")
    return F.sum(units).cast("double") / F.lit(scale)


def exact_avg(col: Column, digits: int = 6) -> Column:
    return F.try_divide(exact_sum(col, digits), F.count(col).cast("double"))


def exact_sum_if(cond: Column, col: Column, digits: int = 6) -> Column:
    return exact_sum(F.when(cond, col), digits)


def count_if(cond: Column) -> Column:
    """Rows where `cond` holds, 0 (not null) over nothing."""
    return F.coalesce(F.sum(cond.cast("bigint")), F.lit(0).cast("bigint"))


def with_default(df: DataFrame, name: str, value) -> DataFrame:
    """Add an absent column; decided from the schema, never from the rows."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(value))


def column_or(df: DataFrame, name: str, default: float = 0.0) -> Column:
    """Numeric column with nulls filled, or the constant if the column is absent."""
    if name in df.columns:
        return number(F.col(name), default)
    return F.lit(float(default))


def order_hash(key: Column, seed: int = 42) -> Column:
    """Portable seeded shuffle order over keys (a linear congruential step over whole numbers).

    The key is reduced first, so that no key overflows a bigint; a text that is no number counts by its CRC-32.
    """
    text = key.cast("string")
    low = F.pmod(F.coalesce(text.try_cast("bigint"), F.crc32(text.cast("binary"))), F.lit(2147483648))
    return F.pmod(low * F.lit(1103515245) + F.lit(12345 * seed), F.lit(2147483648))
