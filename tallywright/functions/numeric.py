"""Rounding and ratios.

Money is summed as DECIMAL and only divided as DOUBLE.  ``round_dp`` scales,
rounds to an integer (half away from zero) and scales back, so the result is a
function of the double alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.model import MONEY


def dbl(value: Column) -> Column:
    return value.cast("double")


def money(value: Column) -> Column:
    return value.cast(MONEY)


def round_dp(value: Column, places: int) -> Column:
    scale = F.lit(10.0**places)
    return F.round(value * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient, NULL when the denominator is 0 or NULL."""
    return F.try_divide(dbl(numerator), dbl(denominator))


def percent(numerator: Column, denominator: Column, places: int = 2) -> Column:
    return round_dp(F.try_divide(F.lit(100.0) * dbl(numerator), dbl(denominator)), places)


def zero(value: Column) -> Column:
    """NULL money as 0."""
    return F.coalesce(value, F.lit(0).cast(MONEY))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_where(condition: Column, value: Column) -> Column:
    """Conditional sum that is 0 for a group with no matching row."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast(MONEY)))


def sum_of_keys(key: Column) -> Column:
    """Sum of BIGINT keys modulo 2^64, as a signed BIGINT: the sum itself wherever it fits.

    Added up as DECIMAL, which no number of rows overflows.
    """
    half, whole = (F.lit(str(2**n)).cast("decimal(20,0)") for n in (63, 64))
    total = F.sum(key.cast("decimal(19,0)"))
    return (F.pmod(total + half, whole) - half).cast("bigint")


def present(df: DataFrame) -> DataFrame:
    """Output types: DECIMAL and FLOAT become DOUBLE, small integers BIGINT."""

    def edge(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("bigint").alias(f.name)
        return column

    return df.select(*[edge(f) for f in df.schema.fields])
