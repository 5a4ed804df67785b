"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from cohortkit.functions.names import col

FLOATS = (T.DoubleType, T.FloatType)
NUMBERS = (T.NumericType,)


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Quotient, or ``default`` where the denominator is zero; NULL stays NULL."""
    return F.when(denominator == 0, F.lit(float(default))).otherwise(numerator / denominator)


def inside(value: Column, low, high) -> Column:
    """Both ends included."""
    return value.between(F.lit(low), F.lit(high))


def outside(value: Column, low, high) -> Column:
    """Strictly outside; a missing value is not outside."""
    return F.coalesce((value < F.lit(low)) | (value > F.lit(high)), F.lit(False))


def null_for_nan(value: Column, dtype: T.DataType) -> Column:
    """One notion of missing: NaN becomes NULL."""
    return F.nanvl(value, F.lit(None).cast(dtype)) if isinstance(dtype, FLOATS) else value


def known(df: DataFrame, name: str) -> Column:
    """A column of a table in its own type; NaN is missing."""
    return null_for_nan(col(name), df.schema[name].dataType)


def present(value: Column) -> Column:
    """A number as DOUBLE; NaN is missing."""
    value = value.cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def digamma(x: Column) -> Column:
    """The logarithmic derivative of the gamma function for x >= 1, to about 1e-11."""
    y = x + 6.0
    square = 1.0 / (y * y)
    tail = square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240))))
    return F.log(y) - 0.5 / y - tail - sum((1.0 / (x + float(i)) for i in range(1, 6)), 1.0 / x)


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMBERS)


def ordinal(time: Column, dtype: T.DataType) -> Column:
    """A time as a number that sorts the same way, without a time zone.

    LONG, except for fractional times, which stay DOUBLE (NaN is missing).
    """
    if isinstance(dtype, FLOATS):
        return present(time)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(time)
    if isinstance(dtype, T.TimestampNTZType):
        days = F.datediff(time, F.lit("1970-01-01")).cast("long")
        seconds = F.hour(time) * 3600 + F.minute(time) * 60
        micros = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")
        return (days * 86_400 + seconds) * 1_000_000 + micros
    if isinstance(dtype, T.DateType):
        return F.unix_date(time).cast("long")
    if isinstance(dtype, T.IntegralType):
        return time.cast("long")
    raise TypeError(f"cannot split by a time of type {dtype.simpleString()}")
