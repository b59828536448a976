"""Strict and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict(text: Column, dtype: str) -> Column:
    """Empty text is NULL, anything else must parse: bad text fails the job."""
    return F.nullif(text, F.lit("")).cast(dtype)


def lenient_double(value: Column) -> Column:
    """Text that does not parse is NULL, and so is NaN."""
    return F.nullif(value.try_cast("double"), F.lit(float("nan")))


def lenient_int(value: Column) -> Column:
    """Number text truncated towards zero; NaN, infinities and values beyond 32 bits are NULL."""
    return value.try_cast("double").try_cast("int")


def point(location: Column) -> Column:
    """(x, y) of an array of coordinate texts.

    Both are NULL when the array is shorter than two or one coordinate is not a number;
    a missing coordinate alone is NULL alone.
    """
    x, y = F.try_element_at(location, F.lit(1)), F.try_element_at(location, F.lit(2))
    xd, yd = x.try_cast("double"), y.try_cast("double")
    usable = (F.size(location) >= 2) & (xd.isNotNull() | x.isNull()) & (yd.isNotNull() | y.isNull())
    return F.struct(F.when(usable, xd).alias("x"), F.when(usable, yd).alias("y"))
