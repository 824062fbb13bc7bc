"""Safe division, rounding and the arithmetic of blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(col: Column, digits: int = 0) -> Column:
    """Round to n digits, ties to even (``round`` takes ties away from zero)."""
    scale = F.lit(float(10**digits))
    return F.rint(col.cast("double") * scale) / scale


def divide(a: Column, b: Column) -> Column:
    """a / b as double; NULL when either is NULL or b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column) -> Column:
    return divide(a, b) * 100


def blank_minus(a: Column, b: Column) -> Column:
    """a - b where one blank counts as 0 and two blanks give a blank."""
    both_blank = a.isNull() & b.isNull()
    return F.when(~both_blank, F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def zero_if_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def blank_if_zero(col: Column) -> Column:
    return F.nullif(col, F.lit(0))
