"""Numeric columns: missing values, clamping and stable rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def clamp_negative(value: Column) -> Column:
    """Negative readings show as 0; a missing one stays missing (``greatest`` alone would skip the NULL)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def round_half_up(value: Column, digits: int) -> Column:
    """``round`` that does not depend on the order in which a mean was summed.

    Two partial sums added in another order differ in the last bits, which flips a value that lies on an exact half. The first
    rounding removes those bits.
    """
    return F.round(F.round(value, digits + 6), digits)


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(F.round(value, digits + 6), digits)


def round_to_precision(value: Column, precision: Column) -> Column:
    """Round to a number of digits held in a column (``round`` takes a literal only)."""
    scale = F.pow(F.lit(10.0), precision)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale
