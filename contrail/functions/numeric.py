"""Rounding, guarded division and scores; every result is a double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_round(col: Column, digits: int) -> Column:
    """Halves away from zero on the scaled binary value, as SQL engines round doubles.

    Spark's own ``round(x, n)`` works on the decimal text of ``x`` and differs
    for values such as 0.285 and 1.005.
    """
    scale = F.lit(10.0 ** digits)
    return F.round(col * scale, 0) / scale


def even_round(col: Column, digits: int) -> Column:
    """Halves to the even neighbour."""
    scale = F.lit(10.0 ** digits)
    return F.rint(col * scale) / scale


def text_round(col: Column, digits: int) -> Column:
    """Nearest decimal to the exact binary value, as printing with fixed digits gives.

    ``col * scale`` can round onto a half although the exact product lies beside
    it (2.675 is a little less than it looks); the rounding error of the product,
    from a split of ``col`` into two short halves, then tells the side.
    """
    scale = F.lit(10.0 ** digits)
    scaled = col * scale
    shifted = col * F.lit(134217729.0)
    high = shifted - (shifted - col)
    error = (high * scale - scaled) + (col - high) * scale
    below = F.floor(scaled).cast("double")
    half = scaled - below == 0.5
    return (F.when(half & (error < 0), below).when(half & (error > 0), below + 1)
            .otherwise(F.rint(scaled)) / scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in standard deviations; 0 without any spread."""
    return F.when(std > 0, (value - mean) / std).otherwise(F.lit(0.0))


def share_pct(flag: Column) -> Column:
    """Aggregate: percentage of rows for which ``flag`` is true."""
    return F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0))) * 100


def count_if(flag: Column) -> Column:
    """Aggregate: number of rows for which ``flag`` is true."""
    return F.count(F.when(flag, F.lit(1)))
