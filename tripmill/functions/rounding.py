"""Exact decimal means and shares, rounded half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(total: Column, count: Column, places: int) -> Column:
    """``total / count`` rounded, from a decimal sum and a row count; NULL for no rows.

    Works on sums and counts so that partial aggregates can be merged first. The casts leave the
    quotient 16 places whatever the scale of the sum.
    """
    quotient = total.cast("decimal(38,16)") / F.nullif(count, F.lit(0)).cast("decimal(16,0)")
    return F.round(quotient, places)


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two places; NULL when ``whole`` is 0."""
    wide = "decimal(20,2)"
    ratio = part.cast(wide) / F.nullif(whole.cast(wide), F.lit(0).cast(wide))
    return F.round(ratio * 100, 2)
