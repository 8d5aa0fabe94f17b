"""Measures of one trip, in exact decimals of 16 places.

The operand casts fix the scale of each quotient: Spark gives ``decimal(p1,s1) / decimal(p2,s2)``
``s1 + p2 + 1`` places, and here that is never less than 16.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.schema import RATIO


def elapsed(pickup: Column, dropoff: Column) -> Column:
    """Wall-clock interval between two zone-less timestamps, whatever the session time zone."""
    return dropoff - pickup


def elapsed_seconds(pickup: Column, dropoff: Column) -> Column:
    return elapsed(pickup, dropoff).cast("interval second").cast("decimal(18,6)")


def duration_mins(pickup: Column, dropoff: Column) -> Column:
    seconds = elapsed_seconds(pickup, dropoff).cast("decimal(24,12)")
    return (seconds / F.lit(60).cast("decimal(4,0)")).cast(RATIO)


def speed_mph(distance: Column, pickup: Column, dropoff: Column) -> Column:
    """NULL without a distance or without elapsed time."""
    seconds = elapsed_seconds(pickup, dropoff)
    return F.when(
        (distance > 0) & (dropoff > pickup),
        (distance * F.lit(3600).cast("decimal(4,0)") / seconds).cast(RATIO),
    )


def cost_per_mile(total: Column, distance: Column) -> Column:
    """NULL without a distance."""
    return F.when(distance > 0, (total.cast("decimal(18,8)") / distance).cast(RATIO))


def tip_ratio(tip: Column, total: Column) -> Column:
    """Share of the total, 0 to 1; 0 without a positive total, NULL without a tip value."""
    return F.when(total > 0, (tip.cast("decimal(18,8)") / total).cast(RATIO)).otherwise(
        F.lit(0).cast(RATIO)
    )
