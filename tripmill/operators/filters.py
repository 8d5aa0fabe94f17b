"""Row filters of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.metrics import elapsed

REQUIRED = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount")


def required_present(raw: DataFrame) -> DataFrame:
    """Raw rows that have every required text."""
    return raw.dropna(subset=list(REQUIRED))


def null_critical() -> Column:
    """Raw row without pickup time or total."""
    return F.col("tpep_pickup_datetime").isNull() | F.col("total_amount").isNull()


def business_rules() -> Column:
    """Typed row that counts as a trip; unknown counts as no.

    The bounds are on the plain key columns where possible: Catalyst can move a condition on the
    keys of a de-duplication below it, into the stage before the shuffle, but never the others.
    """
    trip_time = elapsed(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return (
        (F.col("total_amount") > 0)
        & (F.col("fare_amount") >= 0)
        & (F.col("trip_distance_miles") >= 0)
        & F.col("passenger_count").between(0, 20)
        # Hence also pickup before dropoff.
        & trip_time.between(F.expr("INTERVAL '1' MINUTE"), F.expr("INTERVAL '360' MINUTE"))
    )


def ends_before_start() -> Column:
    return (F.col("dropoff_datetime") <= F.col("pickup_datetime")) | (
        F.col("trip_duration_mins") <= 0
    )


def total_below_fare() -> Column:
    return (F.col("total_amount") < F.col("fare_amount")) & (F.col("total_amount") > 0)
