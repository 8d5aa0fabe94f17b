"""Bronze to silver: parse, keep the latest row per trip, validate, enrich."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import calendar, labels, metrics, parse
from tripmill.functions.keys import surrogate_key
from tripmill.operators.dedupe import TRIP_KEY, latest_per_key
from tripmill.operators.filters import business_rules, required_present
from tripmill.schema import SILVER, as_table

# Typed column -> (parser, raw column).
_TYPED = {
    "vendor_id": (parse.int_or_null, "vendor_id"),
    "pickup_datetime": (parse.timestamp, "tpep_pickup_datetime"),
    "dropoff_datetime": (parse.timestamp, "tpep_dropoff_datetime"),
    "passenger_count": (parse.int_or_null, "passenger_count"),
    "trip_distance_miles": (parse.decimal_or_null, "trip_distance"),
    "pickup_location_id": (parse.int_or_null, "pu_location_id"),
    "dropoff_location_id": (parse.int_or_null, "do_location_id"),
    "rate_code_id": (parse.int_or_null, "rate_code_id"),
    "store_and_fwd_flag": (parse.trimmed, "store_and_fwd_flag"),
    "payment_type_code": (parse.int_or_null, "payment_type"),
    "payment_type_label": (labels.payment_label, "payment_type"),
    "fare_amount": (parse.strict_decimal_or_null, "fare_amount"),
    "extra": (parse.strict_decimal_or_null, "extra"),
    "mta_tax": (parse.strict_decimal_or_null, "mta_tax"),
    "tip_amount": (parse.strict_decimal_or_null, "tip_amount"),
    "tolls_amount": (parse.strict_decimal_or_null, "tolls_amount"),
    "improvement_surcharge": (parse.strict_decimal_or_null, "improvement_surcharge"),
    "congestion_surcharge": (parse.strict_decimal_or_null, "congestion_surcharge"),
    "airport_fee": (parse.strict_decimal_or_null, "airport_fee"),
    "total_amount": (parse.strict_decimal_or_null, "total_amount"),
}
_TIMES = ("tpep_pickup_datetime", "tpep_dropoff_datetime")


def typed_columns() -> dict[str, Column]:
    return {name: parser(F.col(raw)) for name, (parser, raw) in _TYPED.items()}


def typed(bronze: DataFrame) -> DataFrame:
    """Typed rows of all raw rows that have the required texts."""
    columns = [c.alias(name) for name, c in typed_columns().items()]
    return required_present(bronze).select("ingestion_id", "batch_id", "ingested_at", *columns)


def malformed_times(bronze: DataFrame) -> DataFrame:
    """Raw rows whose times do not parse: the rows that make ``clean`` fail."""
    bad = [parse.timestamp_or_null(F.col(c)).isNull() for c in _TIMES]
    return required_present(bronze).where(bad[0] | bad[1])


def without_malformed_times(bronze: DataFrame) -> DataFrame:
    """The other raw rows: the input for ``clean`` once the malformed ones have been set aside."""
    return bronze.where(
        " AND ".join(f"({c} IS NULL OR try_cast({c} AS timestamp_ntz) IS NOT NULL)" for c in _TIMES)
    )


def enriched(trips: DataFrame) -> DataFrame:
    """Typed rows with key (unless they have it), measures and calendar parts."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    distance, total = F.col("trip_distance_miles"), F.col("total_amount")
    has_key = "trip_id" in trips.columns
    return trips.withColumns(
        {
            "trip_id": F.col("trip_id") if has_key else surrogate_key(*[F.col(c) for c in TRIP_KEY]),
            "pickup_date": F.to_date(pickup),
            "pickup_hour": calendar.hour(pickup),
            "pickup_day_of_week": calendar.day_name(pickup),
            "pickup_month": calendar.month(pickup),
            "pickup_year": calendar.year(pickup),
            "trip_duration_mins": metrics.duration_mins(pickup, dropoff),
            "avg_speed_mph": metrics.speed_mph(distance, pickup, dropoff),
            "cost_per_mile": metrics.cost_per_mile(total, distance),
            "tip_percentage": metrics.tip_ratio(F.col("tip_amount"), total),
        }
    )


def latest_valid(bronze: DataFrame) -> DataFrame:
    """Parsed columns of the latest row of each trip, if it is valid.

    The latest row is chosen first and validated after: if it is invalid, the trip is gone, even if
    an older row was valid.
    """
    return latest_per_key(typed(bronze)).where(business_rules())


def derived(trips: DataFrame) -> DataFrame:
    """Parsed rows as silver rows."""
    return as_table(enriched(trips), SILVER)


def clean(bronze: DataFrame) -> DataFrame:
    """The silver table. Derived columns come last, so the one shuffle carries parsed columns only."""
    return derived(latest_valid(bronze))


def picked_up_between(silver: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Trips with a pickup from ``start`` on and before ``end``.

    The bounds are put on the pickup date as well: Parquet readers skip row groups by dates, but not by times
    without a zone.
    """
    times = [F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz") for at in (start, end)]
    days = F.col("pickup_date").between(F.to_date(times[0]), F.to_date(times[1]))
    return silver.where(days & (F.col("pickup_datetime") >= times[0]) & (F.col("pickup_datetime") < times[1]))
