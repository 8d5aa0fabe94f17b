"""Damage to tables so that every declared check finds something, in Spark and as SQL.

A row has a number; where the number leaves a given remainder, one column gets a value that a check must count (or
NULL, which conditions let pass). Each change is written down once for Spark and once for SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.schema import BRONZE_TRIPS, GOLD_DAILY, GOLD_HEATMAP, GOLD_PAYMENT, SILVER_TRIPS

_NULL = (None, "NULL")

# Table -> number of a row (Spark, SQL), modulus, and (column, (value in Spark, value in SQL)) by remainder.
CHANGES: dict[str, tuple[tuple[str, str], int, Sequence[tuple[str, tuple]]]] = {
    BRONZE_TRIPS: (
        ("ingestion_id", "ingestion_id"),
        83,
        (
            ("ingestion_id", _NULL),
            ("ingestion_id", (F.expr, "ingestion_id + 1")),
            ("vendor_id", _NULL),
            ("tpep_pickup_datetime", _NULL),
            ("tpep_dropoff_datetime", _NULL),
            ("total_amount", _NULL),
            ("batch_id", _NULL),
            ("ingested_at", _NULL),
        ),
    ),
    SILVER_TRIPS: (
        ("ingestion_id", "ingestion_id"),
        89,
        (
            ("trip_id", _NULL),
            ("vendor_id", _NULL),
            ("vendor_id", (7, "7")),
            ("pickup_datetime", _NULL),
            ("dropoff_datetime", _NULL),
            ("passenger_count", _NULL),
            ("trip_distance_miles", _NULL),
            ("payment_type_code", _NULL),
            ("payment_type_label", _NULL),
            ("payment_type_label", ("Barter", "'Barter'")),
            ("fare_amount", _NULL),
            ("fare_amount", (-1, "-1")),
            ("total_amount", _NULL),
            ("total_amount", (0, "0")),
            ("trip_duration_mins", _NULL),
            ("tip_percentage", _NULL),
            ("tip_percentage", (1.5, "15000000000000000")),
        ),
    ),
    GOLD_DAILY: (
        (
            "day(pickup_date) * 7 + coalesce(vendor_id, 0) * 3 + length(payment_type_label)",
            "day(CAST(pickup_date AS DATE)) * 7 + coalesce(vendor_id, 0) * 3 + length(payment_type_label)",
        ),
        23,
        (
            ("summary_id", _NULL),
            ("summary_id", ("same", "'same'")),
            ("pickup_date", _NULL),
            ("total_trips", _NULL),
            ("total_trips", (0, "0")),
            ("total_revenue", _NULL),
            ("total_revenue", (-5, "-5")),
            ("avg_fare_per_trip", _NULL),
            ("avg_fare_per_trip", (0, "0")),
            ("avg_tip_rate", _NULL),
            ("avg_tip_rate", (1.5, "1.5")),
            ("avg_duration_mins", _NULL),
            ("avg_duration_mins", (-1, "-1")),
            ("vendor_name", _NULL),
            ("payment_type_label", _NULL),
        ),
    ),
    GOLD_HEATMAP: (
        ("pickup_hour * 7 + day_of_week_num", "pickup_hour * 7 + day_of_week_num"),
        13,
        (
            ("pickup_hour", _NULL),
            ("pickup_hour", (24, "24")),
            ("trip_count", _NULL),
            ("trip_count", (0, "0")),
        ),
    ),
    GOLD_PAYMENT: (
        # Codes 1 (two labels), 2, 3 and 9.
        ("payment_type_code + if(payment_type_label = 'Other', 3, 0)", "payment_type_code + CASE payment_type_label WHEN 'Other' THEN 3 ELSE 0 END"),
        13,
        (
            ("payment_type_label", (F.expr, "payment_type_label")),
            ("pct_of_total_trips", (101, "101")),
            ("payment_type_label", _NULL),
            ("tip_frequency_pct", (-1, "-1")),
            ("pct_of_total_trips", _NULL),
        ),
    ),
}


def damaged(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the changes of ``table``."""
    (number, _), modulus, changes = CHANGES[table]
    kinds = dict(df.dtypes)
    columns: dict[str, Column] = {}
    for remainder, (name, (value, sql)) in enumerate(changes):
        new = F.expr(sql) if value is F.expr else F.lit(value)
        here = F.col("_number") % modulus == remainder
        columns[name] = F.when(here, new.cast(kinds[name])).otherwise(columns.get(name, F.col(name)))
    return df.withColumn("_number", F.expr(number)).withColumns(columns).drop("_number")


def damage_sql(source: str, table: str, name: str, stand_in: dict[str, str] | None = None) -> str:
    """The same as a common table expression ``name`` over ``source``, with the row's ``number`` added.

    ``stand_in`` names the columns of ``source`` that hold a column's value in another scale.
    """
    (_, number), modulus, changes = CHANGES[table]
    columns: dict[str, str] = {}
    for remainder, (column, (_, sql)) in enumerate(changes):
        held = (stand_in or {}).get(column, column)
        before = columns.get(held, held)
        columns[held] = f"CASE WHEN ({number}) % {modulus} = {remainder} THEN {sql} ELSE {before} END"
    replaced = ", ".join(f"{sql} AS {held}" for held, sql in columns.items())
    return f"{name} AS (SELECT * REPLACE ({replaced}), {number} AS number FROM {source})"
