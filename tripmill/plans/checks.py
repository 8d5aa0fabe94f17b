"""The declared checks of all tables, and their report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.filters import ends_before_start, total_below_fare
from tripmill.operators.quality import (
    ACCEPTED,
    ERROR,
    EXPRESSION,
    NOT_NULL,
    UNIQUE,
    WARN,
    Check,
    check_table,
    violation,
    missing_from,
    outcome,
)
from tripmill.schema import (
    BRONZE_TEXT_LIMITS,
    BRONZE_TRIPS,
    DEFAULT_PAYMENT_LABEL,
    GOLD_DAILY,
    GOLD_HEATMAP,
    GOLD_PAYMENT,
    PAYMENT_LABELS,
    RUN_LOG,
    SILVER_TRIPS,
)

if TYPE_CHECKING:
    from tripmill.plans.counted import Counted

_LABELS = (*PAYMENT_LABELS.values(), DEFAULT_PAYMENT_LABEL)

# Table -> column -> its checks. A bare word is a kind, a tuple the accepted values,
# other text the rest of a condition on the column.
_DECLARED: dict[str, dict[str, list]] = {
    BRONZE_TRIPS: {
        "ingestion_id": [UNIQUE, NOT_NULL],
        "vendor_id": [NOT_NULL],
        "tpep_pickup_datetime": [NOT_NULL],
        "tpep_dropoff_datetime": [NOT_NULL],
        "total_amount": [NOT_NULL],
        "batch_id": [NOT_NULL],
        "ingested_at": [NOT_NULL],
    },
    SILVER_TRIPS: {
        "trip_id": [UNIQUE, NOT_NULL],
        "vendor_id": [NOT_NULL, (1, 2)],
        "pickup_datetime": [NOT_NULL],
        "dropoff_datetime": [NOT_NULL],
        "passenger_count": [NOT_NULL],
        "trip_distance_miles": [NOT_NULL],
        "payment_type_code": [(1, 2, 3, 4, 5, 6)],
        "payment_type_label": [NOT_NULL, _LABELS],
        "fare_amount": [NOT_NULL, ">= 0"],
        "total_amount": [NOT_NULL, "> 0"],
        "trip_duration_mins": [NOT_NULL, "> 0"],
        "tip_percentage": ["BETWEEN 0 AND 1"],
    },
    GOLD_DAILY: {
        "summary_id": [UNIQUE, NOT_NULL],
        "pickup_date": [NOT_NULL],
        "total_trips": [NOT_NULL, "> 0"],
        "total_revenue": [NOT_NULL, "> 0"],
        "avg_fare_per_trip": [NOT_NULL, "> 0"],
        "avg_tip_rate": ["BETWEEN 0 AND 1"],
        "avg_duration_mins": [NOT_NULL, "> 0"],
        "vendor_name": [NOT_NULL],
        "payment_type_label": [NOT_NULL],
    },
    GOLD_HEATMAP: {
        "pickup_hour": [NOT_NULL, "BETWEEN 0 AND 23"],
        "trip_count": [NOT_NULL, "> 0"],
    },
    GOLD_PAYMENT: {
        # Not unique by design: the table has a row per code, and codes share the label 'Other'.
        "payment_type_label": [UNIQUE, NOT_NULL],
        "pct_of_total_trips": ["BETWEEN 0 AND 100"],
        "tip_frequency_pct": ["BETWEEN 0 AND 100"],
    },
}


def _check(table: str, column: str, declared) -> Check:
    if isinstance(declared, tuple):
        return Check(table, column, ACCEPTED, values=declared)
    if declared in (NOT_NULL, UNIQUE):
        return Check(table, column, declared)
    return Check(table, column, EXPRESSION, rule=declared)


COLUMN_CHECKS = [
    _check(table, column, declared)
    for table, columns in _DECLARED.items()
    for column, some in columns.items()
    for declared in some
]

DROPOFF_AFTER_PICKUP = "dropoff_after_pickup"
TOTAL_GTE_FARE = "total_gte_fare"
GOLD_COVERAGE = "gold_coverage"
RUN_REFERENCE = "run_reference"


def checks_of(table: str, *kinds: str) -> list[Check]:
    return [c for c in COLUMN_CHECKS if c.table == table and (not kinds or c.kind in kinds)]


def dropoff_after_pickup(silver: DataFrame) -> DataFrame:
    """Trips that end before they start."""
    return silver.where(ends_before_start()).select(
        "trip_id", "pickup_datetime", "dropoff_datetime", "trip_duration_mins"
    )


def total_gte_fare(silver: DataFrame) -> DataFrame:
    """Trips whose total is less than the fare."""
    return silver.where(total_below_fare()).select(
        "trip_id", "fare_amount", "total_amount", "tip_amount", "tolls_amount"
    )


def gold_coverage(silver: DataFrame, daily: DataFrame) -> DataFrame:
    """Trip dates that the daily table lacks."""
    return missing_from(silver, daily, "pickup_date")


def run_reference(bronze: DataFrame, runs: DataFrame) -> DataFrame:
    """Run ids in bronze that the run log lacks."""
    return missing_from(
        bronze.select(F.col("pipeline_run_id").alias("run_id")), runs, "run_id"
    )


def _longer_than(column: str, limit: int) -> Callable[[], Column]:
    return lambda: F.length(column) > limit


# Conditions over texts or several columns that no row of a table may meet.
_ROW_CHECKS = {
    BRONZE_TRIPS: {
        f"text_limit_{c}": _longer_than(c, n) for c, n in BRONZE_TEXT_LIMITS.items()
    },
    SILVER_TRIPS: {
        DROPOFF_AFTER_PICKUP: ends_before_start,
        TOTAL_GTE_FARE: total_below_fare,
    }
}
# Checks of one table against another: keys of the first that the second lacks.
_REFERENCES = {
    GOLD_COVERAGE: (gold_coverage, SILVER_TRIPS, GOLD_DAILY),
    RUN_REFERENCE: (run_reference, BRONZE_TRIPS, RUN_LOG),
}


def row_conditions(table: str) -> dict[str, Column]:
    """What each check of single rows of a table counts, by check name."""
    checks = {c.name: violation(c) for c in checks_of(table, NOT_NULL, EXPRESSION)}
    return checks | {name: condition() for name, condition in _ROW_CHECKS.get(table, {}).items()}


#: Tables that have batches, and the column that tells them apart.
_BATCHES = {BRONZE_TRIPS: "batch_id"}


def run_checks(
    tables: Mapping[str, DataFrame],
    severities: Mapping[str, str] | None = None,
    counted: Mapping[str, Counted] | None = None,
) -> DataFrame:
    """Report of every check on the given tables (public table name -> rows).

    ``counted`` has the failures that are known already, by table; these checks do not read it again.

    One row per check: ``check_name, table_name, column_name, kind, failing, severity, status``.
    Every severity is ``warn``, which never fails a run; ``severities`` raises it per check name,
    or for all with the key ``"*"``.
    """
    severities, counted = severities or {}, counted or {}
    counts, described = [], []
    for table, df in tables.items():
        checks = checks_of(table)
        known = counted[table].names if table in counted else frozenset()
        rows = {name: condition() for name, condition in _ROW_CHECKS.get(table, {}).items()}
        described += [(c.name, table, c.column, c.kind) for c in checks]
        described += [(name, table, None, "rows") for name in rows]
        if known:
            counts.append(counted[table].rows)
        left = [c for c in checks if c.name not in known]
        rows = {name: condition for name, condition in rows.items() if name not in known}
        if left or rows:
            counts.append(check_table(df, left, rows, _BATCHES.get(table)))
    for name, (missing, table, other) in _REFERENCES.items():
        if table in tables and other in tables:
            failing = missing(tables[table], tables[other]).agg(F.count("*").alias("failing"))
            counts.append(failing.select(F.lit(name).alias("check_name"), "failing"))
            described.append((name, table, None, "reference"))
    # The descriptions are literals of the program, not data: a lookup by name within each row.
    about = F.create_map(
        *[
            part
            for name, table, column, kind in described
            for part in (
                F.lit(name),
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(column).cast("string").alias("column_name"),
                    F.lit(kind).alias("kind"),
                    F.lit(severities.get(name, severities.get("*", WARN))).alias("severity"),
                ),
            )
        ]
    )
    found = reduce(DataFrame.unionByName, counts).withColumn("about", about[F.col("check_name")])
    return found.select(
        "check_name",
        "about.table_name",
        "about.column_name",
        "about.kind",
        "failing",
        "about.severity",
    ).withColumn("status", outcome(F.col("severity"), F.col("failing")))


class ChecksFailed(ValueError):
    """A check of severity ``error`` has failures."""


def raise_on_failures(report: DataFrame) -> None:
    failed = report.where(F.col("severity") == ERROR).where("failing > 0").collect()
    if failed:
        raise ChecksFailed(", ".join(f"{r.check_name} ({r.failing})" for r in failed))
