"""Checks, gates and run log on literal rows, failing cases included."""

from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripmill.operators import runlog
from tripmill.operators.gates import BatchRejected, batch_counts, validate_batch
from tripmill.operators.quality import (
    ACCEPTED,
    EXPRESSION,
    NOT_NULL,
    UNIQUE,
    Check,
    check_table,
    duplicates,
    missing_from,
    over_long,
)
from tripmill.plans import checks
from tripmill.plans.checks import COLUMN_CHECKS, ChecksFailed, raise_on_failures, run_checks
from tripmill.plans.gold import daily_trip_summary
from tripmill.plans.silver import clean
from tripmill.schema import (
    BRONZE_TEXT_LIMITS,
    BRONZE_TRIPS,
    GOLD_DAILY,
    RUN_EVENTS,
    RUN_LOG,
    SILVER_TRIPS,
)


def failing(report):
    return {r.check_name: r.failing for r in report.collect()}


def test_declared_checks():
    assert Counter(c.table for c in COLUMN_CHECKS) == {
        "bronze.raw_taxi_trips": 8,
        "silver.cleaned_taxi_trips": 18,
        "gold.daily_trip_summary": 14,
        "gold.hourly_demand_heatmap": 4,
        "gold.payment_analysis": 4,
    }
    assert Counter(c.kind for c in COLUMN_CHECKS) == {
        NOT_NULL: 28, UNIQUE: 4, ACCEPTED: 3, EXPRESSION: 13,
    }


def test_each_kind_of_check(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (2, None), (None, "c"), (None, "z"), (-3, "z")],
        "n int, s string",
    )
    some = [
        Check("t", "n", NOT_NULL),
        Check("t", "n", UNIQUE),
        Check("t", "s", UNIQUE),
        Check("t", "n", EXPRESSION, rule="> 0"),
        Check("t", "s", ACCEPTED, values=("a", "b", "c")),
        Check("t", "n", ACCEPTED, values=(1, 2)),
    ]
    assert failing(check_table(df, some)) == {
        "not_null:t.n": 2,
        "unique:t.n": 2,
        "unique:t.s": 2,
        "expression:t.n > 0": 1,
        "accepted_values:t.s": 1,
        "accepted_values:t.n": 1,
    }
    assert {(r.value, r.n) for r in duplicates(df, "s").collect()} == {("c", 2), ("z", 2)}


def test_checks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "n int")
    some = [Check("t", "n", k, values=(1,)) for k in (NOT_NULL, UNIQUE, ACCEPTED)]
    assert set(failing(check_table(df, some)).values()) == {0}


def test_missing_from_ignores_null(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    assert [r.k for r in missing_from(df, other, "k").collect()] == [1]


def test_over_long(spark):
    df = spark.createDataFrame([("12345",), ("1",), (None,)], "c string")
    assert list(failing(over_long(df, {"c": 4})).values()) == [1]


def test_report_on_broken_tables(spark, bronze, raw_row):
    raw = bronze([raw_row(), raw_row(total_amount="31"), raw_row(total_amount="32", vendor_id="x",
                                                                 pipeline_run_id=2)])
    silver = clean(raw)
    broken = silver.withColumn("total_amount", F.lit(5).cast("decimal(10,2)")).unionByName(
        silver.where("vendor_id IS NULL").withColumns(
            {"dropoff_datetime": F.col("pickup_datetime"), "vendor_id": F.lit(7)}
        )
    )
    runs = spark.createDataFrame([(1,)], "run_id int")
    tables = {
        BRONZE_TRIPS: raw,
        SILVER_TRIPS: broken,
        GOLD_DAILY: daily_trip_summary(silver).where("false"),
        RUN_LOG: runs,
    }
    report = run_checks(tables, {"total_gte_fare": "error"}).cache()
    bad = {r.check_name: (r.failing, r.status) for r in report.where("failing > 0").collect()}
    assert bad == {
        "not_null:silver.cleaned_taxi_trips.vendor_id": (1, "warn"),
        "unique:silver.cleaned_taxi_trips.trip_id": (1, "warn"),
        "accepted_values:silver.cleaned_taxi_trips.vendor_id": (1, "warn"),
        "dropoff_after_pickup": (1, "warn"),
        "total_gte_fare": (3, "fail"),
        "gold_coverage": (1, "warn"),
        "run_reference": (1, "warn"),
    }
    declared = {c.name for t in tables for c in checks.checks_of(t)}
    limits = {f"text_limit_{c}" for c in BRONZE_TEXT_LIMITS}
    others = {"dropoff_after_pickup", "total_gte_fare", "gold_coverage", "run_reference"}
    assert {r.check_name for r in report.collect()} == declared | limits | others
    assert report.count() == len(declared) + len(limits) + len(others)
    with pytest.raises(ChecksFailed, match="total_gte_fare"):
        raise_on_failures(report)
    raise_on_failures(report.where("check_name <> 'total_gte_fare'"))
    report.unpersist()


def test_severity_of_all_checks_can_be_raised(bronze, raw_row):
    tables = {BRONZE_TRIPS: bronze([raw_row(vendor_id=None)])}
    assert {r.status for r in run_checks(tables).collect()} == {"pass", "warn"}
    assert {r.status for r in run_checks(tables, {"*": "error"}).collect()} == {"pass", "fail"}


def test_singular_checks_show_rows(spark, bronze, raw_row):
    silver = clean(bronze([raw_row()]))
    bad = silver.withColumn("trip_duration_mins", F.lit(-1).cast("decimal(28,16)"))
    assert checks.dropoff_after_pickup(bad).columns == [
        "trip_id", "pickup_datetime", "dropoff_datetime", "trip_duration_mins",
    ]
    assert checks.dropoff_after_pickup(bad).count() == 1
    assert checks.total_gte_fare(silver).columns == [
        "trip_id", "fare_amount", "total_amount", "tip_amount", "tolls_amount",
    ]
    assert checks.total_gte_fare(silver).count() == 0


def test_gate_bounds(bronze, raw_row):
    lost = {"total_amount": None, "batch_id": "edge"}
    edge = [raw_row(batch_id="edge") for _ in range(9)] + [raw_row(**lost)]
    over = [raw_row(batch_id="over") for _ in range(9)]
    over += [raw_row(batch_id="over", tpep_pickup_datetime=None) for _ in range(2)]
    raw = bronze(edge + over)
    validate_batch(raw, "edge")
    with pytest.raises(BatchRejected, match="2 of 11"):
        validate_batch(raw, "over")
    with pytest.raises(BatchRejected, match="no rows"):
        validate_batch(raw, "absent")
    counts = batch_counts(raw, "absent").first()
    assert (counts.row_count, counts.null_critical_count, counts.passed) == (0, 0, False)


def test_run_log_folds_events(spark):
    at = datetime(2024, 1, 1, 12)
    events = runlog.open_event(spark, 1, "d", "t", "2024-01-01", at)
    state = runlog.current_state(events).first()
    assert (state.status, state.rows_ingested, state.started_at) == ("running", 0, at)
    assert state.completed_at is None and state.execution_date == datetime(2024, 1, 1)

    events = events.unionByName(runlog.ingested_event(spark, 1, 42))
    state = runlog.current_state(events).first()
    assert (state.status, state.rows_ingested, state.dag_id) == ("ingested", 42, "d")

    end = datetime(2024, 1, 1, 12, 1, 1, 235_000)
    closed = runlog.close_event(events, 1, "failed", 42, end, "boom")
    state = runlog.current_state(events.unionByName(closed)).first()
    assert (state.status, state.error_message, state.completed_at) == ("failed", "boom", end)
    assert state.duration_secs == Decimal("61.24")
    assert runlog.close_event(events, 9, "success", 0, end).count() == 0


def test_run_ids_and_latest_runs(spark):
    none = spark.createDataFrame([], RUN_EVENTS)
    assert runlog.next_run_id(none) == 1
    at = datetime(2024, 1, 1)
    events = none
    for run in range(1, 8):
        events = events.unionByName(runlog.open_event(spark, run, "d", "t", "2024-01-01", at))
    assert runlog.next_run_id(events) == 8
    latest = runlog.latest_runs(runlog.current_state(events)).collect()
    assert [r.run_id for r in latest] == [7, 6, 5, 4, 3]
