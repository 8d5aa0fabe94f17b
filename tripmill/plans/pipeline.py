"""The whole pipeline: landed pages to published tables, checks and run log."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators import runlog
from tripmill.operators.conform import new_batch_id
from tripmill.operators.gates import gate, require_passed
from tripmill.operators.runlog import RunLog
from tripmill.plans import gold
from tripmill.plans.bronze import bronze_of
from tripmill.plans.checks import raise_on_failures, run_checks
from tripmill.plans.counted import (
    NULL_CRITICAL,
    ROWS,
    known_counts,
    observed_bronze,
    observed_silver,
    record,
)
from tripmill.plans.silver import derived, latest_valid, without_malformed_times
from tripmill.plans.state import advance_state, silver_of
from tripmill.schema import (
    BRONZE_TRIPS,
    GOLD_DAILY,
    GOLD_HEATMAP,
    GOLD_PAYMENT,
    GOLD_ROLLUP,
    RUN_LOG,
    SILVER_TRIPS,
    TRIP_STATE,
)
from tripmill.sources.feed import PAGE_SIZE
from tripmill.sources.landing import Landing
from tripmill.sources.warehouse import Warehouse, utc_now

DAG_ID = "trip_pipeline"
TASK_ID = "full_pipeline"

# Orders in which the public views of two gold tables read.
HEATMAP_ORDER = ("day_of_week_num", "pickup_hour")
PAYMENT_ORDER = ("trip_count DESC", "payment_type_label", "payment_type_code")


@dataclass(frozen=True)
class PipelineResult:
    run_id: int
    batch_id: str
    rows_ingested: int
    report: DataFrame
    pages_left_out: int = 0


# Columns of silver that queries filter or group by; their statistics size such queries' plans.
SILVER_STATISTICS = (
    "trip_id",
    "pickup_date",
    "pickup_datetime",
    "pickup_hour",
    "vendor_id",
    "payment_type_code",
    "payment_type_label",
    "batch_id",
    "total_amount",
)
# Silver is looked up by trip as well as by time: files carry a Bloom filter of the trip ids.
SILVER_OPTIONS = {"parquet.bloom.filter.enabled#trip_id": "true"}


def build_silver(
    warehouse: Warehouse,
    version: int,
    set_malformed_times_aside: bool = False,
    statistics: Sequence[str] | str = SILVER_STATISTICS,
) -> DataFrame:
    """Rebuild silver from all of bronze, without a state, laid out by pickup date and time.

    The layout shuffles parsed columns; keys, measures and calendar parts are derived after it.
    """
    bronze = warehouse.bronze()
    if set_malformed_times_aside:
        bronze = without_malformed_times(bronze)
    dated = latest_valid(bronze).withColumn("pickup_date", F.to_date("pickup_datetime"))
    laid_out = dated.hint("rebalance", "pickup_date").sortWithinPartitions("pickup_datetime")
    return warehouse.publish(
        derived(laid_out), SILVER_TRIPS, version, statistics=statistics, options=SILVER_OPTIONS
    )


def update_silver(
    warehouse: Warehouse,
    version: int,
    also: Sequence[str] = (),
    buckets: int | None = None,
    from_scratch: bool = False,
    set_malformed_times_aside: bool = False,
    statistics: Sequence[str] | str = SILVER_STATISTICS,
) -> DataFrame:
    """Publish silver with the batches that it lacks, by way of the trip state; its row checks are counted on the way.

    Nothing that is stored is shuffled: state and silver stay in the state's buckets, each in order of
    pickup. See ``advance_state`` for the arguments.
    """
    state = advance_state(warehouse, version, also, buckets, from_scratch, set_malformed_times_aside)
    number = warehouse.buckets_of(TRIP_STATE, warehouse.version_of(TRIP_STATE))
    observed = observed_silver(silver_of(state))
    silver = warehouse.publish(
        observed.df,
        SILVER_TRIPS,
        version,
        sort_by=("pickup_datetime",),
        statistics=statistics,
        buckets=(number, "trip_id"),
        options=SILVER_OPTIONS,
    )
    record(warehouse, SILVER_TRIPS, version, observed.counts)
    return silver


def build_gold(warehouse: Warehouse, version: int, now: datetime) -> None:
    """Rebuild the gold tables. Silver is read once, for the rollup; the tables merge that."""
    rollup = warehouse.publish(
        gold.trip_rollup(warehouse.read(SILVER_TRIPS)), GOLD_ROLLUP, version
    )
    tables = [
        (gold.daily_from_rollup(rollup, now), GOLD_DAILY, ()),
        (gold.heatmap_from_rollup(rollup, now), GOLD_HEATMAP, HEATMAP_ORDER),
        (gold.payment_from_rollup(rollup, now), GOLD_PAYMENT, PAYMENT_ORDER),
    ]
    # Independent small jobs, submitted side by side.
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = [
            pool.submit(warehouse.publish, df, name, version, order_by=order)
            for df, name, order in tables
        ]
        for job in jobs:
            job.result()


def check_warehouse(
    warehouse: Warehouse, severities: Mapping[str, str] | None = None
) -> DataFrame:
    """Check report of the published tables; rows whose checks were counted as they were written are not read."""
    names = (BRONZE_TRIPS, GOLD_DAILY, GOLD_HEATMAP, GOLD_PAYMENT, RUN_LOG)
    tables = {name: warehouse.read(name) for name in names}
    # Silver as stored: what its view does not show to the planner is that it stands in buckets.
    tables[SILVER_TRIPS] = warehouse.stored(SILVER_TRIPS, warehouse.version_of(SILVER_TRIPS))
    return run_checks(tables, severities, known_counts(warehouse))


def run_pipeline(
    warehouse: Warehouse,
    landing: Landing | str,
    day: str,
    source_url: str,
    batch_id: str | None = None,
    severities: Mapping[str, str] | None = None,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    stop_at_short_page: bool = False,
    set_malformed_times_aside: bool = False,
    clock: Callable[[], datetime] = utc_now,
    buckets: int | None = None,
    from_scratch: bool = False,
) -> PipelineResult:
    """Ingest one landed extract and bring everything up to it.

    All landed pages are ingested; pages that ``max_pages`` or ``stop_at_short_page`` leave out are counted
    in the result and in the run log, with a warning. (A ``Landing`` brings these options and the page size with
    it.) Silver is brought up to date by the batches it lacks, or built from all of bronze if ``from_scratch``;
    both give the same rows. The run is logged as failed if any stage raises, with the error's text; the error is
    raised on, also if logging it fails. A malformed time is an error unless ``set_malformed_times_aside``:
    then silver lacks those rows.
    """
    warehouse.create()
    log = RunLog(warehouse)
    batch_id = batch_id or new_batch_id(day)
    run_id = log.open(DAG_ID, TASK_ID, day, clock())
    rows = left_out = 0
    try:
        if isinstance(landing, str):
            landing = Landing(warehouse.spark, landing, page_size, max_pages, stop_at_short_page)
        left_out = landing.left_out()
        if left_out:
            warnings.warn(f"{left_out} landed pages are left out", stacklevel=2)
        landed = observed_bronze(bronze_of(landing, run_id, batch_id, clock(), source_url))
        warehouse.append(landed.df, BRONZE_TRIPS)
        counts = landed.counts
        rows = counts[ROWS]
        log.mark_ingested(run_id, rows)
        record(warehouse, BRONZE_TRIPS, run_id, counts, batch_id)
        require_passed(gate(batch_id, rows, counts[NULL_CRITICAL]))
        update_silver(warehouse, run_id, (batch_id,), buckets, from_scratch, set_malformed_times_aside)
        build_gold(warehouse, run_id, clock())
        report = warehouse.publish(check_warehouse(warehouse, severities), "metadata.checks", run_id)
        raise_on_failures(report)
    except Exception as error:
        try:
            log.close(run_id, runlog.FAILED, rows, clock(), f"{type(error).__name__}: {error}")
        except Exception as log_error:
            error.add_note(f"the run could not be logged as failed: {log_error}")
        raise
    note = f"{left_out} landed pages were left out" if left_out else None
    log.close(run_id, runlog.SUCCESS, rows, clock(), note)
    return PipelineResult(run_id, batch_id, rows, report, left_out)
