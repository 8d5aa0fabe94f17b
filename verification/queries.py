"""Every operator as a query on the given tables.

Input is the raw-trip fixture made from ``events``. Decimals are shown as doubles and times as text,
so that results compare by value with another engine's.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.fixtures import raw_trips
from tripmill.functions import calendar
from tripmill.functions.keys import surrogate_key
from tripmill.functions.labels import vendor_name
from tripmill.operators.conform import to_bronze
from tripmill.operators.dedupe import TRIP_KEY, latest_per_key
from tripmill.operators.filters import business_rules, required_present
from tripmill.operators.gates import all_batch_counts, batch_counts
from tripmill.operators.quality import (
    ACCEPTED,
    EXPRESSION,
    NOT_NULL,
    UNIQUE,
    check_table,
    over_long,
)
from tripmill.operators.runlog import (
    close_event,
    current_state,
    ingested_event,
    latest_runs,
    open_event,
)
from tripmill.plans import checks, gold
from tripmill.plans.silver import (
    clean,
    enriched,
    malformed_times,
    typed,
    typed_columns,
    without_malformed_times,
)
from tripmill.schema import (
    AMOUNT,
    BRONZE_TEXT_LIMITS,
    BRONZE_TRIPS,
    FEED_COLUMNS,
    GOLD_DAILY,
    GOLD_HEATMAP,
    GOLD_PAYMENT,
    RATIO,
    RUN_EVENTS,
    RUN_LOG,
    SILVER_TRIPS,
    as_table,
)
from tripmill.sources.feed import newest, page_slice, pages_to_last, records

from verification import stored
from verification.damage import damaged

RATIOS = ("trip_duration_mins", "avg_speed_mph", "cost_per_mile", "tip_percentage")

# Landed pages of the fixture: a thousand events each, every tenth of them delivered twice.
EVENTS_PER_PAGE = 1000
PAGE_ROWS = 1100
REDELIVERED = 1_000_000_000

CHECKED_TABLES = (BRONZE_TRIPS, SILVER_TRIPS, GOLD_DAILY, GOLD_HEATMAP, GOLD_PAYMENT)

RUN_ID = 7
INGESTED_AT = datetime(2024, 2, 3, 4, 5, 6)


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name in RATIOS and field.dataType.simpleString() == RATIO:
            c = F.round(c, 6).cast("double")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            c = c.cast("string")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_trips(spark, sf_dir))


def with_lost_fields(raw: DataFrame) -> DataFrame:
    """Raw trips in which batches of odd days lack every fifth total, and some times are garbled."""
    odd_day = F.expr("try_cast(right(batch_id, 2) AS int) % 2 = 1")
    garbled = (F.col("ingestion_id") % 31 == 0) & F.col("tpep_dropoff_datetime").isNotNull()
    return raw.withColumns(
        {
            "total_amount": F.when(
                ~F.coalesce(odd_day & (F.col("ingestion_id") % 5 == 0), F.lit(False)),
                F.col("total_amount"),
            ),
            "tpep_dropoff_datetime": F.when(garbled, F.lit("31/12/2023 25:00")).otherwise(
                F.col("tpep_dropoff_datetime")
            ),
        }
    )


def with_over_long(raw: DataFrame) -> DataFrame:
    """Raw trips in which some texts are one character longer than their column may hold."""
    columns = {}
    for k, (name, limit) in enumerate(BRONZE_TEXT_LIMITS.items()):
        chosen = F.col(name).isNotNull() & (F.col("ingestion_id") % 107 == k)
        columns[name] = F.when(chosen, F.repeat(F.lit("9"), limit + 1)).otherwise(F.col(name))
    return raw.withColumns(columns)


def broken(trips: DataFrame) -> DataFrame:
    """Silver rows with totals below fares, times swapped, and rows there twice."""
    i = F.col("ingestion_id")
    swapped = i % 101 == 0
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    bad = trips.withColumns(
        {
            "total_amount": F.when(
                i % 99 == 0, (F.col("fare_amount") * F.lit(0.5).cast("decimal(2,1)")).cast(AMOUNT)
            ).otherwise(F.col("total_amount")),
            "pickup_datetime": F.when(swapped, dropoff).otherwise(pickup),
            "dropoff_datetime": F.when(swapped, pickup).otherwise(dropoff),
            "trip_duration_mins": F.when(swapped, -F.col("trip_duration_mins")).otherwise(
                F.col("trip_duration_mins")
            ),
        }
    )
    copies = F.when(i % 103 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return bad.withColumn("copy", F.explode(copies)).drop("copy")


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture as JSON pages in feed order: ``(page, body)``."""
    event_id = F.col("ingestion_id") % REDELIVERED
    record = F.struct(*[F.col(c).alias(key) for key, c in FEED_COLUMNS.items()])
    rows = raw_trips(spark, sf_dir).select(
        F.floor(event_id / EVENTS_PER_PAGE).alias("page"),
        F.struct(event_id.alias("event_id"), "ingestion_id", record.alias("record")).alias("row"),
    )
    # Event ids are unique, so a page is never longer than PAGE_ROWS.
    in_order = F.sort_array(F.collect_list("row"))
    return rows.groupBy("page").agg(F.to_json(in_order["record"]).alias("body"))


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(pages_to_last(landed_pages(spark, sf_dir), PAGE_ROWS, max_pages=None))


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(
        landed_records(spark, sf_dir),
        "fixture://events",
        "batch_fixture",
        RUN_ID,
        INGESTED_AT,
        PAGE_ROWS,
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log in which three events in a row make a run: opened, ingested, closed."""
    step = F.col("event_id") % 3
    started = F.col("ts").cast("timestamp_ntz")
    status = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    columns = {
        "event_seq": step,
        "run_id": F.floor(F.col("event_id") / 3) + 1,
        "dag_id": F.when(step == 0, "trip_pipeline"),
        "task_id": F.when(step == 0, F.col("event_type")),
        "execution_date": F.when(step == 0, F.to_date("ts")),
        "status": F.when(step == 0, "running").when(step == 1, "ingested").otherwise(status),
        "rows_ingested": F.when(step == 0, 0).otherwise(F.col("user_id")),
        "rows_inserted": F.when(step == 0, 0),
        "rows_updated": F.when(step == 0, 0),
        "error_message": F.when((step == 2) & (F.col("event_type") == "error"), F.col("props")),
        "started_at": F.when(step == 0, started),
        "completed_at": F.when(step == 2, started),
        "duration_secs": F.when(step == 2, F.col("value")),
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return as_table(events.select(*[c.alias(n) for n, c in columns.items()]), RUN_EVENTS)


def broken_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named tables for the checks: gold is sound but lacks a day, silver is broken, raw rows
    lack fields, run 2 is unknown.

    Silver is worked out once, on the executors, for its checks and the three gold tables made from it.
    """
    trips = silver(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    made = {
        BRONZE_TRIPS: lambda: with_over_long(with_lost_fields(raw_trips(spark, sf_dir))),
        SILVER_TRIPS: lambda: broken(trips),
        GOLD_DAILY: lambda: gold.daily_trip_summary(trips).where("day(pickup_date) <> 7"),
        GOLD_HEATMAP: lambda: gold.hourly_demand_heatmap(trips),
        GOLD_PAYMENT: lambda: gold.payment_analysis(trips),
        RUN_LOG: lambda: current_state(run_events(spark, sf_dir)).where("run_id <> 2"),
    }
    return {name: made[name]() for name in names}


def damaged_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """``broken_tables`` in which every check finds something."""
    made = broken_tables(spark, sf_dir, *names)
    return {name: damaged(df, name) if name in CHECKED_TABLES else df for name, df in made.items()}


def _columns_of_raw(names: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        parsed = typed_columns()
        return raw_trips(spark, sf_dir).select(
            "ingestion_id", *[parsed[name].alias(name) for name in names]
        )

    return query


def _column_checks(*kinds: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        declared = {t: checks.checks_of(t, *kinds) for t in CHECKED_TABLES}
        tables = damaged_tables(spark, sf_dir, *[t for t, some in declared.items() if some])
        found = [check_table(df, declared[table]) for table, df in tables.items()]
        return reduce(DataFrame.unionByName, found)

    return query


def newest_trips_topn(spark, sf_dir):
    top = newest(raw_trips(spark, sf_dir), "tpep_pickup_datetime", "ingestion_id", 10_000)
    return top.select("ingestion_id", "tpep_pickup_datetime", "total_amount")


def feed_page_slice(spark, sf_dir):
    raw = raw_trips(spark, sf_dir).select("ingestion_id", "tpep_pickup_datetime", "total_amount")
    return page_slice(raw, "tpep_pickup_datetime", "ingestion_id", page=3)


def identity_order(spark, sf_dir):
    rows = ingested(spark, sf_dir)
    return rows.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("ingestion_id").alias("distinct_ids"),
        F.min("ingestion_id").alias("first_id"),
        F.max("ingestion_id").alias("last_id"),
    )


def vendor_names(spark, sf_dir):
    parsed = typed_columns()["vendor_id"]
    return raw_trips(spark, sf_dir).select(
        "ingestion_id", parsed.alias("vendor_id"), vendor_name(parsed).alias("vendor_name")
    )


def trip_metrics(spark, sf_dir):
    return enriched(typed(raw_trips(spark, sf_dir))).select("ingestion_id", *RATIOS)


def calendar_parts(spark, sf_dir):
    return enriched(typed(raw_trips(spark, sf_dir))).select(
        "ingestion_id",
        "pickup_date",
        "pickup_hour",
        "pickup_day_of_week",
        "pickup_month",
        "pickup_year",
        calendar.weekday_number(F.col("pickup_datetime")).alias("day_of_week_num"),
    )


def month_day_names(spark, sf_dir):
    day = F.to_date("o_orderdate")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return (
        orders.groupBy(day.alias("order_date"))
        .agg(F.count("*").alias("order_count"))
        .select(
            "order_date",
            calendar.month_name(F.col("order_date")).alias("month_name"),
            calendar.day_name(F.col("order_date")).alias("day_of_week"),
            calendar.weekday_number(F.col("order_date")).alias("day_of_week_num"),
            "order_count",
        )
    )


def surrogate_keys(spark, sf_dir):
    return typed(raw_trips(spark, sf_dir)).select(
        "ingestion_id", surrogate_key(*[F.col(c) for c in TRIP_KEY]).alias("trip_id")
    )


def required_filter(spark, sf_dir):
    kept = required_present(with_lost_fields(raw_trips(spark, sf_dir)))
    return kept.select(
        "ingestion_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount"
    )


def business_filter(spark, sf_dir):
    kept = typed(raw_trips(spark, sf_dir)).where(business_rules())
    return kept.select(
        "ingestion_id", "fare_amount", "trip_distance_miles", "passenger_count", "total_amount"
    )


def timestamp_rejects(spark, sf_dir):
    raw = with_lost_fields(raw_trips(spark, sf_dir))
    sides = {"rejected": malformed_times(raw), "kept": without_malformed_times(raw)}
    parts = [
        df.select("ingestion_id", "tpep_dropoff_datetime", F.lit(side).alias("side"))
        for side, df in sides.items()
    ]
    return parts[0].unionByName(parts[1])


def dedupe_latest(spark, sf_dir):
    return latest_per_key(typed(raw_trips(spark, sf_dir))).select(*TRIP_KEY, "ingestion_id")


def trip_rollup(spark, sf_dir):
    measures = (*gold.COUNTS, *gold.SUMS)
    rollup = gold.trip_rollup(silver(spark, sf_dir))
    ratio_sums = ("tip_rate", "duration", "speed", "mile_cost")
    return rollup.select(
        *gold.ROLLUP_KEYS,
        *[F.round(m, 4).alias(m) if m in ratio_sums else F.col(m) for m in measures],
    )


def daily_trip_summary(spark, sf_dir):
    return gold.daily_trip_summary(silver(spark, sf_dir), INGESTED_AT)


def hourly_demand_heatmap(spark, sf_dir):
    return gold.hourly_demand_heatmap(silver(spark, sf_dir), INGESTED_AT)


def payment_analysis(spark, sf_dir):
    return gold.payment_analysis(silver(spark, sf_dir), INGESTED_AT)


def peak_hour_mode(spark, sf_dir):
    return gold.daily_trip_summary(silver(spark, sf_dir)).select(
        "pickup_date", "vendor_id", "payment_type_label", "peak_pickup_hour"
    )


def share_of_total(spark, sf_dir):
    return gold.payment_analysis(silver(spark, sf_dir)).select(
        "payment_type_code", "payment_type_label", "pct_of_total_trips", "pct_of_total_revenue"
    )


def tip_frequency(spark, sf_dir):
    return gold.payment_analysis(silver(spark, sf_dir)).select(
        "payment_type_code", "payment_type_label", "tipped_trips", "tip_frequency_pct"
    )


def batch_lookup(spark, sf_dir):
    raw = raw_trips(spark, sf_dir).where(F.col("batch_id") == "batch_2024-01-05")
    return raw.select("ingestion_id", "batch_id", "tpep_pickup_datetime", "ingested_at")


def batch_validation(spark, sf_dir):
    raw = with_lost_fields(raw_trips(spark, sf_dir))
    return all_batch_counts(raw).unionByName(batch_counts(raw, "batch_absent"))


def row_counts(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t, df in {BRONZE_TRIPS: raw, SILVER_TRIPS: clean(raw)}.items()
    ]
    return counts[0].unionByName(counts[1])


def dq_dropoff_after_pickup(spark, sf_dir):
    return checks.dropoff_after_pickup(broken(silver(spark, sf_dir)))


def dq_total_gte_fare(spark, sf_dir):
    return checks.total_gte_fare(broken(silver(spark, sf_dir)))


def dq_gold_coverage(spark, sf_dir):
    return checks.gold_coverage(*broken_tables(spark, sf_dir, SILVER_TRIPS, GOLD_DAILY).values())


def dq_referential(spark, sf_dir):
    return checks.run_reference(*broken_tables(spark, sf_dir, BRONZE_TRIPS, RUN_LOG).values())


def dq_text_limits(spark, sf_dir):
    tight = {c: min(n, 4) for c, n in BRONZE_TEXT_LIMITS.items()}
    return over_long(raw_trips(spark, sf_dir), tight)


def dq_report(spark, sf_dir):
    tables = damaged_tables(spark, sf_dir, *CHECKED_TABLES, RUN_LOG)
    report = checks.run_checks(tables, {checks.TOTAL_GTE_FARE: "error"})
    return report.select("check_name", "table_name", "failing", "severity", "status")


def run_log_state(spark, sf_dir):
    return current_state(run_events(spark, sf_dir))


def run_log_events(spark, sf_dir):
    """Runs opened, marked and closed by the package's own events, of more rows than 32 bits count."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    first = events.agg(F.min("event_id").alias("first"), F.max("event_id").alias("last")).first()
    made = []
    for run_id, rows in ((1, 3_000_000_000 + first.first), (2, 3_000_000_000 + first.last), (3, 5)):
        opened = open_event(spark, run_id, "d", "t", "2024-06-01", INGESTED_AT)
        marked = ingested_event(spark, run_id, rows)
        status, error = ("failed", "lost") if run_id == 2 else ("success", None)
        later = INGESTED_AT + timedelta(seconds=90, milliseconds=125)
        closed = close_event(opened, run_id, status, rows, later, error)
        made += [opened, marked] if run_id == 3 else [opened, marked, closed]
    return current_state(reduce(DataFrame.unionByName, made))


def latest_five_runs(spark, sf_dir):
    return latest_runs(current_state(run_events(spark, sf_dir)))


def landed_files(spark, sf_dir):
    return stored.landed_files(spark, landed_pages(spark, sf_dir))


def whole_run(spark, sf_dir):
    return stored.whole_run(spark, landed_pages(spark, sf_dir), PAGE_ROWS)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "newest_trips_topn": newest_trips_topn,
    "feed_page_slice": feed_page_slice,
    "feed_pages": landed_records,
    "conform_columns": ingested,
    "identity_order": identity_order,
    "safe_int_cast": _columns_of_raw(
        [
            "vendor_id",
            "passenger_count",
            "pickup_location_id",
            "dropoff_location_id",
            "rate_code_id",
            "payment_type_code",
        ]
    ),
    "safe_decimal_trimmed": _columns_of_raw(["trip_distance_miles"]),
    "safe_decimal_strict": _columns_of_raw(
        [
            "fare_amount",
            "extra",
            "mta_tax",
            "tip_amount",
            "tolls_amount",
            "improvement_surcharge",
            "congestion_surcharge",
            "airport_fee",
            "total_amount",
        ]
    ),
    "timestamp_parse": _columns_of_raw(["pickup_datetime", "dropoff_datetime"]),
    "timestamp_rejects": timestamp_rejects,
    "payment_label": _columns_of_raw(["store_and_fwd_flag", "payment_type_label"]),
    "vendor_name": vendor_names,
    "trip_metrics": trip_metrics,
    "calendar_parts": calendar_parts,
    "month_day_names": month_day_names,
    "surrogate_key": surrogate_keys,
    "required_filter": required_filter,
    "business_filter": business_filter,
    "dedupe_latest": dedupe_latest,
    "silver_trips": silver,
    "trip_rollup": trip_rollup,
    "daily_trip_summary": daily_trip_summary,
    "hourly_demand_heatmap": hourly_demand_heatmap,
    "payment_analysis": payment_analysis,
    "peak_hour_mode": peak_hour_mode,
    "share_of_total": share_of_total,
    "tip_frequency": tip_frequency,
    "batch_lookup": batch_lookup,
    "batch_validation": batch_validation,
    "row_counts": row_counts,
    "dq_not_null": _column_checks(NOT_NULL),
    "dq_unique": _column_checks(UNIQUE),
    "dq_accepted_values": _column_checks(ACCEPTED),
    "dq_expression": _column_checks(EXPRESSION),
    "dq_dropoff_after_pickup": dq_dropoff_after_pickup,
    "dq_total_gte_fare": dq_total_gte_fare,
    "dq_gold_coverage": dq_gold_coverage,
    "dq_referential": dq_referential,
    "dq_text_limits": dq_text_limits,
    "dq_report": dq_report,
    "run_log_state": run_log_state,
    "run_log_events": run_log_events,
    "latest_runs": latest_five_runs,
    "landed_files": landed_files,
    "stored_silver": stored.stored_silver,
    "stored_tables": stored.stored_tables,
    "stored_report": stored.stored_report,
    "whole_run": whole_run,
}


def _comparable(query):
    return lambda spark, sf_dir: comparable(query(spark, sf_dir))


QUERIES = {name: _comparable(query) for name, query in _QUERIES.items()}
