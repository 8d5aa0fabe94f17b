"""Table contracts: every table's columns, in order, with their Spark types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layers and public table names.
LAYERS = ("bronze", "silver", "gold", "metadata")
BRONZE_TRIPS = "bronze.raw_taxi_trips"
SILVER_TRIPS = "silver.cleaned_taxi_trips"
GOLD_DAILY = "gold.daily_trip_summary"
GOLD_HEATMAP = "gold.hourly_demand_heatmap"
GOLD_PAYMENT = "gold.payment_analysis"
RUN_LOG = "metadata.pipeline_runs"

# Tables of our own.
RUN_LOG_EVENTS = "metadata.pipeline_run_events"
GOLD_ROLLUP = "gold.trip_rollup"
TRIP_STATE = "silver.trip_state"
TRIP_STATE_BATCHES = "metadata.trip_state_batches"
CHECK_COUNTS = "metadata.check_counts"
READ_LEASES = "metadata.read_leases"
TAKEN_PAGES = "metadata.taken_pages"

# Key of a feed record -> bronze column.
FEED_COLUMNS = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "tpep_pickup_datetime",
    "tpep_dropoff_datetime": "tpep_dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee",
}

# Payment code text -> label; any other text is DEFAULT_PAYMENT_LABEL.
PAYMENT_LABELS = {
    "1": "Credit Card",
    "2": "Cash",
    "3": "No Charge",
    "4": "Dispute",
    "5": "Unknown",
    "6": "Voided Trip",
}
DEFAULT_PAYMENT_LABEL = "Other"

# Vendor id -> name; any other id is DEFAULT_VENDOR_NAME.
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
}
DEFAULT_VENDOR_NAME = "Unknown Vendor"

# A ratio keeps 16 decimal places, as unconstrained NUMERIC division does at least.
RATIO = "decimal(28,16)"
AMOUNT = "decimal(10,2)"
TOTAL = "decimal(30,2)"
MEAN = "decimal(20,2)"
RATE = "decimal(20,4)"


_TYPES = {
    t.simpleString(): t
    for t in (
        T.StringType(),
        T.IntegerType(),
        T.LongType(),
        T.DateType(),
        T.TimestampNTZType(),
        T.DecimalType(28, 16),
        T.DecimalType(10, 2),
        T.DecimalType(30, 2),
        T.DecimalType(20, 2),
        T.DecimalType(20, 4),
    )
}


def _table(*columns: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in columns])


# All feed values stay text, and record keys match by exact case.
FEED_RECORD = _table(*[(key, "string") for key in FEED_COLUMNS])

BRONZE = _table(
    ("ingestion_id", "bigint"),
    *[(column, "string") for column in FEED_COLUMNS.values()],
    ("source_url", "string"),
    ("ingested_at", "timestamp_ntz"),
    ("batch_id", "string"),
    ("pipeline_run_id", "int"),
)

SILVER = _table(
    ("trip_id", "string"),
    ("ingestion_id", "bigint"),
    ("batch_id", "string"),
    ("ingested_at", "timestamp_ntz"),
    ("vendor_id", "int"),
    ("pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "timestamp_ntz"),
    ("pickup_date", "date"),
    ("pickup_hour", "bigint"),
    ("pickup_day_of_week", "string"),
    ("pickup_month", "bigint"),
    ("pickup_year", "bigint"),
    ("passenger_count", "int"),
    ("trip_distance_miles", AMOUNT),
    ("pickup_location_id", "int"),
    ("dropoff_location_id", "int"),
    ("rate_code_id", "int"),
    ("store_and_fwd_flag", "string"),
    ("payment_type_code", "int"),
    ("payment_type_label", "string"),
    ("fare_amount", AMOUNT),
    ("extra", AMOUNT),
    ("mta_tax", AMOUNT),
    ("tip_amount", AMOUNT),
    ("tolls_amount", AMOUNT),
    ("improvement_surcharge", AMOUNT),
    ("congestion_surcharge", AMOUNT),
    ("airport_fee", AMOUNT),
    ("total_amount", AMOUNT),
    ("trip_duration_mins", RATIO),
    ("avg_speed_mph", RATIO),
    ("cost_per_mile", RATIO),
    ("tip_percentage", RATIO),
)

DAILY = _table(
    ("summary_id", "string"),
    ("pickup_date", "date"),
    ("pickup_year", "bigint"),
    ("pickup_month", "bigint"),
    ("month_name", "string"),
    ("day_of_week", "string"),
    ("vendor_id", "int"),
    ("vendor_name", "string"),
    ("payment_type_label", "string"),
    ("total_trips", "bigint"),
    ("total_passengers", "bigint"),
    ("total_revenue", TOTAL),
    ("avg_fare_per_trip", MEAN),
    ("total_base_fare", TOTAL),
    ("total_tips", TOTAL),
    ("avg_tip_rate", RATE),
    ("total_tolls", TOTAL),
    ("total_congestion_surcharge", TOTAL),
    ("total_distance_miles", TOTAL),
    ("avg_distance_miles", MEAN),
    ("avg_duration_mins", MEAN),
    ("total_duration_mins", TOTAL),
    ("avg_speed_mph", MEAN),
    ("avg_cost_per_mile", MEAN),
    ("peak_pickup_hour", "bigint"),
    ("last_updated_at", "timestamp_ntz"),
)

HEATMAP = _table(
    ("pickup_hour", "bigint"),
    ("pickup_day_of_week", "string"),
    ("day_of_week_num", "int"),
    ("trip_count", "bigint"),
    ("avg_fare", MEAN),
    ("avg_distance", MEAN),
    ("avg_duration_mins", MEAN),
    ("total_revenue", TOTAL),
    ("last_updated_at", "timestamp_ntz"),
)

PAYMENT = _table(
    ("payment_type_code", "int"),
    ("payment_type_label", "string"),
    ("trip_count", "bigint"),
    ("total_revenue", TOTAL),
    ("avg_fare", MEAN),
    ("total_tips", TOTAL),
    ("avg_tip", MEAN),
    ("avg_tip_rate", RATE),
    ("tipped_trips", "bigint"),
    ("avg_distance", MEAN),
    ("avg_duration_mins", MEAN),
    ("pct_of_total_trips", MEAN),
    ("pct_of_total_revenue", MEAN),
    ("tip_frequency_pct", MEAN),
    ("last_updated_at", "timestamp_ntz"),
)

RUNS = _table(
    ("run_id", "int"),
    ("dag_id", "string"),
    ("task_id", "string"),
    ("execution_date", "timestamp_ntz"),
    ("status", "string"),
    ("rows_ingested", "bigint"),
    ("rows_inserted", "bigint"),
    ("rows_updated", "bigint"),
    ("error_message", "string"),
    ("started_at", "timestamp_ntz"),
    ("completed_at", "timestamp_ntz"),
    ("duration_secs", AMOUNT),
)

# Run-log rows are never changed: a run is the set of its events.
RUN_EVENTS = T.StructType([T.StructField("event_seq", T.IntegerType(), True), *RUNS.fields])

# Longest text each bronze column may hold.
BRONZE_TEXT_LIMITS = {
    "vendor_id": 10,
    "tpep_pickup_datetime": 50,
    "tpep_dropoff_datetime": 50,
    "passenger_count": 10,
    "trip_distance": 20,
    "rate_code_id": 10,
    "store_and_fwd_flag": 5,
    "pu_location_id": 10,
    "do_location_id": 10,
    "payment_type": 10,
    "fare_amount": 20,
    "extra": 20,
    "mta_tax": 20,
    "tip_amount": 20,
    "tolls_amount": 20,
    "improvement_surcharge": 20,
    "total_amount": 20,
    "congestion_surcharge": 20,
    "airport_fee": 20,
    "batch_id": 100,
}


def as_table(df: DataFrame, table: T.StructType) -> DataFrame:
    """Project ``df`` to exactly the columns of ``table``, in its order and types."""
    have = dict(df.dtypes)
    return df.select(
        *[
            F.col(f.name)
            if have[f.name] == f.dataType.simpleString()
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in table.fields
        ]
    )
