"""For each query, DuckDB SQL that must give the same rows.

Decimals are worked out in whole numbers (HUGEINT) and shown as doubles at the end, because DuckDB
divides decimals and averages them as doubles. ``E16`` below is ten to the sixteenth, the scale of a
stored ratio; every quotient is of non-negative numbers and rounded half up.
"""

from __future__ import annotations

from tripmill.schema import (
    BRONZE_TEXT_LIMITS,
    BRONZE_TRIPS,
    GOLD_DAILY,
    GOLD_HEATMAP,
    GOLD_PAYMENT,
    SILVER_TRIPS,
)
from verification.damage import damage_sql

E16 = "10000000000000000"


def _ratio(a: str, b: str) -> str:
    """a/b scaled by E16."""
    return f"((2 * CAST({a} AS HUGEINT) * {E16} + ({b})) // (2 * ({b})))"


def _six_places(scaled: str) -> str:
    return f"((2 * {scaled} + 10000000000) // 20000000000)::DOUBLE / 1000000"


def _mean(scaled: str, places: int = 2) -> str:
    """Mean over a group of values scaled by E16."""
    unit = 10 ** (16 - places)
    count = f"COUNT({scaled})"
    rounded = f"(2 * SUM({scaled}) + {count} * {unit}) // (2 * {count} * {unit})"
    return f"CASE WHEN {count} > 0 THEN ({rounded})::DOUBLE / {10**places} END"


def _sum(scaled: str, places: int = 2) -> str:
    unit = 10 ** (16 - places)
    return f"((2 * SUM({scaled}) + {unit}) // {2 * unit})::DOUBLE / {10**places}"


def _percent(a: str, b: str) -> str:
    return f"((2 * CAST({a} AS HUGEINT) * 10000 + ({b})) // (2 * ({b})))::DOUBLE / 100"


_RAW = """
deliveries AS (
    SELECT event_id, user_id, event_type, redo,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS started,
           CAST(value AS DECIMAL(10,2)) AS v,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events CROSS JOIN (VALUES (0), (1)) AS d(redo)
    WHERE redo = 0 OR event_id % 10 = 0
),
raw AS (
    SELECT event_id + redo * 1000000000 AS ingestion_id,
           ['1', '2', ' 1 ', '2.0', 'x'][user_id % 5 + 1] AS vendor_id,
           started AS tpep_pickup_datetime,
           CASE WHEN event_id % 97 <> 0
                THEN strftime(CAST(started AS TIMESTAMP) + to_minutes(k * 4), '%Y-%m-%d %H:%M:%S')
           END AS tpep_dropoff_datetime,
           CASE WHEN redo = 1 AND event_id % 20 = 0 THEN 'bad'
                WHEN user_id % 7 = 6 THEN '25'
                WHEN user_id % 7 = 0 THEN NULL
                ELSE (user_id % 7)::VARCHAR || CASE WHEN user_id % 2 = 0 THEN '.0' ELSE '' END
           END AS passenger_count,
           CASE event_id % 50 WHEN 3 THEN '-1.5' WHEN 7 THEN 'NaN'
                ELSE CAST(CAST(k AS DECIMAL(10,2)) * CAST(0.1 AS DECIMAL(2,1)) AS VARCHAR)
           END AS trip_distance,
           CASE user_id % 11 WHEN 10 THEN '99.0' WHEN 9 THEN NULL
                ELSE (user_id % 6 + 1)::VARCHAR END AS rate_code_id,
           CASE user_id % 4 WHEN 0 THEN ' Y ' ELSE 'N' END AS store_and_fwd_flag,
           (user_id + 1)::VARCHAR AS pu_location_id,
           (k + 100)::VARCHAR || CASE event_id % 2 WHEN 0 THEN '.0' ELSE '' END AS do_location_id,
           CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'purchase' THEN '3'
                WHEN 'signup' THEN '1.0' ELSE '9' END AS payment_type,
           CASE WHEN event_id % 41 = 0 THEN ' 5.00' WHEN event_id % 40 = 1 THEN '-' || v
                ELSE v::VARCHAR END AS fare_amount,
           CASE event_id % 2 WHEN 0 THEN '0.5' ELSE '1' END AS extra,
           '0.5' AS mta_tax,
           CASE WHEN event_id % 3 = 0 THEN '0' WHEN event_id % 43 = 0 THEN '.5'
                ELSE CAST(CAST(v * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS VARCHAR)
           END AS tip_amount,
           CASE event_id % 17 WHEN 0 THEN '6.55' ELSE '0' END AS tolls_amount,
           '0.3' AS improvement_surcharge,
           CAST(CAST(v * CAST(1.2 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS VARCHAR) AS total_amount,
           CASE WHEN event_id % 13 <> 0 THEN '2.5' END AS congestion_surcharge,
           CASE WHEN event_id % 23 = 0 THEN 'NaN' WHEN event_id % 19 = 0 THEN '1.25'
           END AS airport_fee,
           'fixture://events' AS source_url,
           CASE redo WHEN 1 THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01'
           END AS ingested_at,
           CASE redo WHEN 1 THEN 'batch_redo' ELSE 'batch_' || left(started, 10) END AS batch_id,
           CAST(1 + redo AS INTEGER) AS pipeline_run_id
    FROM deliveries
)"""

# The fixture with totals and times lost.
_LOST = """
lost AS (
    SELECT * REPLACE (
        CASE WHEN NOT coalesce(
                 TRY_CAST(right(batch_id, 2) AS INTEGER) % 2 = 1 AND ingestion_id % 5 = 0, FALSE)
             THEN total_amount END AS total_amount,
        CASE WHEN ingestion_id % 31 = 0 AND tpep_dropoff_datetime IS NOT NULL
             THEN '31/12/2023 25:00' ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime)
    FROM raw
)"""


def _whole(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({text}), '[0-9]+(\\.0+)?') "
        f"THEN CAST(CAST(trim({text}) AS DECIMAL(18,6)) AS INTEGER) END"
    )


def _money(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '-?[0-9]+(\\.?[0-9]+)?') "
        f"THEN CAST({text} AS DECIMAL(10,2)) END"
    )


_MONEY = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
)

_PARSED = f"""
payment_names(code, label) AS (
    VALUES ('1', 'Credit Card'), ('2', 'Cash'), ('3', 'No Charge'), ('4', 'Dispute'),
           ('5', 'Unknown'), ('6', 'Voided Trip')
),
parsed AS (
    SELECT ingestion_id, batch_id, ingested_at,
           {_whole("vendor_id")} AS vendor_id,
           CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
           CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
           {_whole("passenger_count")} AS passenger_count,
           {_money("trim(trip_distance)")} AS trip_distance_miles,
           {_whole("pu_location_id")} AS pickup_location_id,
           {_whole("do_location_id")} AS dropoff_location_id,
           {_whole("rate_code_id")} AS rate_code_id,
           trim(store_and_fwd_flag) AS store_and_fwd_flag,
           {_whole("payment_type")} AS payment_type_code,
           coalesce(label, 'Other') AS payment_type_label,
           {", ".join(f"{_money(c)} AS {c}" for c in _MONEY)}
    FROM raw LEFT JOIN payment_names ON code = trim(payment_type)
),
typed AS (
    SELECT *, epoch_us(dropoff_datetime) - epoch_us(pickup_datetime) AS took_us
    FROM parsed
    WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
)"""

_TRIP_ID = """md5(concat_ws('-',
    CAST(pickup_datetime AS VARCHAR), CAST(dropoff_datetime AS VARCHAR),
    coalesce(CAST(vendor_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    CAST(total_amount AS VARCHAR)))"""

_RULES = """total_amount > 0 AND fare_amount >= 0 AND trip_distance_miles >= 0
    AND passenger_count BETWEEN 0 AND 20 AND took_us BETWEEN 60000000 AND 21600000000"""

# Ratios scaled by E16.
_SCALED = f"""
    {_ratio("took_us", "60000000")} AS duration_e,
    CASE WHEN trip_distance_miles > 0 AND took_us > 0
         THEN {_ratio("trip_distance_miles * 100 * 36000000", "took_us")} END AS speed_e,
    CASE WHEN trip_distance_miles > 0
         THEN {_ratio("total_amount * 100", "CAST(trip_distance_miles * 100 AS HUGEINT)")}
    END AS mile_e,
    CASE WHEN total_amount > 0
         THEN {_ratio("tip_amount * 100", "CAST(total_amount * 100 AS HUGEINT)")}
         ELSE 0 END AS tip_e"""

_DAY = """CAST(pickup_datetime AS DATE) AS pickup_date,
    hour(pickup_datetime) AS pickup_hour,
    rpad(dayname(pickup_datetime), 9, ' ') AS pickup_day_of_week,
    month(pickup_datetime) AS pickup_month,
    year(pickup_datetime) AS pickup_year,
    CAST(dayofweek(pickup_datetime) AS INTEGER) AS day_of_week_num"""

_LATEST = """
latest AS (
    SELECT * FROM typed
    QUALIFY row_number() OVER (
        PARTITION BY pickup_datetime, dropoff_datetime, vendor_id, total_amount
        ORDER BY ingestion_id DESC) = 1
)"""

_TRIPS = f"""
trips AS (
    SELECT *, {_TRIP_ID} AS trip_id, {_DAY}, {_SCALED},
           CAST(total_amount * 100 AS HUGEINT) * 100000000000000 AS total_e,
           CAST(fare_amount * 100 AS HUGEINT) * 100000000000000 AS fare_e,
           CAST(tip_amount * 100 AS HUGEINT) * 100000000000000 AS tips_e,
           CAST(tolls_amount * 100 AS HUGEINT) * 100000000000000 AS tolls_e,
           CAST(congestion_surcharge * 100 AS HUGEINT) * 100000000000000 AS congestion_e,
           CAST(trip_distance_miles * 100 AS HUGEINT) * 100000000000000 AS distance_e
    FROM latest WHERE {_RULES}
)"""

_DAILY = f"""
hour_counts AS (
    SELECT pickup_date, vendor_id, payment_type_label, pickup_hour, COUNT(*) AS n
    FROM trips GROUP BY ALL
),
peaks AS (
    SELECT pickup_date, vendor_id, payment_type_label, pickup_hour AS peak_pickup_hour
    FROM hour_counts
    QUALIFY row_number() OVER (
        PARTITION BY pickup_date, vendor_id, payment_type_label ORDER BY n DESC, pickup_hour) = 1
),
sums AS (
    SELECT pickup_date, vendor_id, payment_type_label,
           COUNT(*) AS total_trips,
           CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
           {_sum("total_e")} AS total_revenue,
           {_mean("total_e")} AS avg_fare_per_trip,
           {_sum("fare_e")} AS total_base_fare,
           {_sum("tips_e")} AS total_tips,
           {_mean("tip_e", 4)} AS avg_tip_rate,
           {_sum("tolls_e")} AS total_tolls,
           {_sum("congestion_e")} AS total_congestion_surcharge,
           {_sum("distance_e")} AS total_distance_miles,
           {_mean("distance_e")} AS avg_distance_miles,
           {_mean("duration_e")} AS avg_duration_mins,
           {_sum("duration_e")} AS total_duration_mins,
           {_mean("speed_e")} AS avg_speed_mph,
           {_mean("mile_e")} AS avg_cost_per_mile
    FROM trips GROUP BY pickup_date, vendor_id, payment_type_label
),
daily AS (
    SELECT md5(concat_ws('-', CAST(s.pickup_date AS VARCHAR),
               coalesce(CAST(s.vendor_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
               s.payment_type_label)) AS summary_id,
           CAST(s.pickup_date AS VARCHAR) AS pickup_date,
           year(s.pickup_date) AS pickup_year,
           month(s.pickup_date) AS pickup_month,
           rpad(monthname(s.pickup_date), 9, ' ') AS month_name,
           rpad(dayname(s.pickup_date), 9, ' ') AS day_of_week,
           s.vendor_id,
           coalesce(CASE s.vendor_id WHEN 1 THEN 'Creative Mobile Technologies'
                                     WHEN 2 THEN 'VeriFone Inc.' END,
                    'Unknown Vendor') AS vendor_name,
           s.* EXCLUDE (pickup_date, vendor_id),
           p.peak_pickup_hour
    FROM sums s JOIN peaks p
      ON s.pickup_date = p.pickup_date AND s.payment_type_label = p.payment_type_label
     AND s.vendor_id IS NOT DISTINCT FROM p.vendor_id
)"""

_HEAT = f"""
heat AS (
    SELECT pickup_hour, pickup_day_of_week, day_of_week_num,
           COUNT(*) AS trip_count,
           {_mean("total_e")} AS avg_fare,
           {_mean("distance_e")} AS avg_distance,
           {_mean("duration_e")} AS avg_duration_mins,
           {_sum("total_e")} AS total_revenue
    FROM trips GROUP BY pickup_hour, pickup_day_of_week, day_of_week_num
)"""

_PAY = f"""
payment_sums AS (
    SELECT payment_type_code, payment_type_label,
           COUNT(*) AS trip_count,
           SUM(total_e) AS revenue_e,
           {_sum("total_e")} AS total_revenue,
           {_mean("total_e")} AS avg_fare,
           {_sum("tips_e")} AS total_tips,
           {_mean("tips_e")} AS avg_tip,
           {_mean("tip_e", 4)} AS avg_tip_rate,
           CAST(SUM(CASE WHEN tip_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS tipped_trips,
           {_mean("distance_e")} AS avg_distance,
           {_mean("duration_e")} AS avg_duration_mins
    FROM trips GROUP BY payment_type_code, payment_type_label
),
whole AS (
    SELECT SUM(trip_count) AS all_trips, SUM(revenue_e) // 100000000000000 AS all_cents
    FROM payment_sums
),
payment AS (
    SELECT p.* EXCLUDE (revenue_e),
           {_percent("trip_count", "all_trips")} AS pct_of_total_trips,
           {_percent("revenue_e // 100000000000000", "all_cents")} AS pct_of_total_revenue,
           {_percent("tipped_trips", "trip_count")} AS tip_frequency_pct
    FROM payment_sums p, whole
)"""

_BROKEN = """
broken AS (
    SELECT trip_id, ingestion_id, vendor_id, passenger_count, trip_distance_miles,
           payment_type_code, payment_type_label, fare_amount, tip_amount, tolls_amount, tip_e,
           CAST(CASE ingestion_id % 99 WHEN 0
                     THEN CAST(fare_amount * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(10,2))
                     ELSE total_amount END AS DECIMAL(10,2)) AS total_amount,
           CASE ingestion_id % 101 WHEN 0 THEN dropoff_datetime ELSE pickup_datetime
           END AS pickup_datetime,
           CASE ingestion_id % 101 WHEN 0 THEN pickup_datetime ELSE dropoff_datetime
           END AS dropoff_datetime,
           CASE ingestion_id % 101 WHEN 0 THEN -duration_e ELSE duration_e END AS duration_e
    FROM trips CROSS JOIN (VALUES (1), (2)) AS c(copy)
    WHERE copy = 1 OR ingestion_id % 103 = 0
),
daily_gap AS (
    SELECT * FROM daily WHERE day(CAST(pickup_date AS DATE)) <> 7
)"""

_RUNS = """
run_events AS (
    SELECT event_id % 3 AS step, event_id // 3 + 1 AS run_id, event_id, ts, user_id, event_type,
           value, props
    FROM events
),
opened AS (SELECT * FROM run_events WHERE step = 0),
taken AS (SELECT * FROM run_events WHERE step = 1),
closed AS (SELECT * FROM run_events WHERE step = 2),
runs AS (
    SELECT CAST(run_id AS INTEGER) AS run_id,
           CASE WHEN o.event_id IS NOT NULL THEN 'trip_pipeline' END AS dag_id,
           o.event_type AS task_id,
           strftime(o.ts, '%Y-%m-%d 00:00:00') AS execution_date,
           CASE WHEN c.event_type = 'error' THEN 'failed'
                WHEN c.event_id IS NOT NULL THEN 'success'
                WHEN t.event_id IS NOT NULL THEN 'ingested' ELSE 'running' END AS status,
           CAST(coalesce(c.user_id, t.user_id, 0) AS BIGINT) AS rows_ingested,
           CAST(0 AS BIGINT) AS rows_inserted,
           CAST(0 AS BIGINT) AS rows_updated,
           CASE WHEN c.event_type = 'error' THEN c.props END AS error_message,
           CAST(o.ts AS VARCHAR) AS started_at,
           CAST(c.ts AS VARCHAR) AS completed_at,
           CAST(CAST(c.value AS DECIMAL(10,2)) AS DOUBLE) AS duration_secs
    FROM opened o FULL JOIN taken t USING (run_id) FULL JOIN closed c USING (run_id)
)"""

_RECORDS = """
records AS (
    SELECT (ingestion_id % 1000000000) // 1000 AS page,
           CAST(row_number() OVER (
               PARTITION BY (ingestion_id % 1000000000) // 1000
               ORDER BY ingestion_id % 1000000000, ingestion_id) - 1 AS INTEGER) AS position,
           *
    FROM raw
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_TO_TYPED = (_RAW, _PARSED)
_TO_TRIPS = (*_TO_TYPED, _LATEST, _TRIPS)

_NOT_NULL = {
    ("bronze.raw_taxi_trips", "bad_raw"): [
        "ingestion_id",
        "vendor_id",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "total_amount",
        "batch_id",
        "ingested_at",
    ],
    ("silver.cleaned_taxi_trips", "bad_trips"): [
        "trip_id",
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "passenger_count",
        "trip_distance_miles",
        "payment_type_label",
        "fare_amount",
        "total_amount",
        "trip_duration_mins",
    ],
    ("gold.daily_trip_summary", "bad_daily"): [
        "summary_id",
        "pickup_date",
        "total_trips",
        "total_revenue",
        "avg_fare_per_trip",
        "avg_duration_mins",
        "vendor_name",
        "payment_type_label",
    ],
    ("gold.hourly_demand_heatmap", "bad_heat"): ["pickup_hour", "trip_count"],
    ("gold.payment_analysis", "bad_payment"): ["payment_type_label"],
}
_UNIQUE = [
    ("bronze.raw_taxi_trips", "bad_raw", "ingestion_id"),
    ("silver.cleaned_taxi_trips", "bad_trips", "trip_id"),
    ("gold.daily_trip_summary", "bad_daily", "summary_id"),
    ("gold.payment_analysis", "bad_payment", "payment_type_label"),
]
_ACCEPTED = [
    ("vendor_id", "(1, 2)"),
    ("payment_type_code", "(1, 2, 3, 4, 5, 6)"),
    (
        "payment_type_label",
        "('Credit Card', 'Cash', 'No Charge', 'Dispute', 'Unknown', 'Voided Trip', 'Other')",
    ),
]
_EXPRESSIONS = [
    ("silver.cleaned_taxi_trips", "bad_trips", "fare_amount", ">= 0"),
    ("silver.cleaned_taxi_trips", "bad_trips", "total_amount", "> 0"),
    ("silver.cleaned_taxi_trips", "bad_trips", "trip_duration_mins", "> 0"),
    ("silver.cleaned_taxi_trips", "bad_trips", "tip_percentage", "BETWEEN 0 AND 1"),
    ("gold.daily_trip_summary", "bad_daily", "total_trips", "> 0"),
    ("gold.daily_trip_summary", "bad_daily", "total_revenue", "> 0"),
    ("gold.daily_trip_summary", "bad_daily", "avg_fare_per_trip", "> 0"),
    ("gold.daily_trip_summary", "bad_daily", "avg_tip_rate", "BETWEEN 0 AND 1"),
    ("gold.daily_trip_summary", "bad_daily", "avg_duration_mins", "> 0"),
    ("gold.hourly_demand_heatmap", "bad_heat", "pickup_hour", "BETWEEN 0 AND 23"),
    ("gold.hourly_demand_heatmap", "bad_heat", "trip_count", "> 0"),
    ("gold.payment_analysis", "bad_payment", "pct_of_total_trips", "BETWEEN 0 AND 100"),
    ("gold.payment_analysis", "bad_payment", "tip_frequency_pct", "BETWEEN 0 AND 100"),
]
# Ratios of silver are there scaled; a sign or a null is the same, and 1 becomes E16.
_STAND_IN = {"trip_duration_mins": "duration_e", "tip_percentage": f"tip_e / {E16}"}
_HELD = {"trip_duration_mins": "duration_e", "tip_percentage": "tip_e"}
_BAD = ",".join(
    [
        damage_sql("lost", BRONZE_TRIPS, "bad_raw"),
        damage_sql("broken", SILVER_TRIPS, "bad_trips", _HELD),
        damage_sql("daily_gap", GOLD_DAILY, "bad_daily"),
        damage_sql("heat", GOLD_HEATMAP, "bad_heat"),
        damage_sql("payment", GOLD_PAYMENT, "bad_payment"),
    ]
)


def _union(selects: list[str]) -> str:
    return "\nUNION ALL ".join(selects)


def _not_null_counts() -> list[str]:
    return [
        f"SELECT 'not_null:{table}.{c}' AS check_name, '{table}' AS table_name, "
        f"COUNT(*) - COUNT({_STAND_IN.get(c, c)}) AS failing FROM {cte}"
        for (table, cte), columns in _NOT_NULL.items()
        for c in columns
    ]


def _unique_counts() -> list[str]:
    return [
        f"SELECT 'unique:{table}.{c}', '{table}', COUNT(*) FROM "
        f"(SELECT {c} FROM {cte} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"
        for table, cte, c in _UNIQUE
    ]


def _accepted_counts() -> list[str]:
    table = "silver.cleaned_taxi_trips"
    return [
        f"SELECT 'accepted_values:{table}.{c}', '{table}', "
        f"COUNT(DISTINCT CASE WHEN {c} NOT IN {values} THEN {c} END) FROM bad_trips"
        for c, values in _ACCEPTED
    ]


def _expression_counts() -> list[str]:
    return [
        f"SELECT 'expression:{table}.{c} {rule}', '{table}', "
        f"COUNT(CASE WHEN NOT ({_STAND_IN.get(c, c)} {rule}) THEN 1 END) FROM {cte}"
        for table, cte, c, rule in _EXPRESSIONS
    ]


_ENDS_EARLY = "dropoff_datetime <= pickup_datetime OR duration_e <= 0"
_BELOW_FARE = "total_amount < fare_amount AND total_amount > 0"
_UNCOVERED = """SELECT CAST(day AS VARCHAR) AS pickup_date
    FROM (SELECT DISTINCT pickup_date AS day FROM trips) AS days
    WHERE CAST(day AS VARCHAR) NOT IN (SELECT pickup_date FROM daily_gap)"""
_UNKNOWN_RUNS = """SELECT DISTINCT pipeline_run_id AS run_id FROM lost
    WHERE pipeline_run_id NOT IN (SELECT run_id FROM runs WHERE run_id <> 2)"""

_TABLE_COUNTS = [
    "SELECT 'dropoff_after_pickup', 'silver.cleaned_taxi_trips', COUNT(*) FROM bad_trips "
    f"WHERE {_ENDS_EARLY}",
    f"SELECT 'total_gte_fare', 'silver.cleaned_taxi_trips', COUNT(*) FROM bad_trips "
    f"WHERE {_BELOW_FARE}",
    "SELECT 'gold_coverage', 'silver.cleaned_taxi_trips', COUNT(*) FROM "
    f"({_UNCOVERED.replace('FROM daily_gap', 'FROM bad_daily WHERE pickup_date IS NOT NULL')})",
    f"SELECT 'run_reference', 'bronze.raw_taxi_trips', COUNT(*) FROM ({_UNKNOWN_RUNS})",
]

_ALL_TABLES = (
    _RAW,
    _LOST,
    _PARSED,
    _LATEST,
    _TRIPS,
    _DAILY,
    _HEAT,
    _PAY,
    _BROKEN,
    _RUNS,
    _BAD,
)


def _check_counts(selects: list[str]) -> str:
    named = "checked(check_name, table_name, failing) AS (" + _union(selects) + ")"
    return _with(*_ALL_TABLES, named) + " SELECT check_name, failing FROM checked"


# Text limits, tightened to four characters as in the query.
_TEXT_COLUMNS = (
    "vendor_id",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "rate_code_id",
    "store_and_fwd_flag",
    "pu_location_id",
    "do_location_id",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "batch_id",
)


_FEED_COLUMNS = """ SELECT page, position, vendor_id AS "VendorID", tpep_pickup_datetime,
            tpep_dropoff_datetime, passenger_count, trip_distance, rate_code_id AS "RatecodeID",
            store_and_fwd_flag, pu_location_id AS "PULocationID", do_location_id AS "DOLocationID",
            payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
            improvement_surcharge, total_amount, congestion_surcharge, airport_fee
        FROM records"""


def _silver_columns(money: str) -> str:
    return f""" SELECT trip_id, ingestion_id, batch_id, CAST(ingested_at AS VARCHAR) AS ingested_at,
            vendor_id, CAST(pickup_datetime AS VARCHAR) AS pickup_datetime,
            CAST(dropoff_datetime AS VARCHAR) AS dropoff_datetime,
            CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour, pickup_day_of_week,
            pickup_month, pickup_year, passenger_count,
            CAST(trip_distance_miles AS DOUBLE) AS trip_distance_miles, pickup_location_id,
            dropoff_location_id, rate_code_id, store_and_fwd_flag, payment_type_code,
            payment_type_label, {money},
            {_six_places("duration_e")} AS trip_duration_mins,
            {_six_places("speed_e")} AS avg_speed_mph, {_six_places("mile_e")} AS cost_per_mile,
            {_six_places("tip_e")} AS tip_percentage FROM trips"""


def _checked(more: list[str]) -> str:
    counts = _not_null_counts() + _unique_counts() + _accepted_counts() + _expression_counts() + more
    return f"checked(check_name, table_name, failing) AS ({_union(counts)})"


def _rated(error: str) -> str:
    return f""", rated AS (
            SELECT *, CASE check_name WHEN '{error}' THEN 'error' ELSE 'warn' END AS severity
            FROM checked)
        SELECT *, CASE WHEN failing = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail'
                       ELSE 'warn' END AS status
        FROM rated"""


def _sound(sql: str) -> str:
    """The same over the tables that were not damaged."""
    for bad, good in (("raw", "raw"), ("trips", "trips"), ("daily", "daily"), ("heat", "heat"), ("payment", "payment")):
        sql = sql.replace(f"bad_{bad}", good)
    return sql


def oracle_sql() -> dict[str, str]:
    typed, trips = _with(*_TO_TYPED), _with(*_TO_TRIPS)
    daily = _with(*_TO_TRIPS, _DAILY) + " SELECT "
    payment = _with(*_TO_TRIPS, _PAY) + " SELECT "
    everything = _with(*_ALL_TABLES) + " "
    newest = "ORDER BY tpep_pickup_datetime DESC NULLS LAST, ingestion_id DESC"
    money = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY)
    # Raw trips numbered by page and place, as a run that takes all pages numbers them.
    numbered = """numbered AS (
        SELECT * EXCLUDE (page, position) REPLACE (CAST(page * 1100 + position AS BIGINT) AS ingestion_id)
        FROM records)"""
    rerun = _with(
        _RAW, _RECORDS, numbered, _PARSED.replace("FROM raw ", "FROM numbered "), _LATEST, _TRIPS, _DAILY
    )
    silver = trips + _silver_columns(money)
    in_parts = f"""WITH {_RAW.replace("raw AS (", "once AS (")}, raw AS (
        SELECT * REPLACE (CASE WHEN batch_id = 'batch_redo' OR ingestion_id % 3 = 2 THEN 'batch_2'
                               WHEN ingestion_id % 3 = 1 THEN 'batch_1' ELSE 'batch_0' END AS batch_id)
        FROM once), {",".join((_PARSED, _LATEST, _TRIPS))}"""
    return {
        "landed_files": _with(_RAW, _RECORDS) + _FEED_COLUMNS,
        "stored_silver": in_parts + _silver_columns(money),
        "whole_run": rerun + " SELECT *, CAST(2 AS BIGINT) AS runs FROM daily",
        "stored_tables": in_parts
        + f""", {_DAILY}, {_HEAT}, {_PAY},
        shown(table_name, place, key1, key2, n) AS (
            SELECT 'gold.hourly_demand_heatmap',
                   row_number() OVER (ORDER BY day_of_week_num, pickup_hour),
                   CAST(day_of_week_num AS BIGINT), pickup_hour, trip_count FROM heat
            UNION ALL
            SELECT 'gold.payment_analysis',
                   row_number() OVER (ORDER BY trip_count DESC, payment_type_label, payment_type_code),
                   CAST(payment_type_code AS BIGINT), length(payment_type_label), trip_count FROM payment
            UNION ALL SELECT 'silver.cleaned_taxi_trips', NULL, NULL, NULL, COUNT(*) FROM trips
            UNION ALL SELECT 'gold.daily_trip_summary', NULL, NULL, NULL, COUNT(*) FROM daily
            UNION ALL
            SELECT 'bronze.raw_taxi_trips', NULL, CAST(right(batch_id, 1) AS BIGINT), NULL, COUNT(*)
            FROM raw GROUP BY batch_id)
        SELECT * FROM shown""",
        "newest_trips_topn": _with(_RAW)
        + f" SELECT ingestion_id, tpep_pickup_datetime, total_amount FROM raw {newest} LIMIT 10000",
        "feed_page_slice": _with(_RAW)
        + f" SELECT ingestion_id, tpep_pickup_datetime, total_amount FROM raw {newest} "
        "LIMIT 1000 OFFSET 3000",
        "feed_pages": _with(_RAW, _RECORDS) + _FEED_COLUMNS,
        "conform_columns": _with(_RAW, _RECORDS)
        + """ SELECT * EXCLUDE (page, position) REPLACE (
            CAST(7 * 1099511627776 + page * 1100 + position AS BIGINT) AS ingestion_id,
            '2024-02-03 04:05:06' AS ingested_at, 'batch_fixture' AS batch_id,
            CAST(7 AS INTEGER) AS pipeline_run_id) FROM records""",
        "identity_order": _with(_RAW)
        + """ SELECT COUNT(*) AS row_count, COUNT(DISTINCT ingestion_id) AS distinct_ids,
            CAST(7 * 1099511627776 AS BIGINT) AS first_id,
            CAST(7 * 1099511627776 + COUNT(*) - 1 AS BIGINT) AS last_id FROM raw""",
        "safe_int_cast": _with(_RAW)
        + f""" SELECT ingestion_id, {_whole("vendor_id")} AS vendor_id,
            {_whole("passenger_count")} AS passenger_count,
            {_whole("pu_location_id")} AS pickup_location_id,
            {_whole("do_location_id")} AS dropoff_location_id,
            {_whole("rate_code_id")} AS rate_code_id,
            {_whole("payment_type")} AS payment_type_code FROM raw""",
        "safe_decimal_trimmed": _with(_RAW)
        + f""" SELECT ingestion_id,
            CAST({_money("trim(trip_distance)")} AS DOUBLE) AS trip_distance_miles FROM raw""",
        "safe_decimal_strict": _with(_RAW)
        + " SELECT ingestion_id, "
        + ", ".join(f"CAST({_money(c)} AS DOUBLE) AS {c}" for c in _MONEY)
        + " FROM raw",
        "timestamp_parse": typed
        + """ SELECT ingestion_id, CAST(pickup_datetime AS VARCHAR) AS pickup_datetime,
            CAST(dropoff_datetime AS VARCHAR) AS dropoff_datetime FROM parsed""",
        "timestamp_rejects": _with(_RAW, _LOST)
        + """ SELECT ingestion_id, tpep_dropoff_datetime,
            CASE WHEN tpep_dropoff_datetime LIKE '31/%' THEN 'rejected' ELSE 'kept' END AS side
        FROM lost
        WHERE tpep_dropoff_datetime IS NULL OR tpep_dropoff_datetime NOT LIKE '31/%'
           OR total_amount IS NOT NULL""",
        "payment_label": typed
        + " SELECT ingestion_id, store_and_fwd_flag, payment_type_label FROM parsed",
        "vendor_name": typed
        + """ SELECT ingestion_id, vendor_id,
            coalesce(CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies'
                                    WHEN 2 THEN 'VeriFone Inc.' END,
                     'Unknown Vendor') AS vendor_name FROM parsed""",
        "trip_metrics": typed
        + f""" SELECT ingestion_id, {_six_places("duration_e")} AS trip_duration_mins,
            {_six_places("speed_e")} AS avg_speed_mph, {_six_places("mile_e")} AS cost_per_mile,
            {_six_places("tip_e")} AS tip_percentage
        FROM (SELECT ingestion_id, {_SCALED} FROM typed)""",
        "calendar_parts": typed
        + f""" SELECT ingestion_id, CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour,
            pickup_day_of_week, pickup_month, pickup_year, day_of_week_num
        FROM (SELECT ingestion_id, {_DAY} FROM typed)""",
        "month_day_names": """
        SELECT CAST(day AS VARCHAR) AS order_date, rpad(monthname(day), 9, ' ') AS month_name,
            rpad(dayname(day), 9, ' ') AS day_of_week,
            CAST(dayofweek(day) AS INTEGER) AS day_of_week_num, COUNT(*) AS order_count
        FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders) GROUP BY day""",
        "surrogate_key": typed + f" SELECT ingestion_id, {_TRIP_ID} AS trip_id FROM typed",
        "required_filter": _with(_RAW, _LOST)
        + """ SELECT ingestion_id, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount
        FROM lost WHERE tpep_dropoff_datetime IS NOT NULL AND total_amount IS NOT NULL""",
        "business_filter": typed
        + f""" SELECT ingestion_id, CAST(fare_amount AS DOUBLE) AS fare_amount,
            CAST(trip_distance_miles AS DOUBLE) AS trip_distance_miles, passenger_count,
            CAST(total_amount AS DOUBLE) AS total_amount FROM typed WHERE {_RULES}""",
        "dedupe_latest": typed
        + """ SELECT CAST(pickup_datetime AS VARCHAR) AS pickup_datetime,
            CAST(dropoff_datetime AS VARCHAR) AS dropoff_datetime, vendor_id,
            CAST(total_amount AS DOUBLE) AS total_amount, MAX(ingestion_id) AS ingestion_id
        FROM typed GROUP BY typed.pickup_datetime, typed.dropoff_datetime, vendor_id,
            typed.total_amount""",
        "silver_trips": silver,
        "trip_rollup": trips
        + f""" SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour, vendor_id,
            payment_type_code, payment_type_label, COUNT(*) AS trips,
            COUNT(CASE WHEN tip_amount > 0 THEN 1 END) AS tipped,
            COUNT(total_e) AS revenue_n, COUNT(tips_e) AS tips_n, COUNT(tip_e) AS tip_rate_n,
            COUNT(distance_e) AS distance_n, COUNT(duration_e) AS duration_n,
            COUNT(speed_e) AS speed_n, COUNT(mile_e) AS mile_cost_n,
            CAST(SUM(passenger_count) AS BIGINT) AS passengers, {_sum("total_e")} AS revenue,
            {_sum("fare_e")} AS fares, {_sum("tips_e")} AS tips, {_sum("tip_e", 4)} AS tip_rate,
            {_sum("tolls_e")} AS tolls, {_sum("congestion_e")} AS congestion,
            {_sum("distance_e")} AS distance, {_sum("duration_e", 4)} AS duration,
            {_sum("speed_e", 4)} AS speed, {_sum("mile_e", 4)} AS mile_cost
        FROM trips GROUP BY trips.pickup_date, pickup_hour, vendor_id, payment_type_code,
            payment_type_label""",
        "daily_trip_summary": daily + "*, '2024-02-03 04:05:06' AS last_updated_at FROM daily",
        "hourly_demand_heatmap": _with(*_TO_TRIPS, _HEAT) + " SELECT *, '2024-02-03 04:05:06' AS last_updated_at FROM heat",
        "payment_analysis": payment + "*, '2024-02-03 04:05:06' AS last_updated_at FROM payment",
        "peak_hour_mode": daily
        + "CAST(pickup_date AS VARCHAR) AS pickup_date, vendor_id, payment_type_label, "
        "peak_pickup_hour FROM peaks",
        "share_of_total": payment
        + "payment_type_code, payment_type_label, pct_of_total_trips, pct_of_total_revenue "
        "FROM payment",
        "tip_frequency": payment
        + "payment_type_code, payment_type_label, tipped_trips, tip_frequency_pct FROM payment",
        "batch_lookup": _with(_RAW)
        + """ SELECT ingestion_id, batch_id, tpep_pickup_datetime,
            CAST(ingested_at AS VARCHAR) AS ingested_at
        FROM raw WHERE batch_id = 'batch_2024-01-05'""",
        "batch_validation": _with(_RAW, _LOST)
        + """, counted AS (
            SELECT batch_id, COUNT(*) AS row_count,
                   COUNT(CASE WHEN tpep_pickup_datetime IS NULL OR total_amount IS NULL THEN 1 END)
                       AS null_critical_count
            FROM lost GROUP BY batch_id
            UNION ALL SELECT 'batch_absent', 0, 0)
        SELECT *, row_count > 0 AND 10 * null_critical_count <= row_count AS passed
        FROM counted""",
        "row_counts": trips
        + """ SELECT 'bronze.raw_taxi_trips' AS table_name, COUNT(*) AS row_count FROM raw
        UNION ALL SELECT 'silver.cleaned_taxi_trips', COUNT(*) FROM trips""",
        "dq_not_null": _check_counts(_not_null_counts()),
        "dq_unique": _check_counts(_unique_counts()),
        "dq_accepted_values": _check_counts(_accepted_counts()),
        "dq_expression": _check_counts(_expression_counts()),
        "dq_dropoff_after_pickup": everything
        + f"""SELECT trip_id, CAST(pickup_datetime AS VARCHAR) AS pickup_datetime,
            CAST(dropoff_datetime AS VARCHAR) AS dropoff_datetime,
            -((2 * -duration_e + 10000000000) // 20000000000)::DOUBLE / 1000000
                AS trip_duration_mins
        FROM broken WHERE {_ENDS_EARLY}""",
        "dq_total_gte_fare": everything
        + f"""SELECT trip_id, CAST(fare_amount AS DOUBLE) AS fare_amount,
            CAST(total_amount AS DOUBLE) AS total_amount, CAST(tip_amount AS DOUBLE) AS tip_amount,
            CAST(tolls_amount AS DOUBLE) AS tolls_amount
        FROM broken WHERE {_BELOW_FARE}""",
        "dq_gold_coverage": everything + _UNCOVERED,
        "dq_referential": everything + _UNKNOWN_RUNS,
        "dq_text_limits": _with(_RAW)
        + _union(
            [
                f" SELECT 'length({c}) <= 4' AS check_name, "
                f"COUNT(CASE WHEN length({c}) > 4 THEN 1 END) AS failing FROM raw"
                for c in _TEXT_COLUMNS
            ]
        ),
        "dq_report": _with(
            *_ALL_TABLES,
            _checked(
                _TABLE_COUNTS
                + [
                    f"SELECT 'text_limit_{c}', 'bronze.raw_taxi_trips', COUNT(*) FROM bad_raw "
                    f"WHERE {c} IS NOT NULL AND number % 107 = {k}"
                    for k, c in enumerate(_TEXT_COLUMNS)
                ]
            ),
        )
        + _rated("total_gte_fare"),
        "stored_report": in_parts
        + f""", {_DAILY}, {_HEAT}, {_PAY}, daily_gap AS (SELECT * FROM daily), """
        + _sound(
            _checked(
                _TABLE_COUNTS[:3]
                + ["SELECT 'run_reference', 'bronze.raw_taxi_trips', COUNT(DISTINCT pipeline_run_id) FROM raw"]
                + [
                    f"SELECT 'text_limit_{c}', 'bronze.raw_taxi_trips', COUNT(CASE WHEN length({c}) > {n} THEN 1 END) FROM raw"
                    for c, n in BRONZE_TEXT_LIMITS.items()
                ]
            )
        )
        + _rated("run_reference"),
        "run_log_state": _with(_RUNS) + " SELECT * FROM runs",
        "run_log_events": """SELECT CAST(run_id AS INTEGER) AS run_id, 'd' AS dag_id, 't' AS task_id,
            '2024-06-01 00:00:00' AS execution_date, status, rows_ingested,
            CAST(0 AS BIGINT) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, error_message,
            '2024-02-03 04:05:06' AS started_at, completed_at,
            CASE WHEN completed_at IS NOT NULL THEN CAST(90.13 AS DOUBLE) END AS duration_secs
            FROM (SELECT 1, 3000000000 + min(event_id), 'success', NULL, '2024-02-03 04:06:36.125' FROM events
                  UNION ALL
                  SELECT 2, 3000000000 + max(event_id), 'failed', 'lost', '2024-02-03 04:06:36.125' FROM events
                  UNION ALL SELECT 3, 5, 'ingested', NULL, NULL)
            AS r(run_id, rows_ingested, status, error_message, completed_at)""",
        "latest_runs": _with(_RUNS) + " SELECT * FROM runs ORDER BY run_id DESC LIMIT 5",
    }
