"""Silver to gold.

All three tables are sums, counts and means over groups of trips, so they are built from one rollup
of silver: a single pass over the trips, then merges of a table that is small at any scale
(days x hours x vendors x payment types). ``run_pipeline`` writes the rollup once and reads it for
the three; called on silver alone, a table computes the part of the rollup it needs, and Catalyst
prunes the rest.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import calendar
from tripmill.functions.keys import surrogate_key
from tripmill.functions.labels import vendor_name
from tripmill.functions.rounding import mean, percent
from tripmill.operators.shares import with_totals
from tripmill.schema import DAILY, HEATMAP, PAYMENT, as_table

ROLLUP_KEYS = (
    "pickup_date",
    "pickup_hour",
    "vendor_id",
    "payment_type_code",
    "payment_type_label",
)

# Rollup measure -> silver column it sums; its count of known values is <measure>_n where a mean
# is taken of it.
SUMS = {
    "passengers": "passenger_count",
    "revenue": "total_amount",
    "fares": "fare_amount",
    "tips": "tip_amount",
    "tip_rate": "tip_percentage",
    "tolls": "tolls_amount",
    "congestion": "congestion_surcharge",
    "distance": "trip_distance_miles",
    "duration": "trip_duration_mins",
    "speed": "avg_speed_mph",
    "mile_cost": "cost_per_mile",
}
MEANS = ("revenue", "tips", "tip_rate", "distance", "duration", "speed", "mile_cost")
COUNTS = ("trips", "tipped", *[f"{m}_n" for m in MEANS])


def trip_rollup(silver: DataFrame) -> DataFrame:
    """Additive measures per day, hour, vendor and payment type."""
    sums = [F.sum(column).alias(measure) for measure, column in SUMS.items()]
    known = [F.count(SUMS[m]).alias(f"{m}_n") for m in MEANS]
    return silver.groupBy(*ROLLUP_KEYS).agg(
        F.count("*").alias("trips"),
        F.count_if(F.col("tip_amount") > 0).alias("tipped"),
        *sums,
        *known,
    )


def _merge(rollup: DataFrame, *keys: str) -> DataFrame:
    """The rollup at a coarser grain."""
    return rollup.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in (*COUNTS, *SUMS)])


def _mean(measure: str, places: int = 2) -> Column:
    return mean(F.col(measure), F.col(f"{measure}_n"), places)


def _total(measure: str) -> Column:
    return F.round(measure, 2)


def _loaded_at(now: datetime | None) -> Column:
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def peak_hour(trips: Column, hour: Column) -> Column:
    """Aggregate: hour with most trips, the earliest of equals, over rows ``(hour, trips)``."""
    # One whole number orders by trips, then by earlier hour, and keeps the aggregate hash-based.
    return F.max_by(hour, trips * 24 - hour)


def daily_from_rollup(rollup: DataFrame, now: datetime | None = None) -> DataFrame:
    keys = ("pickup_date", "vendor_id", "payment_type_label")
    # By hour first: an hour's trips may be spread over several payment codes of one label.
    hourly = _merge(rollup, *keys, "pickup_hour")
    daily = hourly.groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in (*COUNTS, *SUMS)],
        peak_hour(F.col("trips"), F.col("pickup_hour")).alias("peak_pickup_hour"),
    )
    day = F.col("pickup_date")
    return as_table(
        daily.select(
            surrogate_key(*[F.col(k) for k in keys]).alias("summary_id"),
            "pickup_date",
            calendar.year(day).alias("pickup_year"),
            calendar.month(day).alias("pickup_month"),
            calendar.month_name(day).alias("month_name"),
            calendar.day_name(day).alias("day_of_week"),
            "vendor_id",
            vendor_name(F.col("vendor_id")).alias("vendor_name"),
            "payment_type_label",
            F.col("trips").alias("total_trips"),
            F.col("passengers").alias("total_passengers"),
            _total("revenue").alias("total_revenue"),
            _mean("revenue").alias("avg_fare_per_trip"),
            _total("fares").alias("total_base_fare"),
            _total("tips").alias("total_tips"),
            _mean("tip_rate", 4).alias("avg_tip_rate"),
            _total("tolls").alias("total_tolls"),
            _total("congestion").alias("total_congestion_surcharge"),
            _total("distance").alias("total_distance_miles"),
            _mean("distance").alias("avg_distance_miles"),
            _mean("duration").alias("avg_duration_mins"),
            _total("duration").alias("total_duration_mins"),
            _mean("speed").alias("avg_speed_mph"),
            _mean("mile_cost").alias("avg_cost_per_mile"),
            "peak_pickup_hour",
            _loaded_at(now).alias("last_updated_at"),
        ),
        DAILY,
    )


def heatmap_from_rollup(rollup: DataFrame, now: datetime | None = None) -> DataFrame:
    weekday = calendar.weekday_number(F.col("pickup_date"))
    name = calendar.day_name(F.col("pickup_date"))
    cells = _merge(
        rollup.withColumns({"pickup_day_of_week": name, "day_of_week_num": weekday}),
        "pickup_hour",
        "pickup_day_of_week",
        "day_of_week_num",
    )
    return as_table(
        cells.select(
            "pickup_hour",
            "pickup_day_of_week",
            "day_of_week_num",
            F.col("trips").alias("trip_count"),
            _mean("revenue").alias("avg_fare"),
            _mean("distance").alias("avg_distance"),
            _mean("duration").alias("avg_duration_mins"),
            _total("revenue").alias("total_revenue"),
            _loaded_at(now).alias("last_updated_at"),
        ),
        HEATMAP,
    )


_PAYMENT_MEASURES = (
    "trips",
    "tipped",
    "revenue",
    "revenue_n",
    "tips",
    "tips_n",
    "tip_rate",
    "tip_rate_n",
    "distance",
    "distance_n",
    "duration",
    "duration_n",
)


def payment_from_rollup(rollup: DataFrame, now: datetime | None = None) -> DataFrame:
    groups = _merge(rollup, "payment_type_code", "payment_type_label")
    # Totals of each measure that the table shows, so that both uses of the groups need the same
    # columns: Spark then computes the groups once and reads their exchange twice.
    groups = with_totals(groups, groups, **{f"all_{m}": F.sum(m) for m in _PAYMENT_MEASURES})
    return as_table(
        groups.select(
            "payment_type_code",
            "payment_type_label",
            F.col("trips").alias("trip_count"),
            _total("revenue").alias("total_revenue"),
            _mean("revenue").alias("avg_fare"),
            _total("tips").alias("total_tips"),
            _mean("tips").alias("avg_tip"),
            _mean("tip_rate", 4).alias("avg_tip_rate"),
            F.col("tipped").alias("tipped_trips"),
            _mean("distance").alias("avg_distance"),
            _mean("duration").alias("avg_duration_mins"),
            percent(F.col("trips"), F.col("all_trips")).alias("pct_of_total_trips"),
            percent(F.col("revenue"), F.col("all_revenue")).alias("pct_of_total_revenue"),
            percent(F.col("tipped"), F.col("trips")).alias("tip_frequency_pct"),
            _loaded_at(now).alias("last_updated_at"),
        ),
        PAYMENT,
    )


def daily_trip_summary(silver: DataFrame, now: datetime | None = None) -> DataFrame:
    """Trips, revenue, distance, duration and peak hour per day, vendor and payment label."""
    return daily_from_rollup(trip_rollup(silver), now)


def hourly_demand_heatmap(silver: DataFrame, now: datetime | None = None) -> DataFrame:
    """Demand per hour of day and day of week."""
    return heatmap_from_rollup(trip_rollup(silver), now)


def payment_analysis(silver: DataFrame, now: datetime | None = None) -> DataFrame:
    """Revenue and tips per payment type, with shares of the whole."""
    return payment_from_rollup(trip_rollup(silver), now)
