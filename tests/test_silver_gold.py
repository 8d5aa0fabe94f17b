"""The models on literal rows: traps of de-duplication, validation and aggregation."""

from collections import Counter, defaultdict
from datetime import date, datetime
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from tripmill.fixtures import raw_trips
from tripmill.operators.dedupe import latest_per_key
from tripmill.plans import gold
from tripmill.plans.silver import clean, malformed_times, without_malformed_times
from tripmill.schema import DAILY, HEATMAP, PAYMENT, SILVER
from tests.conftest import SF_DIR, columns_of

NOW = datetime(2024, 6, 1, 12)


def test_one_sound_trip(bronze, raw_row):
    silver = clean(bronze([raw_row(vendor_id="2.0", store_and_fwd_flag=" Y ")]))
    assert silver.dtypes == columns_of(SILVER)
    trip = silver.first()
    assert (trip.vendor_id, trip.store_and_fwd_flag, trip.payment_type_label) == (
        2, "Y", "Credit Card",
    )
    assert trip.pickup_date == date(2024, 3, 3) and trip.pickup_hour == 10
    assert (trip.pickup_day_of_week, trip.pickup_month, trip.pickup_year) == ("Sunday   ", 3, 2024)
    assert (trip.trip_duration_mins, trip.avg_speed_mph, trip.cost_per_mile) == (30, 12, 5)
    assert trip.tip_percentage == Decimal("0.2") and trip.airport_fee is None


def test_required_texts_and_business_rules(bronze, raw_row):
    def end(t):
        return {"tpep_dropoff_datetime": t}

    kept = [
        raw_row(trip_distance="0"),
        raw_row(fare_amount="0", total_amount="1"),
        raw_row(passenger_count="0", total_amount="2"),
        raw_row(passenger_count="20", total_amount="3"),
        raw_row(**end("2024-03-03T10:01:00")),
        raw_row(**end("2024-03-03T16:00:00")),
    ]
    dropped = [
        raw_row(tpep_pickup_datetime=None, total_amount="51"),
        raw_row(total_amount=None),
        raw_row(total_amount="0"),
        raw_row(total_amount="NaN"),
        raw_row(fare_amount="-1", total_amount="52"),
        raw_row(fare_amount=" 5.00", total_amount="53"),
        raw_row(trip_distance="-0.1", total_amount="54"),
        raw_row(trip_distance="NaN", total_amount="55"),
        raw_row(passenger_count="21", total_amount="56"),
        raw_row(passenger_count=None, total_amount="57"),
        raw_row(**end(None)),
        raw_row(**end("2024-03-03T10:00:59")),
        raw_row(**end("2024-03-03T16:00:01")),
        raw_row(**end("2024-03-03T09:00:00")),
    ]
    ids = {r.ingestion_id for r in clean(bronze(kept + dropped)).collect()}
    assert ids == {r["ingestion_id"] for r in kept}


def test_latest_row_wins_before_validation(bronze, raw_row):
    rows = [
        raw_row(tolls_amount="1"),
        raw_row(tolls_amount="2"),
        # The older row of this trip is valid, the latest is not: the trip is gone.
        raw_row(total_amount="31"),
        raw_row(total_amount="31", passenger_count="bad"),
    ]
    got = clean(bronze(rows)).collect()
    assert [(r.ingestion_id, str(r.tolls_amount)) for r in got] == [(2, "2.00")]


def test_null_keys_group_together(bronze, raw_row):
    rows = [raw_row(vendor_id="x"), raw_row(vendor_id=None), raw_row(vendor_id="2")]
    got = clean(bronze(rows)).collect()
    assert {r.ingestion_id for r in got} == {2, 3}


def test_dedupe_of_a_key_that_most_rows_share(spark):
    n = 60_000
    hot = F.when(F.col("id") % 3 < 2, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(n).select(hot.alias("k"), F.col("id").alias("version"))
    latest = latest_per_key(df, ["k"], "version")
    assert latest.count() == n // 3 + 1
    assert latest.where("k = -1").first().version == n - 2


def test_malformed_times_can_be_set_aside(bronze, raw_row):
    rows = [raw_row(), raw_row(tpep_dropoff_datetime="soon"), raw_row(tpep_pickup_datetime=None)]
    raw = bronze(rows)
    assert [r.ingestion_id for r in malformed_times(raw).collect()] == [2]
    assert {r.ingestion_id for r in without_malformed_times(raw).collect()} == {1, 3}
    assert clean(without_malformed_times(raw)).count() == 1


def trips_at(raw_row, hours, **changes):
    return [
        raw_row(
            tpep_pickup_datetime=f"2024-03-03T{h:02d}:{i:02d}:00",
            tpep_dropoff_datetime=f"2024-03-03T{h:02d}:{i + 30:02d}:00",
            **changes,
        )
        for i, h in enumerate(hours)
    ]


def test_peak_hour_tie_takes_the_earliest(bronze, raw_row):
    silver = clean(bronze(trips_at(raw_row, [9, 9, 3, 3, 7])))
    assert gold.daily_trip_summary(silver).first().peak_pickup_hour == 3


def test_peak_hour_counts_all_codes_of_a_label(bronze, raw_row):
    # Hour 8 leads only if codes 1 ('1.0') and 9, both 'Other', are counted together.
    rows = (
        trips_at(raw_row, [8, 8], payment_type="1.0", total_amount="31")
        + trips_at(raw_row, [8, 8], payment_type="9", total_amount="32")
        + trips_at(raw_row, [5, 5, 5], payment_type="9", total_amount="33")
    )
    daily = gold.daily_trip_summary(clean(bronze(rows))).collect()
    assert [(r.payment_type_label, r.total_trips, r.peak_pickup_hour) for r in daily] == [
        ("Other", 7, 8)
    ]


def test_daily_measures(bronze, raw_row):
    rows = [
        raw_row(total_amount="30.00", trip_distance="6", tip_amount="6"),
        raw_row(total_amount="41.85", trip_distance="0", tip_amount=".5", vendor_id="1.0",
                congestion_surcharge=None),
        raw_row(total_amount="10.00", vendor_id="x"),
    ]
    daily = gold.daily_trip_summary(clean(bronze(rows)), NOW)
    assert daily.dtypes == columns_of(DAILY)
    one, other = daily.orderBy(F.desc("vendor_id")).collect()
    assert (one.total_trips, one.total_passengers) == (2, 2)
    assert (one.total_revenue, one.avg_fare_per_trip) == (Decimal("71.85"), Decimal("35.93"))
    # Unknown tips count neither in the sum nor in the mean.
    assert (one.total_tips, one.avg_tip_rate) == (Decimal("6.00"), Decimal("0.2000"))
    assert (one.avg_distance_miles, one.avg_speed_mph, one.avg_cost_per_mile) == (3, 12, 5)
    assert (one.total_duration_mins, one.total_congestion_surcharge) == (60, Decimal("2.5"))
    assert (one.month_name, one.day_of_week) == ("March    ", "Sunday   ")
    assert one.last_updated_at == NOW
    assert other.vendor_id is None and other.vendor_name == "Unknown Vendor"
    assert len({one.summary_id, other.summary_id}) == 2


def test_heatmap(bronze, raw_row):
    heat = gold.hourly_demand_heatmap(clean(bronze(trips_at(raw_row, [9, 9, 3]))), NOW)
    assert heat.dtypes == columns_of(HEATMAP)
    got = {r.pickup_hour: (r.day_of_week_num, r.trip_count, r.total_revenue)
           for r in heat.collect()}
    assert got == {9: (0, 2, 60), 3: (0, 1, 30)}


def test_payment_shares(bronze, raw_row):
    rows = [
        raw_row(payment_type="1"),
        raw_row(payment_type="1.0", total_amount="60.00"),
        raw_row(payment_type="2", tip_amount="0", total_amount="10.00"),
    ]
    payment = gold.payment_analysis(clean(bronze(rows)), NOW)
    assert payment.dtypes == columns_of(PAYMENT)
    got = {(r.payment_type_code, r.payment_type_label): r for r in payment.collect()}
    assert set(got) == {(1, "Credit Card"), (1, "Other"), (2, "Cash")}
    card, cash = got[1, "Credit Card"], got[2, "Cash"]
    assert (card.pct_of_total_trips, card.pct_of_total_revenue) == (
        Decimal("33.33"), Decimal("30.00"),
    )
    assert (card.tip_frequency_pct, cash.tip_frequency_pct) == (100, 0)
    assert (cash.tipped_trips, cash.avg_tip) == (0, 0)


def test_no_trips(bronze, raw_row):
    silver = clean(bronze([raw_row(total_amount="0")]))
    for model in (gold.daily_trip_summary, gold.hourly_demand_heatmap, gold.payment_analysis):
        assert model(silver).count() == 0


def test_gold_agrees_with_silver(spark):
    silver = clean(raw_trips(spark, SF_DIR))
    n = silver.count()
    assert n == silver.select("trip_id").distinct().count() == 497
    rollup = gold.trip_rollup(silver)
    daily = gold.daily_from_rollup(rollup)
    assert daily.agg(F.sum("total_trips")).first()[0] == n
    assert gold.heatmap_from_rollup(rollup).agg(F.sum("trip_count")).first()[0] == n
    payment = gold.payment_from_rollup(rollup)
    total = payment.agg(F.sum("trip_count"), F.sum("pct_of_total_trips")).first()
    assert total[0] == n and abs(total[1] - 100) <= Decimal("0.05")
    # The same tables without a rollup of their own in between.
    assert gold.payment_analysis(silver, NOW).exceptAll(
        gold.payment_from_rollup(rollup, NOW)
    ).isEmpty()


def rounded(value, places):
    """Half away from zero, exactly; ``value`` is a fraction or None."""
    if value is None:
        return None
    unit = 10**places
    return Decimal(int(abs(value) * unit + Fraction(1, 2))) / unit * (1 if value >= 0 else -1)


def exact_mean(rows, column, places):
    known = [Fraction(r[column]) for r in rows if r[column] is not None]
    return rounded(sum(known) / len(known), places) if known else None


def test_gold_agrees_with_exact_arithmetic(spark):
    """Every group of the daily and payment tables, worked out in fractions."""
    silver = clean(raw_trips(spark, SF_DIR))
    trips = silver.collect()

    days = defaultdict(list)
    for r in trips:
        days[r.pickup_date, r.vendor_id, r.payment_type_label].append(r)
    daily = gold.daily_trip_summary(silver).collect()
    assert len(daily) == len(days) == 248
    for d in daily:
        rows = days[d.pickup_date, d.vendor_id, d.payment_type_label]
        hours = Counter(r.pickup_hour for r in rows)
        assert d.peak_pickup_hour == min(hours, key=lambda h: (-hours[h], h))
        assert d.total_trips == len(rows)
        assert d.total_revenue == sum(r.total_amount for r in rows)
        assert d.avg_fare_per_trip == exact_mean(rows, "total_amount", 2)
        assert d.avg_tip_rate == exact_mean(rows, "tip_percentage", 4)
        assert d.avg_speed_mph == exact_mean(rows, "avg_speed_mph", 2)
        assert d.avg_cost_per_mile == exact_mean(rows, "cost_per_mile", 2)
        assert d.total_duration_mins == rounded(sum(Fraction(r.trip_duration_mins) for r in rows), 2)

    kinds = defaultdict(list)
    for r in trips:
        kinds[r.payment_type_code, r.payment_type_label].append(r)
    revenue = Fraction(sum(r.total_amount for r in trips))
    for p in gold.payment_analysis(silver).collect():
        rows = kinds[p.payment_type_code, p.payment_type_label]
        assert p.avg_tip == exact_mean(rows, "tip_amount", 2)
        assert p.pct_of_total_trips == rounded(Fraction(100 * len(rows), len(trips)), 2)
        own = Fraction(sum(r.total_amount for r in rows))
        assert p.pct_of_total_revenue == rounded(100 * own / revenue, 2)
