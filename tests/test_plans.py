"""Physical plans: what is read, shuffled and joined."""

import re
from datetime import datetime

import pytest

from tripmill.fixtures import raw_trips
from tripmill.plans import gold
from tripmill.plans.bronze import ingest
from tripmill.plans.checks import gold_coverage, run_checks
from tripmill.plans.silver import clean
from tripmill.schema import BRONZE_TRIPS, SILVER_TRIPS
from tripmill.sources.feed import newest
from tests.conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    from tripmill.sources.warehouse import Warehouse

    warehouse = Warehouse(spark, prefix="plans_").create()
    warehouse.append(raw_trips(spark, SF_DIR), BRONZE_TRIPS)
    warehouse.publish(clean(warehouse.bronze()), SILVER_TRIPS, 1)
    return warehouse


def test_silver_shuffles_once_and_prunes_before_it(stored):
    text = plan(clean(stored.bronze()))
    assert len(re.findall(r"Exchange ", text)) == 1
    below = text[text.index("Exchange ") :]
    # One row per key and task leaves the map side; the rules on key columns come before the sort.
    assert re.search(r"WindowGroupLimit .*Partial", below)
    assert "INTERVAL '0 06:00:00'" in below and "cast(total_amount" in below
    # Derived columns are made after the shuffle.
    assert "md5" not in below and "date_format" not in below
    assert "PushedFilters: [IsNotNull(tpep_dropoff_datetime), IsNotNull(tpep_pickup_datetime)" in (
        text.replace("IsNotNull(total_amount), ", "")
    )
    # The rules on other columns must not get below the window.
    assert "passenger_count" in text and ">= 0)" not in below


def test_gold_is_hash_aggregation_over_few_columns(stored):
    silver = stored.read(SILVER_TRIPS)
    for model in (gold.daily_trip_summary, gold.hourly_demand_heatmap, gold.payment_analysis):
        text = plan(model(silver))
        assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
        assert "store_and_fwd_flag" not in text and "trip_id" not in text
        assert "Window" not in text
    read = re.search(r"FileScan parquet [^\[]*\[(.*?)\]", plan(gold.hourly_demand_heatmap(silver)))[1]
    assert "total_amount" in read and "fare_amount" not in read


def test_ingest_of_all_pages_does_not_shuffle(spark, tmp_path, land, feed_record):
    folder = land(tmp_path / "land", [feed_record()])
    rows = ingest(spark, folder, 1, "b", datetime(2024, 1, 1), "u", stop_at_short_page=False)
    assert "Exchange" not in plan(rows)


def test_newest_sorts_no_input_rows(stored):
    rows = stored.bronze().select("ingestion_id", "tpep_pickup_datetime")
    text = plan(newest(rows, "tpep_pickup_datetime", "ingestion_id", 10_000))
    main = text[: text.index("Subquery")]
    # A scalar cut-off at the scan, then the k best rows of every task; only days are sorted.
    assert "TakeOrderedAndProject(limit=10000" in main and "Sort [" not in main
    assert "REBALANCE" not in text and "rangepartitioning" not in text


def test_totals_come_from_the_groups_of_the_same_read(stored):
    shares = gold.payment_analysis(stored.read(SILVER_TRIPS))
    shares.collect()
    text = plan(shares)
    final = text.split("\n+- == Initial Plan ==")[0]
    assert "Join" not in final and "Window" not in final
    assert "ReusedExchange" in final


def test_layout_shuffles_parsed_columns_only(stored, monkeypatch):
    from tripmill.plans import pipeline

    taken = {}
    monkeypatch.setattr(stored, "publish", lambda df, *rest, **more: taken.update(df=df, **more))
    pipeline.build_silver(stored, 7)
    text = plan(taken["df"])
    below = text[text.index("REBALANCE") :]
    assert taken["statistics"] == pipeline.SILVER_STATISTICS
    assert "md5" in text and "md5" not in below and "date_format" not in below
    assert "trip_duration_mins" not in below and "cost_per_mile" not in below


def test_checks_of_silver_scan_it_three_times(stored):
    silver = stored.read(SILVER_TRIPS)
    assert plan(run_checks({SILVER_TRIPS: silver})).count("FileScan") == 3
    assert "LeftAnti" in plan(gold_coverage(silver, gold.daily_trip_summary(silver)))
