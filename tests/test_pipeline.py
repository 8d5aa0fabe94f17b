"""The whole pipeline on landed pages, incremental ingest, and the warehouse tables."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmill.operators.gates import BatchRejected
from tripmill.operators.runlog import RunLog
from tripmill.plans.checks import ChecksFailed
from tripmill.plans.pipeline import run_pipeline
from tripmill.schema import (
    BRONZE,
    BRONZE_TRIPS,
    DAILY,
    GOLD_DAILY,
    GOLD_HEATMAP,
    GOLD_PAYMENT,
    HEATMAP,
    PAYMENT,
    RUN_LOG,
    RUNS,
    SILVER,
    SILVER_TRIPS,
)
from tripmill.session import build_session
from tripmill.sources.landing import Landing
from tripmill.streaming.landing import ingest_new_pages
from tests.conftest import columns_of


@pytest.fixture
def landed(tmp_path, land, feed_record):
    made = [
        feed_record(
            tpep_pickup_datetime=f"2024-03-0{1 + i % 5}T{i % 24:02d}:{i % 30:02d}:00",
            tpep_dropoff_datetime=f"2024-03-0{1 + i % 5}T{i % 24:02d}:{i % 30 + 29:02d}:00",
            payment_type=str(i % 4 + 1),
            total_amount=f"{30 + i}.25",
        )
        for i in range(250)
    ]
    return land(tmp_path / "land", made, page_size=100)


def ticking():
    at = datetime(2024, 6, 1)

    def clock():
        nonlocal at
        at += timedelta(seconds=1)
        return at

    return clock


def test_run_twice(spark, warehouse, landed):
    options = {"page_size": 100, "source_url": "file://feed", "clock": ticking()}
    first = run_pipeline(warehouse, landed, "2024-06-01", **options)
    assert (first.run_id, first.rows_ingested) == (1, 250)
    assert warehouse.read(SILVER_TRIPS).dtypes == columns_of(SILVER)
    before = warehouse.read(SILVER_TRIPS).drop("ingestion_id", "batch_id", "ingested_at").collect()

    second = run_pipeline(warehouse, landed, "2024-06-02", **options)
    assert (second.run_id, second.rows_ingested) == (2, 250)
    # Bronze doubles; the later delivery of each trip takes the place of the earlier.
    assert warehouse.read(BRONZE_TRIPS).count() == 500
    silver = warehouse.read(SILVER_TRIPS)
    assert {r.batch_id for r in silver.select("batch_id").distinct().collect()} == {second.batch_id}
    after = silver.drop("ingestion_id", "batch_id", "ingested_at").collect()
    assert sorted(before) == sorted(after) and len(after) == 250

    for table, schema in [(GOLD_DAILY, DAILY), (GOLD_HEATMAP, HEATMAP), (GOLD_PAYMENT, PAYMENT)]:
        assert warehouse.read(table).dtypes == columns_of(schema)
    assert warehouse.read(GOLD_DAILY).agg(F.sum("total_trips")).first()[0] == 250
    heat = [(r.day_of_week_num, r.pickup_hour) for r in warehouse.read(GOLD_HEATMAP).collect()]
    assert heat == sorted(heat)
    counts = [r.trip_count for r in warehouse.read(GOLD_PAYMENT).collect()]
    assert counts == sorted(counts, reverse=True)

    assert second.report.count() == 72
    assert second.report.where("status <> 'pass'").isEmpty()

    runs = warehouse.read(RUN_LOG)
    assert runs.dtypes == columns_of(RUNS)
    assert [(r.run_id, r.status, r.rows_ingested, r.duration_secs > 0)
            for r in RunLog(warehouse).latest().collect()] == [
        (2, "success", 250, True), (1, "success", 250, True),
    ]
    assert runs.collect() == RunLog(warehouse).state().collect()


def test_a_failed_run_is_logged_as_failed(warehouse, landed, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "page-00000.json").write_text("[]")
    with pytest.raises(BatchRejected):
        run_pipeline(warehouse, str(tmp_path / "empty"), "2024-06-01", "u")
    add_stray_row(warehouse)
    options = {"page_size": 100, "severities": {"run_reference": "error"}}
    with pytest.raises(ChecksFailed):
        run_pipeline(warehouse, landed, "2024-06-01", "u", **options)
    states = RunLog(warehouse).state().orderBy("run_id").collect()
    assert [(r.status, r.rows_ingested) for r in states] == [("failed", 0), ("failed", 250)]
    assert states[0].error_message.startswith("BatchRejected: batch ")
    assert states[1].error_message == "ChecksFailed: run_reference (1)"
    assert all(r.completed_at is not None for r in states)


def test_pages_left_out_are_told(warehouse, landed):
    with pytest.warns(UserWarning, match="2 landed pages"):
        result = run_pipeline(warehouse, landed, "2024-06-01", "u", page_size=100, max_pages=1)
    assert (result.rows_ingested, result.pages_left_out) == (100, 2)
    assert RunLog(warehouse).latest().first().error_message == "2 landed pages were left out"


def test_runs_of_billions_of_rows_are_logged(warehouse):
    log, rows = RunLog(warehouse), 3_000_000_000
    run_id = log.open("d", "t", "2024-06-01", datetime(2024, 6, 1))
    log.mark_ingested(run_id, rows)
    log.close(run_id, "success", rows, datetime(2024, 6, 2))
    assert log.latest().first().rows_ingested == rows


def test_the_first_error_is_the_one_raised(warehouse, landed, monkeypatch):
    def broken(*args, **more):
        raise OSError("log is away")

    monkeypatch.setattr(RunLog, "mark_ingested", lambda *args: 1 / 0)
    monkeypatch.setattr(RunLog, "close", broken)
    with pytest.raises(ZeroDivisionError) as raised:
        run_pipeline(warehouse, landed, "2024-06-01", "u", page_size=100)
    assert any("log is away" in note for note in raised.value.__notes__)


def test_malformed_times_fail_or_are_set_aside(warehouse, tmp_path, land, feed_record):
    rows = [feed_record(), feed_record(vendor_id="2", tpep_pickup_datetime="31/12/2023 25:00")]
    folder = land(tmp_path / "times", rows)
    with pytest.raises(Exception, match="31/12/2023"):
        run_pipeline(warehouse, folder, "2024-06-01", "u")
    run_pipeline(warehouse, folder, "2024-06-02", "u", set_malformed_times_aside=True)
    assert warehouse.read(SILVER_TRIPS).count() == 1


def add_stray_row(warehouse):
    """A bronze row of batch ``old``, from an unknown run."""
    known = {
        "ingestion_id": 5,
        "tpep_pickup_datetime": "2024-03-01 10:00:00",
        "tpep_dropoff_datetime": "2024-03-01 10:10:00",
        "total_amount": "6",
        "batch_id": "old",
        "pipeline_run_id": 99,
    }
    row = warehouse.spark.range(1).select(
        *[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in BRONZE.fields]
    )
    warehouse.append(row, BRONZE_TRIPS)


def test_only_the_batch_asked_for_is_read(warehouse):
    add_stray_row(warehouse)
    plan = warehouse.bronze("old")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    assert warehouse.bronze("old").count() == 1 and warehouse.bronze("new").count() == 0


def test_new_pages_are_ingested_once(warehouse, landed, tmp_path, feed_record):
    def take(run_id):
        query = ingest_new_pages(
            warehouse, landed, run_id, "u", checkpoint_dir=str(tmp_path / "progress"), page_size=100
        )
        query.awaitTermination()
        return warehouse.read(BRONZE_TRIPS)

    assert take(1).count() == 250
    assert take(2).count() == 250
    (tmp_path / "land" / "page-00003.json").write_text(json.dumps([feed_record()] * 7))
    rows = take(3)
    assert rows.count() == 257
    assert rows.select("ingestion_id").distinct().count() == 257
    assert {r.batch_id for r in rows.select("batch_id").distinct().collect()} == {
        "landed_pages_00000000",
        "landed_pages_00000001",
    }


def test_a_replaced_batch_leaves_the_others(warehouse, bronze, raw_row):
    warehouse.append(bronze([raw_row(batch_id="a"), raw_row(batch_id="b")]), BRONZE_TRIPS)
    again = bronze([raw_row(batch_id="b", vendor_id="2"), raw_row(batch_id="b", vendor_id="2")])
    warehouse.replace_batch(again, "b")
    rows = warehouse.bronze().collect()
    assert sorted((r.batch_id, r.vendor_id) for r in rows) == [("a", "1"), ("b", "2"), ("b", "2")]
    with pytest.raises(ValueError, match="batch id"):
        warehouse.replace_batch(again, "b' --")


def test_published_layout(spark, warehouse):
    table, advised = "gold.layout", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = F.when(F.col("id") % 3 < 2, -1).otherwise(F.col("id") % 5)
    df = spark.range(0, 200_000, 1, 8).select(hot.alias("k"), F.xxhash64("id").alias("v"), "id")
    spark.conf.set(advised, "200k")
    try:
        stored = warehouse.publish(
            df, table, 1, order_by=("id DESC",), cluster_by=("k",), sort_by=("v",),
            statistics=("k",),
        )
    finally:
        spark.conf.unset(advised)
    assert stored.count() == 200_000
    assert warehouse.read(table).first().id == 199_999
    files = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.count_distinct("k").alias("values"), F.max("k").alias("k")
    )
    rows = files.collect()
    # The value most rows share is spread over files.
    assert sum(r.k == -1 for r in rows) > 1
    name = rows[0].file
    one_file = [r.v for r in spark.read.parquet(name).collect()]
    assert one_file == sorted(one_file)
    described = spark.sql(f"DESCRIBE EXTENDED {warehouse.name(table)}__v1 k").collect()
    assert {r.info_name: r.info_value for r in described}["distinct_count"] == "6"


def test_versions(spark, warehouse):
    """Old versions go; the public view and the version before it stay."""
    for version in (1, 2, 9, 10):
        warehouse.publish(spark.range(version), "gold.t", version, statistics="*")
        assert warehouse.read("gold.t").count() == version
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {warehouse.name('gold')}").collect()}
    assert names == {"t", "t__v9", "t__v10"}


def test_command_line(spark, warehouse, landed, capsys, monkeypatch):
    from tripmill import __main__ as command

    monkeypatch.setattr(command, "build_session", lambda durable: spark)
    prefix = ["--prefix", warehouse.prefix]
    command.main([*prefix, "run", landed, "--source-url", "u", "--page-size", "100"])
    command.main([*prefix, "runs"])
    command.main([*prefix, "check"])
    shown = capsys.readouterr().out
    assert "run 1: 250 rows in batch batch_" in shown
    assert "trip_pipeline" in shown and "gold_coverage" in shown


def test_a_catalog_in_memory_is_refused(spark):
    if spark.conf.get("spark.sql.catalogImplementation") != "in-memory":
        pytest.skip("the tests' session has a metastore")
    with pytest.raises(RuntimeError, match="catalog is in memory"):
        build_session(durable=True)


def test_sizing_reaches_the_session(spark, landed, monkeypatch):
    from tripmill import session

    set_by_hand = spark.conf.get("spark.sql.shuffle.partitions")
    session.size_to_input(spark, Landing(spark, landed).bytes)
    assert spark.conf.get("spark.sql.shuffle.partitions") == set_by_hand
    monkeypatch.setattr(type(spark.sparkContext.getConf()), "contains", lambda self, key: False)
    keys = session.sized_for(1)
    before = {key: spark.conf.get(key) for key in keys}
    try:
        session.size_to_input(spark, Landing(spark, landed).bytes)
        assert {key: spark.conf.get(key) for key in keys} == session.sized_for(1)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    huge = session.sized_for(100 << 40)
    assert int(huge["spark.sql.shuffle.partitions"]) >= 100_000
