"""The trip state, landing manifest, id checks, observed counts, claims, leases, statistics and skipping."""

import json
import random
import re
import warnings
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.test_plans import plan
from tripmill.fixtures import raw_trips
from tripmill.operators import quality, unique
from tripmill.operators.runlog import RunLog
from tripmill.plans import counted, pipeline
from tripmill.plans.checks import COLUMN_CHECKS, row_conditions, run_checks
from tripmill.plans.pipeline import build_silver, run_pipeline, update_silver
from tripmill.plans.silver import clean, picked_up_between
from tripmill.plans.state import advance_state, latest_rows, merged
from tripmill.schema import BRONZE_TRIPS, RUN_LOG_EVENTS, SILVER_TRIPS, TRIP_STATE
from tripmill.sources.landing import Landing
from tripmill.sources.warehouse import Warehouse
from tripmill.streaming.landing import ingest_new_pages

AT = datetime(2024, 6, 1)


def in_batches(warehouse):
    """The fixture in three batches: later deliveries of a trip, valid and not, come in the last."""
    raw = raw_trips(warehouse.spark, SF_DIR)
    for number, chosen in enumerate(
        ["redo = 0 AND n % 3 = 0", "redo = 0 AND n % 3 = 1", "redo = 1 OR n % 3 = 2"], 1
    ):
        parts = raw.withColumns({"redo": F.col("pipeline_run_id") - 1, "n": F.col("ingestion_id")}).where(chosen)
        yield number, parts.drop("redo", "n").withColumn("batch_id", F.lit(f"part {number}"))


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_silver_by_batches_equals_the_full_rebuild(warehouse):
    for number, batch in in_batches(warehouse):
        warehouse.append(batch, BRONZE_TRIPS)
        silver = update_silver(warehouse, number, buckets=3 if number == 1 else None)
        assert same_rows(silver, clean(warehouse.bronze()))
        assert warehouse.buckets_of(TRIP_STATE, number) == 3
        # One file for each bucket: rows stayed where they were.
        assert len(silver.inputFiles()) == len(warehouse.stored(TRIP_STATE, number).inputFiles()) == 3
    state = warehouse.stored(TRIP_STATE, 3)
    assert state.count() > silver.count() == 497  # invalid latest rows are remembered
    wanted = clean(warehouse.bronze())
    assert same_rows(build_silver(warehouse, 4), wanted)
    # Other ways to the same rows: again, other buckets, from scratch.
    for version, options in ((5, {"also": ["part 1"]}), (6, {"also": ["part 2"], "buckets": 5}), (7, {"from_scratch": True})):
        assert same_rows(update_silver(warehouse, version, **options), wanted)


def test_an_invalid_latest_row_hides_an_older_valid_one_across_batches(warehouse, bronze, raw_row):
    valid = raw_row(batch_id="a")
    warehouse.append(bronze([valid]), BRONZE_TRIPS)
    assert update_silver(warehouse, 1, buckets=2).count() == 1
    warehouse.append(bronze([raw_row(batch_id="b", passenger_count="25")]), BRONZE_TRIPS)
    assert update_silver(warehouse, 2).count() == 0
    # An older delivery that comes late changes nothing, a newer one does.
    late = {**valid, "batch_id": "c", "ingestion_id": 0}
    warehouse.append(bronze([late]), BRONZE_TRIPS)
    assert update_silver(warehouse, 3).count() == 0
    warehouse.append(bronze([raw_row(batch_id="d")]), BRONZE_TRIPS)
    assert update_silver(warehouse, 4).count() == 1
    assert advance_state(warehouse, 5).inputFiles() == warehouse.stored(TRIP_STATE, 4).inputFiles()


def test_only_the_new_batch_is_shuffled(warehouse):
    for number, batch in in_batches(warehouse):
        warehouse.append(batch, BRONZE_TRIPS)
        if number < 3:
            update_silver(warehouse, number, buckets=4)
    text = plan(merged(warehouse.stored(TRIP_STATE, 2), latest_rows(warehouse.bronze("part 3")), 4))
    history = next(line for line in text.splitlines() if "trip_state__v2" in line)
    above = text[: text.index(history)].splitlines()
    depth = len(history) - len(history.lstrip(" :+-"))
    parents = []
    for line in reversed(above):  # the lines over the scan, each less deep than the one below
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            parents.append(line)
            depth = own
    assert any("FullOuter" in line for line in parents) and not any("Exchange" in line for line in parents)
    assert "Bucketed: true" in plan(warehouse.stored(TRIP_STATE, 2).groupBy("trip_id").count())
    assert "PartitionFilters: [isnotnull(batch_id" in text


def test_a_run_makes_up_for_a_failed_one(warehouse, tmp_path, land, feed_record, monkeypatch):
    first = land(tmp_path / "one", [feed_record(total_amount="31")])
    monkeypatch.setattr(pipeline, "update_silver", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_pipeline(warehouse, first, "2024-06-01", "u")
    monkeypatch.undo()
    run_pipeline(warehouse, land(tmp_path / "two", [feed_record(total_amount="32")]), "2024-06-02", "u")
    assert warehouse.read(SILVER_TRIPS).count() == 2


# Landed pages


def discovered(spark):
    return spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED().getCount()


def test_a_folder_is_listed_once(spark, tmp_path, land, feed_record):
    folder = land(tmp_path / "land", [feed_record() for _ in range(45)], page_size=10)
    (tmp_path / "land" / "page-00002.json").write_text(json.dumps([feed_record()] * 3))
    before = discovered(spark)
    landing = Landing(spark, folder, page_size=10, stop_at_short_page=True)
    assert (landing.files, landing.left_out()) == (5, 2)
    assert landing.bytes == sum(f.stat().st_size for f in (tmp_path / "land").iterdir())
    assert sorted(r.page for r in landing.pages().select("page").collect()) == [0, 1, 2]
    assert landing.manifest.count() == 5
    assert discovered(spark) - before == 5
    # Sizes and numbers come from the listing: no content is read for them.
    assert "content" not in plan(landing.manifest)


def test_a_run_lists_its_pages_once(spark, warehouse, tmp_path, land, feed_record, monkeypatch):
    folder = land(tmp_path / "land", [feed_record() for _ in range(30)], page_size=10)
    listed = []
    reader = type(spark.read)
    for name in ("load", "text"):
        real = getattr(reader, name)
        monkeypatch.setattr(reader, name, lambda self, *a, real=real, **k: listed.append(a) or real(self, *a, **k))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        run_pipeline(warehouse, folder, "2024-06-01", "u", page_size=10, max_pages=2)
    assert sum(folder in map(str, a) for a in listed) == 1


def test_compressed_pages_and_pages_in_folders(spark, tmp_path, feed_record):
    import gzip

    (tmp_path / "zip").mkdir()
    (tmp_path / "zip" / "page-0.json.gz").write_bytes(gzip.compress(json.dumps([feed_record()] * 4).encode()))
    (tmp_path / "zip" / "page-1.json").write_text(json.dumps([feed_record()] * 2))
    landing = Landing(spark, str(tmp_path / "zip"))
    assert sorted(len(json.loads(r.body)) for r in landing.pages().collect()) == [2, 4]
    for page in (0, 1):
        (tmp_path / "parted" / f"page={page}").mkdir(parents=True)
        (tmp_path / "parted" / f"page={page}" / "part-00007.txt").write_text("[]\n")
    assert sorted(r.page for r in Landing(spark, str(tmp_path / "parted")).manifest.collect()) == [0, 1]
    (tmp_path / "none").mkdir()
    none = Landing(spark, str(tmp_path / "none"))
    assert (none.files, none.bytes, none.left_out(), none.pages().count()) == (0, 0, 0, 0)


# Repeated ids


def id_rows(kind):
    rng = random.Random(kind)
    block = 1 << 40
    rows = {
        "disjoint": [(run * block + i, f"b{run}") for run in (1, 2, 3) for i in range(4000)],
        "inside": [(block + i % 900, "a") for i in range(1000)],
        "across": [(block + i, "a") for i in range(500)] + [(block + 480 + i, "b") for i in range(500)],
        "sparse": [(rng.randrange(-(1 << 60), 1 << 60), "d") for _ in range(300)] * 2 + [(7, "e")],
        "mixed": [(5, None), (5, None), (None, "a"), (None, None), (-5, "n"), (-(1 << 62), "n"), (block, "a"), (block, "z")],
        "none": [],
    }[kind]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("kind", ["disjoint", "inside", "across", "sparse", "mixed", "none"])
def test_repeated_ids_equal_a_grouping(spark, kind):
    df = spark.createDataFrame(id_rows(kind), "id long, batch string")
    got = unique.repeated_ids(df, "id", "batch")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.duplicates(df, "id").collect()))
    # Dense ids that differ are not grouped: nothing is left of them in the plan.
    assert ("LocalTableScan <empty>" in plan(got)) == (kind in ("disjoint", "none"))


def test_intervals_that_overlap_are_one_group():
    made = [unique.Interval(b, low, high, n) for b, low, high, n in (("a", 0, 9, 10), ("b", 9, 20, 2), ("c", 21, 30, 1), ("d", 5, 6, 1))]
    groups = unique.clusters(made)
    assert [[i.batch for i in g] for g in groups] == [["a", "d", "b"], ["c"]]
    assert unique.is_dense(groups[0]) and unique.clusters([]) == []


def test_ids_of_batches_are_not_shuffled(spark):
    df = spark.range(0, 400_000, 1, 4).select((F.col("id") + (1 << 40)).alias("id"), F.lit("x").alias("batch"))
    text = plan(unique.crowded_bitmaps(df, "id"))
    assert len(re.findall("Exchange ", text)) == 1 and "partial_bitmap_construct_agg" in text
    assert unique.repeated_ids(df, "id", "batch").isEmpty()


# Counts taken while writing


def test_a_report_from_recorded_counts_is_the_same(spark, warehouse, tmp_path, land, feed_record):
    made = [feed_record(vendor_id=v, payment_type=p, total_amount=str(30 + i)) for i, (v, p) in enumerate(
        [("1", "1"), ("7", "9"), (None, "2"), ("2", None), ("00000000001", "1")])]
    made.append(feed_record(fare_amount="90"))
    options = {"source_url": "u", "page_size": 10}
    run_pipeline(warehouse, land(tmp_path / "one", made), "2024-06-01", **options)
    result = run_pipeline(warehouse, land(tmp_path / "two", made[:3]), "2024-06-02", **options)
    names = [r.table_name for r in result.report.select("table_name").distinct().collect() if r.table_name]
    tables = {name: warehouse.read(name) for name in names}
    tables["metadata.pipeline_runs"] = warehouse.read("metadata.pipeline_runs")
    assert same_rows(result.report, run_checks(tables))
    assert {r.check_name: r.failing for r in result.report.collect()}["not_null:bronze.raw_taxi_trips.vendor_id"] == 2


def scans(df, table):
    """Column lists that the plan reads of a table."""
    return re.findall(rf"FileScan parquet \S*{re.escape(table)}\S*?\[(.*?)\]", plan(df))


def test_reports_read_no_rows_that_were_counted(warehouse, tmp_path, land, feed_record):
    run_pipeline(warehouse, land(tmp_path / "one", [feed_record()]), "2024-06-01", "u")
    report = pipeline.check_warehouse(warehouse)
    wide = {c.column for c in COLUMN_CHECKS if c.table == BRONZE_TRIPS} - {"ingestion_id", "batch_id"}
    read = " ".join(scans(report, "raw_taxi_trips"))
    assert not any(column in read for column in wide)
    assert "trip_duration_mins" not in " ".join(scans(report, "cleaned_taxi_trips"))
    names = (BRONZE_TRIPS, SILVER_TRIPS)
    without = run_checks({name: warehouse.read(name) for name in names})
    assert "total_amount" in " ".join(scans(without, "raw_taxi_trips"))
    # Grouping silver by trip needs no shuffle: its buckets have each trip together.
    stored = warehouse.stored(SILVER_TRIPS, 1)
    assert "Exchange" not in plan(quality.duplicates(stored, "trip_id"))


def test_batches_without_records_are_read(warehouse, bronze, raw_row):
    rows = bronze([raw_row(batch_id="a", vendor_id=None), raw_row(batch_id="a")])
    observed = counted.observed_bronze(rows)
    warehouse.append(observed.df, BRONZE_TRIPS)
    assert (observed.counts[counted.ROWS], observed.counts[counted.NULL_CRITICAL]) == (2, 0)

    def failing():
        return {r.check_name: r.failing for r in counted.bronze_counts(warehouse).rows.collect()}

    name = "not_null:bronze.raw_taxi_trips.vendor_id"
    assert failing()[name] == 1  # not recorded yet: read
    counted.record(warehouse, BRONZE_TRIPS, 1, {**observed.counts, name: 41}, "a")
    assert failing()[name] == 41  # recorded: not read
    warehouse.append(bronze([raw_row(batch_id="b", vendor_id=None)]), BRONZE_TRIPS)
    assert failing()[name] == 42
    warehouse.append(bronze([raw_row(batch_id="a", vendor_id=None)]), BRONZE_TRIPS)
    assert failing()[name] == 3  # more rows than recorded: read
    warehouse.replace_batch(bronze([raw_row(batch_id="b")]), "b")
    assert failing()[name] == 2
    assert set(failing()) == set(row_conditions(BRONZE_TRIPS))


def test_no_rows_have_no_failures(warehouse):
    rows = counted.bronze_counts(warehouse).rows.collect()
    assert {r.failing for r in rows} == {0} and len(rows) == len(row_conditions(BRONZE_TRIPS))


# Run ids


def test_two_drivers_get_two_run_ids(warehouse, monkeypatch):
    one, other = RunLog(warehouse), RunLog(Warehouse(warehouse.spark, warehouse.prefix))
    got = []
    real = RunLog._append

    def between(self, event):  # another driver opens a run after this one has read the log
        monkeypatch.setattr(RunLog, "_append", real)
        got.append(other.open("d", "t", "2024-06-01", AT))
        real(self, event)

    monkeypatch.setattr(RunLog, "_append", between)
    got.append(one.open("d", "t", "2024-06-01", AT))
    assert sorted(got) == [1, 2]
    assert sorted(r.run_id for r in one.state().collect()) == [1, 2]
    assert one.open("d", "t", "2024-06-01", AT) == 3
    assert not warehouse.create_once(RUN_LOG_EVENTS, "run-3") and warehouse.create_once(RUN_LOG_EVENTS, "run-4")
    assert one.open("d", "t", "2024-06-01", AT) == 5  # 4 was claimed by a driver that was lost


# Leases


def test_a_reader_keeps_its_version(spark, warehouse):
    for version in (1, 2):
        warehouse.publish(spark.range(version), "gold.t", version)
    with warehouse.reading("gold.t") as rows:
        for version in (3, 4, 5, 6):
            warehouse.publish(spark.range(version), "gold.t", version)
        assert rows.count() == 2
        with warehouse.reading("gold.t") as newer:
            assert newer.count() == 6
    warehouse.publish(spark.range(7), "gold.t", 7)
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {warehouse.name('gold')} LIKE 't*'").collect()}
    assert names == {"t", "t__v6", "t__v7"}


def test_a_lease_expires(spark, warehouse):
    warehouse.publish(spark.range(1), "gold.t", 1)
    with warehouse.reading("gold.t", seconds=60, clock=lambda: AT):
        assert warehouse.leased("gold.t", AT + timedelta(seconds=59)) == {1}
        assert warehouse.leased("gold.t", AT + timedelta(seconds=61)) == set()


# Statistics and skipping


def test_statistics_choose_the_join(spark, warehouse):
    """A filter that leaves few rows makes its side small enough to send, which only statistics can tell."""
    few = spark.range(20_000).select((F.col("id") % 500).alias("vendor_id"), F.col("id").alias("trip_id"), F.rand(1).alias("x"))
    warehouse.publish(few, "silver.t", 1, statistics=("vendor_id", "trip_id"))
    warehouse.publish(few, "silver.u", 1)
    size = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(size)
    spark.conf.set(size, "20k")
    try:
        other = spark.range(1_000_000).withColumnRenamed("id", "trip_id")
        join = {t: plan(warehouse.read(f"silver.{t}").where("vendor_id = 7").join(other, "trip_id")) for t in "tu"}
        assert "BroadcastHashJoin" in join["t"] and "BroadcastHashJoin" not in join["u"]
    finally:
        spark.conf.set(size, before)


def scan_metrics(df):
    """Rows that the scans of a finished query gave, and the files they read."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan()
    if final.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        final = final.executedPlan()
    leaves = final.collectLeaves()
    rows = files = 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numOutputRows"):
            rows += metrics.apply("numOutputRows").value()
        if metrics.contains("numFiles"):
            files += metrics.apply("numFiles").value()
    return rows, files


@pytest.mark.parametrize("way", ["buckets", "rebalance"])
def test_one_day_reads_a_bounded_share(spark, warehouse, bronze, raw_row, monkeypatch, way):
    days = 40
    raw = spark.range(days * 500).select("id", (F.col("id") % days).alias("d"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int"))
    made = raw.select(
        *[
            {
                "ingestion_id": F.col("id"),
                "tpep_pickup_datetime": F.concat(start.cast("string"), F.lit(" 10:"), F.lpad((F.col("id") % 50).cast("string"), 2, "0"), F.lit(":00")),
                "tpep_dropoff_datetime": F.concat(start.cast("string"), F.lit(" 11:00:00")),
                "total_amount": (F.col("id") % 997 + 30).cast("string"),
                "batch_id": F.lit("b"),
            }.get(f.name, F.lit(raw_row().get(f.name))).cast(f.dataType).alias(f.name)
            for f in bronze([raw_row()]).schema.fields
        ]
    )
    warehouse.append(made, BRONZE_TRIPS)
    # Small row groups, as a large table has many of them.
    small = {"parquet.block.size": "30000", "parquet.block.size.row.check.min": "10", "parquet.page.size.row.check.min": "10",
             "parquet.page.row.count.limit": "100"}
    monkeypatch.setattr(pipeline, "SILVER_OPTIONS", pipeline.SILVER_OPTIONS | small)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        silver = update_silver(warehouse, 1, buckets=4) if way == "buckets" else build_silver(warehouse, 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    total = silver.count()
    day = picked_up_between(silver, datetime(2024, 1, 20), datetime(2024, 1, 21))
    rows, files = scan_metrics(day.select("trip_id", "pickup_datetime", "total_amount"))
    wanted = day.count()
    assert 0 < wanted <= rows <= 0.25 * total
    assert wanted == silver.where("to_date(pickup_datetime) = '2024-01-20'").count()
    assert files <= len(silver.inputFiles())
    one = silver.first().trip_id
    found, _ = scan_metrics(silver.where(F.col("trip_id") == one).select("trip_id", "total_amount"))
    assert found <= 0.25 * total  # the Bloom filter leaves out most row groups


# Pages taken by a stream


def test_a_page_that_comes_again_is_refused_or_left_out(warehouse, tmp_path, land, feed_record):
    folder = tmp_path / "land"
    land(folder, [feed_record() for _ in range(20)], page_size=10)

    def take(on_repeated, name):
        query = ingest_new_pages(
            warehouse, str(folder), 1, "u", stream="s", checkpoint_dir=str(tmp_path / name), page_size=10,
            on_repeated=on_repeated,
        )
        query.awaitTermination()
        return warehouse.bronze()

    assert take("fail", "progress").count() == 20
    (folder / "again-page-00001.json").write_text(json.dumps([feed_record()] * 3))
    (folder / "page-00002.json").write_text(json.dumps([feed_record()] * 4))
    with pytest.raises(Exception, match="page 1 of run 1 occurs twice in the stream"):
        take("fail", "progress")
    assert warehouse.bronze().count() == 20
    rows = take("skip", "progress")
    assert rows.count() == 24 and rows.select("ingestion_id").distinct().count() == 24
    for name in ("a-page-00003.json", "b-page-00003.json"):
        (folder / name).write_text(json.dumps([feed_record()] * 2))
    with pytest.raises(Exception, match="page 3 of run 1 occurs twice in batch"):
        take("skip", "progress")
    assert warehouse.bronze().count() == 24
    with pytest.raises(ValueError, match="on_repeated"):
        take("never", "progress")
