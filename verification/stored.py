"""Queries over tables that are really stored: landed, appended, published and read back."""

from __future__ import annotations

import uuid
import warnings
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.fixtures import raw_trips
from tripmill.operators.runlog import RunLog
from tripmill.plans.counted import observed_bronze, record
from tripmill.plans.pipeline import build_gold, check_warehouse, run_pipeline, update_silver
from tripmill.schema import BRONZE_TRIPS, GOLD_DAILY, GOLD_HEATMAP, GOLD_PAYMENT, SILVER_TRIPS
from tripmill.sources.feed import records
from tripmill.sources.landing import Landing
from tripmill.sources.warehouse import Warehouse

NOW = datetime(2024, 2, 3, 4, 5, 6)


def new_warehouse(spark: SparkSession) -> Warehouse:
    """Tables of this query alone, in the session's catalog; the last run's rows may still be read."""
    return Warehouse(spark, f"q{uuid.uuid4().hex[:12]}_").create()


def landed(spark: SparkSession, pages: DataFrame) -> str:
    """``pages`` (page, body) written as files, a folder for each page; the folder of all of them."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/landing-{uuid.uuid4().hex}"
    pages.select("page", "body").write.partitionBy("page").text(folder)
    return folder


def in_batches(raw: DataFrame) -> list[DataFrame]:
    """Raw trips in three batches; deliveries made again come in the last."""
    again, third = F.col("batch_id") == "batch_redo", F.col("ingestion_id") % 3
    parts = [~again & (third == 0), ~again & (third == 1), again | (third == 2)]
    return [raw.where(part).withColumn("batch_id", F.lit(f"batch_{i}")) for i, part in enumerate(parts)]


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver brought up to date batch by batch over the stored trip state."""
    warehouse = new_warehouse(spark)
    for version, batch in enumerate(in_batches(raw_trips(spark, sf_dir)), 1):
        warehouse.append(batch, BRONZE_TRIPS)
        update_silver(warehouse, version, buckets=8 if version == 1 else None)
    return warehouse.read(SILVER_TRIPS)


def _in_order(df: DataFrame, table: str, *keys: str) -> DataFrame:
    """Rows of an ordered view with their place in the order in which it reads; gold tables have few rows."""
    placed = df.withColumn("at", F.monotonically_increasing_id())
    numbers = [F.col(k).cast("bigint").alias(f"key{i}") for i, k in enumerate(keys, 1)]
    return placed.select(
        F.lit(table).alias("table_name"),
        F.row_number().over(Window.orderBy("at")).cast("bigint").alias("place"),
        *numbers,
        F.col("trip_count").alias("n"),
    )


def stored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of stored bronze, silver and daily tables, and the two ordered views row by row."""
    warehouse = new_warehouse(spark)
    for batch in in_batches(raw_trips(spark, sf_dir)):
        warehouse.append(batch, BRONZE_TRIPS)
    update_silver(warehouse, 1, buckets=8)
    build_gold(warehouse, 1, NOW)
    found = _in_order(warehouse.read(GOLD_HEATMAP), GOLD_HEATMAP, "day_of_week_num", "pickup_hour")
    payment = warehouse.read(GOLD_PAYMENT).withColumn("size", F.length("payment_type_label"))
    found = found.unionByName(_in_order(payment, GOLD_PAYMENT, "payment_type_code", "size"))
    none = F.lit(None).cast("bigint")
    for table in (SILVER_TRIPS, GOLD_DAILY):
        count = warehouse.read(table).agg(F.count("*").alias("n"))
        found = found.unionByName(
            count.select(F.lit(table).alias("table_name"), none.alias("place"), none.alias("key1"), none.alias("key2"), "n")
        )
    number = F.substring("batch_id", -1, 1).cast("bigint")
    per_batch = warehouse.bronze().groupBy(number.alias("key1")).agg(F.count("*").alias("n"))
    return found.unionByName(
        per_batch.select(F.lit(BRONZE_TRIPS).alias("table_name"), none.alias("place"), "key1", none.alias("key2"), "n")
    )


def stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check report of stored tables from counts taken as they were written; one batch has none and is read."""
    warehouse = new_warehouse(spark)
    for version, batch in enumerate(in_batches(raw_trips(spark, sf_dir)), 1):
        observed = observed_bronze(batch)
        warehouse.append(observed.df, BRONZE_TRIPS)
        if version != 2:
            record(warehouse, BRONZE_TRIPS, version, observed.counts, f"batch_{version - 1}")
        update_silver(warehouse, version, buckets=8 if version == 1 else None)
    build_gold(warehouse, 1, NOW)
    report = check_warehouse(warehouse, {"run_reference": "error"})
    return report.select("check_name", "table_name", "failing", "severity", "status")


def landed_files(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Records of pages that were written to files and read by way of their manifest."""
    return records(Landing(spark, landed(spark, pages)).pages())


def whole_run(spark: SparkSession, pages: DataFrame, page_size: int) -> DataFrame:
    """The published daily table after two whole runs, the first of which takes two pages only.

    Later deliveries of a trip replace earlier ones across runs; the run log and the recorded checks ride along.
    """
    warehouse = new_warehouse(spark)
    folder = landed(spark, pages)
    clock = lambda: NOW
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        run_pipeline(
            warehouse, Landing(spark, folder, page_size, max_pages=2), "2024-02-03", "fixture://events",
            buckets=8, clock=clock,
        )
    run_pipeline(warehouse, Landing(spark, folder, page_size), "2024-02-04", "fixture://events", clock=clock)
    states = RunLog(warehouse).state().agg(F.count_if(F.col("status") == "success").alias("runs"))
    daily = warehouse.read(GOLD_DAILY).drop("last_updated_at")
    return daily.withColumn("runs", states.scalar())
