"""Incremental ingest: new landed pages go to bronze as they are found."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill.operators.conform import page_of_id, to_bronze
from tripmill.schema import BRONZE_TRIPS, TAKEN_PAGES
from tripmill.sources.feed import PAGE_SIZE, page_columns, records
from tripmill.sources.warehouse import Warehouse

#: What to do with a page number that a run has taken before: refuse the micro-batch, or leave the page out.
FAIL, SKIP = "fail", "skip"


def taken_pages(warehouse: Warehouse, run_id: int, batch_id: str, page_size: int) -> DataFrame:
    """``(page, records, length)`` of a stored batch: its records, and how many its last position tells.

    Read from the ids alone; a page without records has none.
    """
    page, position = page_of_id(F.col("ingestion_id"), page_size)
    ids = warehouse.bronze(batch_id).where(F.col("pipeline_run_id") == run_id)
    return ids.groupBy(page.alias("page")).agg(
        F.count("*").alias("records"), (F.max(position) + 1).alias("length")
    )


def ingest_new_pages(
    warehouse: Warehouse,
    landing_dir: str,
    run_id: int,
    source_url: str,
    stream: str = "landed_pages",
    checkpoint_dir: str | None = None,
    page_size: int = PAGE_SIZE,
    on_repeated: str = FAIL,
) -> StreamingQuery:
    """Start ingest of the pages that no earlier call has taken; it ends when they are in.

    Each micro-batch is one bronze batch, named by ``stream`` and micro-batch number. A micro-batch
    tried again after a failure replaces its own partition, so its rows are there once. Ids are made of
    page numbers, so every taken page is noted, and a number that comes again within a run is refused: its
    micro-batch is taken out of bronze and the query fails, or with ``on_repeated="skip"`` goes in without that
    page. Two files of one page in one micro-batch are always an error. Progress is kept under
    ``checkpoint_dir``, by default in the cluster's ``spark.checkpoint.dir``; one stream, one checkpoint.
    """
    if on_repeated not in (FAIL, SKIP):
        raise ValueError(f"on_repeated is {FAIL!r} or {SKIP!r}, not {on_repeated!r}")
    spark = warehouse.spark
    if checkpoint_dir is None:
        checkpoint_dir = f"{spark.conf.get('spark.checkpoint.dir')}/{stream}"

    def write(pages: DataFrame, micro_batch: int) -> None:
        # A micro-batch has a session of its own, which knows the files that it has just replaced.
        take(Warehouse(pages.sparkSession, warehouse.prefix), pages, micro_batch)
        spark.catalog.refreshTable(warehouse.name(BRONZE_TRIPS))

    def take(warehouse: Warehouse, pages: DataFrame, micro_batch: int) -> None:
        batch_id = f"{stream}_{micro_batch:08d}"
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = to_bronze(records(pages), source_url, batch_id, run_id, now, page_size)
        warehouse.replace_batch(rows, batch_id)

        def refuse(page: int, where: str) -> None:
            warehouse.drop_batch(batch_id)
            raise ValueError(f"page {page} of run {run_id} occurs twice {where}")

        taken = taken_pages(warehouse, run_id, batch_id, page_size)
        double = taken.where("records > length").agg(F.min("page")).first()[0]
        if double is not None:
            refuse(double, f"in batch {batch_id}")
        mine = (F.col("stream") == stream) & (F.col("run_id") == run_id)
        before = warehouse.read(TAKEN_PAGES).where(mine & (F.col("micro_batch") != micro_batch))
        repeated = taken.join(before.select("page").distinct(), "page", "left_semi").select("page")
        first = repeated.agg(F.min("page")).first()[0]
        if first is not None and on_repeated == FAIL:
            refuse(first, "in the stream")
        if first is not None:
            again = repeated.collect()  # of one micro-batch
            kept = pages.where(~F.col("page").isin([row.page for row in again]))
            rows = to_bronze(records(kept), source_url, batch_id, run_id, now, page_size)
            warehouse.replace_batch(rows, batch_id)
        warehouse.append(
            taken_pages(warehouse, run_id, batch_id, page_size).select(
                F.lit(stream).alias("stream"),
                F.lit(run_id).cast("bigint").alias("run_id"),
                F.col("page").cast("bigint").alias("page"),
                F.lit(micro_batch).cast("bigint").alias("micro_batch"),
            ),
            TAKEN_PAGES,
        )

    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .load(landing_dir)
        .select(*page_columns())
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
