"""Landed pages to bronze rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tripmill.operators.conform import to_bronze
from tripmill.sources.feed import PAGE_SIZE, records
from tripmill.sources.landing import Landing


def bronze_of(
    landing: Landing, run_id: int, batch_id: str, ingested_at: datetime, source_url: str
) -> DataFrame:
    """Bronze rows of the chosen pages of a landed extract."""
    rows = records(landing.pages())
    return to_bronze(rows, source_url, batch_id, run_id, ingested_at, landing.page_size)


def pages_left_out(
    spark: SparkSession,
    landing_dir: str,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    stop_at_short_page: bool = False,
) -> int:
    """Number of landed pages that these options leave out."""
    return Landing(spark, landing_dir, page_size, max_pages, stop_at_short_page).left_out()


def ingest(
    spark: SparkSession,
    landing_dir: str,
    run_id: int,
    batch_id: str,
    ingested_at: datetime,
    source_url: str,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    stop_at_short_page: bool = False,
) -> DataFrame:
    """Bronze rows of one landed extract: of all its pages.

    ``stop_at_short_page`` ends it at the first page that is short, empty or absent, and ``max_pages``
    bounds it; ``pages_left_out`` tells how many landed pages that drops. Page numbers are checked from
    file names before anything is read.
    """
    landing = Landing(spark, landing_dir, page_size, max_pages, stop_at_short_page)
    return bronze_of(landing, run_id, batch_id, ingested_at, source_url)
