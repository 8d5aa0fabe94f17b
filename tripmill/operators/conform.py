"""Feed records to bronze rows: rename, conform, stamp, number."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.schema import BRONZE, FEED_COLUMNS, as_table

# Ids of one run are a block of their own, so ids rise from run to run without looking at bronze.
_BLOCK_BITS = 40


def new_batch_id(day: str) -> str:
    """Key of one ingest: its day and eight random hex digits."""
    return f"batch_{day}_{uuid.uuid4().hex[:8]}"


def normalise(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feed fields under bronze names, NULL where absent; anything else but ``keep`` is dropped.

    Names match by exact case. (``withColumnsRenamed`` would also take ``vendorid``.)
    """
    present = set(df.columns)
    return df.select(
        *keep,
        *[
            (F.col(key) if key in present else F.lit(None)).cast("string").alias(column)
            for key, column in FEED_COLUMNS.items()
        ],
    )


def ingestion_id(run_id: int, page: Column, position: Column, page_size: int) -> Column:
    """Id of a record: the run's block plus its place in the feed.

    Unique, rising in feed order and from run to run, and the same again when a task is retried.
    """
    if not 0 < run_id < 1 << (63 - _BLOCK_BITS):
        raise ValueError(f"run id {run_id} leaves no block of ids")
    place = page * page_size + position
    fits = (position < page_size) & (place < (1 << _BLOCK_BITS))
    return F.when(fits, F.lit(run_id << _BLOCK_BITS) + place).otherwise(
        F.raise_error(F.lit("page longer than page_size, or page number too large"))
    )


def page_of_id(ingestion_id: Column, page_size: int) -> tuple[Column, Column]:
    """Page number and position that an ``ingestion_id`` was made of."""
    place = ingestion_id.bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1))
    return F.floor(place / page_size), place % page_size


def stamp(
    df: DataFrame, source_url: str, batch_id: str, run_id: int, ingested_at: datetime
) -> DataFrame:
    """Add the audit columns: one literal each per batch."""
    return df.withColumns(
        {
            "source_url": F.lit(source_url),
            "ingested_at": F.lit(ingested_at.isoformat(sep=" ")).cast("timestamp_ntz"),
            "batch_id": F.lit(batch_id),
            "pipeline_run_id": F.lit(run_id).cast("int"),
        }
    )


def to_bronze(
    records: DataFrame,
    source_url: str,
    batch_id: str,
    run_id: int,
    ingested_at: datetime,
    page_size: int,
) -> DataFrame:
    """Rows of ``sources.feed.records`` as bronze rows."""
    place = ingestion_id(run_id, F.col("page"), F.col("position"), page_size)
    rows = normalise(records, keep=("page", "position")).withColumn("ingestion_id", place)
    return as_table(stamp(rows, source_url, batch_id, run_id, ingested_at), BRONZE)
