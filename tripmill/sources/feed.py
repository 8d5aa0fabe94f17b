"""The record feed: landed JSON pages, and newest-first extracts of a record table.

A page is one file holding one JSON array of flat records, with its page number, from 0, at the end
of its name (``page-00042.json``). Pages are read as whole texts, so the place of a record in the
feed is known from page number and array position alone, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import FEED_RECORD

# Fixed value: the feed's page size.
PAGE_SIZE = 1000


def _page_number() -> Column:
    # The last number before the extensions.
    digits = F.regexp_extract(
        F.col("_metadata.file_name"), r"([0-9]+)(\.[A-Za-z][A-Za-z0-9]*)*$", 1
    )
    return F.when(digits != "", digits.cast("bigint")).otherwise(
        F.raise_error(F.lit("landed page without a page number in its file name"))
    )


def page_columns() -> list[Column]:
    """``page`` and ``body`` of a landed file; also serves streaming reads."""
    return [_page_number().alias("page"), F.col("value").alias("body")]


def read_pages(spark: SparkSession, landing_dir: str) -> DataFrame:
    """One row ``(page, body)`` per landed file."""
    return spark.read.text(landing_dir, wholetext=True).select(*page_columns())


def _ends(pages: DataFrame, page_size: int) -> DataFrame:
    """One row ``page``: the lowest number that is 0 or follows a full page, and is not full itself."""
    mark = "struct<page: bigint, follows: boolean, full: boolean>"
    is_full = F.struct("page", F.lit(False), F.lit(True)).cast(mark)
    follows = F.struct(F.col("page") + 1, F.lit(True), F.lit(False)).cast(mark)
    marks = pages.where(F.json_array_length("body") >= page_size).select(
        F.inline(F.array(is_full, follows))
    )
    start = pages.sparkSession.range(1).select(
        F.col("id").alias("page"), F.lit(True).alias("follows"), F.lit(False).alias("full")
    )
    return (
        marks.unionByName(start)
        .groupBy("page")
        .agg(F.max("follows").alias("follows"), F.max("full").alias("full"))
        .where("follows AND NOT full")
        .agg(F.min("page").alias("page"))
    )


def last_page(pages: DataFrame, page_size: int = PAGE_SIZE, max_pages: int | None = None) -> int:
    """Number of the page with which an extract ends: the first that is short, empty or absent."""
    if max_pages is not None:
        pages = pages.where(F.col("page") < max_pages)
    end = _ends(pages, page_size).first().page
    return end if max_pages is None else min(end, max_pages - 1)


def pages_to_last(
    pages: DataFrame, page_size: int = PAGE_SIZE, max_pages: int | None = None
) -> DataFrame:
    """Pages up to and including the first that is short, empty or absent; at most ``max_pages``."""
    if max_pages is not None:
        pages = pages.where(F.col("page") < max_pages)
    return pages.where(F.col("page") <= _ends(pages, page_size).scalar())


def records(pages: DataFrame, record: T.StructType = FEED_RECORD) -> DataFrame:
    """Rows of the pages: ``page``, ``position`` (0-based) and the feed's fields as text.

    Unknown fields are dropped, absent ones are NULL. A page that is not well-formed JSON is an
    error.
    """
    parsed = F.from_json("body", T.ArrayType(record), {"mode": "FAILFAST"})
    return pages.select("page", F.posexplode(parsed).alias("position", "record")).select(
        "page", "position", "record.*"
    )


def _order(time_column: str, tie_break: str) -> list[Column]:
    """Total order: latest time first, absent times last, ties by ``tie_break`` descending."""
    return [F.desc_nulls_last(time_column), F.desc_nulls_last(tie_break)]


def _day(df: DataFrame, time_column: str) -> Column:
    """The day of a time: of a text its first ten characters, which order as the texts do."""
    is_text = dict(df.dtypes)[time_column] == "string"
    return F.substring(time_column, 1, 10) if is_text else F.to_date(time_column)


def _days_newest_first(df: DataFrame, time_column: str, limit: int) -> DataFrame:
    """``(day, rows, upto)`` of the newest ``limit`` days; ``upto`` counts rows of this and newer days.

    Each day holds a row at least, so these days hold the newest ``limit`` rows, and the running count is
    over no more days than that. Reads one column, summed in the tasks first.
    """
    days = df.groupBy(_day(df, time_column).alias("day")).agg(F.count("*").alias("rows"))
    newest_days = days.where("day IS NOT NULL").orderBy(F.desc("day")).limit(limit)
    upto = F.sum("rows").over(Window.orderBy(F.desc("day")))
    return newest_days.withColumn("upto", upto)


def newest(df: DataFrame, time_column: str, tie_break: str, limit: int) -> DataFrame:
    """The ``limit`` newest rows, newest first.

    Rows older than the day in which the count reaches ``limit`` are left out at the scan, so few
    rows beyond the result reach its last task. With fewer known times than that, all rows stay.
    """
    cut = _days_newest_first(df, time_column, limit).where(F.col("upto") >= limit)
    oldest = cut.agg(F.max("day")).scalar()
    kept = df.where(oldest.isNull() | (_day(df, time_column) >= oldest))
    return kept.orderBy(*_order(time_column, tie_break)).limit(limit)


def page_slice(
    df: DataFrame, time_column: str, tie_break: str, page: int, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Page number ``page`` (0-based) of the newest-first order.

    Days that lie before or after the page are left out at the scan; how many rows the former
    hold is one number that the driver fetches. So a deep page costs its last task no more than a
    page of the first day does.
    """
    first, last = page * page_size, (page + 1) * page_size
    days = _days_newest_first(df, time_column, last)
    before = F.col("upto") <= first
    found = days.agg(
        F.coalesce(F.max(F.when(before, F.col("upto"))), F.lit(0)).alias("skipped"),
        F.min(F.when(before, F.col("day"))).alias("newer_end"),
        F.max(F.when(F.col("upto") >= last, F.col("day"))).alias("oldest"),
    ).first()
    day = _day(df, time_column)
    if found.newer_end is not None:  # rows without a time come last of all
        df = df.where(day.isNull() | (day < F.lit(found.newer_end)))
    if found.oldest is not None:
        df = df.where(day >= F.lit(found.oldest))
    ordered = df.orderBy(*_order(time_column, tie_break))
    return ordered.offset(first - found.skipped).limit(page_size)
