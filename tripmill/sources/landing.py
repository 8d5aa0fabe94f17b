"""The landed pages of one extract, from a single listing of their folder.

Everything a run wants to know about landed pages comes from one relation of files: its path, page number and length
tell sizes, absent and repeated pages and what options leave out, and its content is the pages. Spark lists the
folder when that relation is made and keeps the listing with it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.feed import PAGE_SIZE, last_page, read_pages

_COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"


def page_of(path: Column) -> Column:
    """Page number of a landed file: of a folder ``page=42`` around it, else the last number of its name."""
    in_folder = F.regexp_extract(path, r"/page=([0-9]+)/[^/]*$", 1)
    in_name = F.regexp_extract(path, r"([0-9]+)(\.[A-Za-z][A-Za-z0-9]*)*$", 1)
    digits = F.when(in_folder != "", in_folder).otherwise(in_name)
    return F.when(digits != "", digits.cast("bigint")).otherwise(
        F.raise_error(F.lit("landed page without a page number in its file name"))
    )


class Landing:
    """Landed pages and the options that choose among them.

    All pages are chosen, unless ``max_pages`` bounds their numbers or ``stop_at_short_page`` ends the extract at
    the first page that is short, empty or absent. An extract whose page 0 is absent, or with a page number
    that occurs twice, is an error: records are numbered by page and position.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        page_size: int = PAGE_SIZE,
        max_pages: int | None = None,
        stop_at_short_page: bool = False,
    ) -> None:
        self.spark, self.folder, self.page_size = spark, folder, page_size
        self.max_pages, self.stop_at_short_page = max_pages, stop_at_short_page
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        self._files = files.select("path", page_of(F.col("path")).alias("page"), "length", "content")

    @property
    def manifest(self) -> DataFrame:
        """``(path, page, length)`` of every landed file; no file is opened for it."""
        return self._files.select("path", "page", "length")

    @cached_property
    def _found(self) -> Row:
        per_page = self.manifest.groupBy("page").agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.count_if(F.col("path").rlike(_COMPRESSED)).alias("compressed"),
        )
        return per_page.agg(
            F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("compressed"), F.lit(0)).alias("compressed"),
            F.min("page").alias("first"),
            F.min(F.when(F.col("files") > 1, F.col("page"))).alias("repeated"),
        ).first()

    @property
    def files(self) -> int:
        return self._found.files

    @property
    def bytes(self) -> int:
        return self._found.bytes

    def check(self) -> None:
        """Raise if page 0 is absent or a page number occurs twice."""
        if self.files and self._found.first != 0:
            raise ValueError(f"landed pages begin at {self._found.first}: page 0 is absent in {self.folder}")
        if self._found.repeated is not None:
            raise ValueError(f"page number {self._found.repeated} occurs twice in {self.folder}")

    def _bodies(self) -> DataFrame:
        if self._found.compressed:  # the text reader knows codecs; it lists the folder for itself
            return read_pages(self.spark, self.folder)
        return self._files.select("page", F.col("content").cast("string").alias("body"))

    @cached_property
    def _last(self) -> int | None:
        """The last page that the options choose, or None for no bound."""
        if self.stop_at_short_page:
            return last_page(self._bodies(), self.page_size, self.max_pages)
        return None if self.max_pages is None else self.max_pages - 1

    def left_out(self) -> int:
        """Number of landed pages that the options leave out."""
        self.check()
        return 0 if self._last is None else self.manifest.where(F.col("page") > self._last).count()

    def pages(self) -> DataFrame:
        """``(page, body)`` of the chosen pages."""
        self.check()
        return self._bodies() if self._last is None else self._bodies().where(F.col("page") <= self._last)
