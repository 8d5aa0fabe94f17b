"""Which ids occur more than once, without shuffling the ids.

The ids of a batch are a block of their own, or nearly. So the smallest and largest id of every batch show which
batches can share ids at all: the others have nothing to compare. Within batches whose ids lie dense, a bit per id
tells whether all differ: ids are marked in bitmaps of 32,768 places, summed in the task before the shuffle, and
a bitmap with fewer bits than rows holds a repeat. Rows in such bitmaps, and in batches whose ids lie too far apart
for bits, are grouped by id. The result is exact whatever the ids are; the intervals and bitmaps decide
only how much of it is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A batch is dense if its ids, as bits of the interval they lie in, take no more room than as numbers.
_BITS_PER_ID = 64


@dataclass(frozen=True)
class Interval:
    """A batch's ids: the smallest, the largest and how many."""

    batch: object
    low: int
    high: int
    n: int


def id_intervals(df: DataFrame, column: str, batch: str) -> list[Interval]:
    """One interval for each batch with ids: as many rows as there are batches reach the driver."""
    known = df.where(F.col(column).isNotNull())
    found = known.groupBy(F.col(batch).alias("batch")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count("*").alias("n")
    )
    return [Interval(r.batch, r.low, r.high, r.n) for r in found.collect()]


def clusters(intervals: list[Interval]) -> list[list[Interval]]:
    """Groups of intervals that overlap, directly or through others; ids of different groups differ."""
    groups: list[list[Interval]] = []
    reach = None
    for interval in sorted(intervals, key=lambda i: (i.low, i.high)):
        if reach is None or interval.low > reach:
            groups.append([])
            reach = interval.high
        groups[-1].append(interval)
        reach = max(reach, interval.high)
    return groups


def is_dense(group: list[Interval]) -> bool:
    span = max(i.high for i in group) - min(i.low for i in group) + 1
    return span <= _BITS_PER_ID * sum(i.n for i in group)


def _of_batches(batch: str, groups: list[list[Interval]]) -> Column:
    ids = [i.batch for group in groups for i in group]
    named = F.col(batch).isin([b for b in ids if b is not None])
    return F.coalesce(named, F.lit(None in ids)) if ids else F.lit(False)


def crowded_bitmaps(ids: DataFrame, column: str) -> DataFrame:
    """``(bitmap)``: numbers of the bitmaps that hold fewer different ids than rows."""
    # A column first: the bit's place is then worked out once per row, and partial bitmaps leave the task.
    placed = ids.select(
        F.bitmap_bucket_number(column).alias("bitmap"), F.bitmap_bit_position(column).alias("place")
    )
    counted = placed.groupBy("bitmap").agg(
        F.count("*").alias("n"), F.bitmap_count(F.bitmap_construct_agg("place")).alias("different")
    )
    return counted.where("n > different").select("bitmap")


def repeated_ids(df: DataFrame, column: str, batch: str) -> DataFrame:
    """``(value, n)``: ids (whole numbers) that occur more than once in ``df``; NULL is no id.

    Runs one aggregation over ids and batches, and one over the bitmaps of dense batches, when called.
    """
    groups = clusters(id_intervals(df, column, batch))
    dense = [group for group in groups if is_dense(group)]
    sparse = [group for group in groups if not is_dense(group)]
    rows = df.select(F.col(column).alias("value"), F.col(batch).alias("batch")).where("value IS NOT NULL")
    parts = []
    if dense:
        near = rows.where(_of_batches("batch", dense)).select("value")
        crowded = crowded_bitmaps(near, "value")
        if not crowded.isEmpty():
            number = F.bitmap_bucket_number("value").alias("bitmap")
            parts.append(near.select("value", number).join(crowded, "bitmap", "left_semi").select("value"))
    if sparse:
        parts.append(rows.where(_of_batches("batch", sparse)).select("value"))
    # Ids of dense and of sparse batches differ: one grouping for both.
    left = parts[0].union(parts[1]) if len(parts) > 1 else parts[0] if parts else rows.select("value").where("false")
    return left.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
