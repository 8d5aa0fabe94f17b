"""Row checks counted while rows are written, so that reports need not read the rows again.

A write of rows is observed: the conditions of all row checks are counted in the tasks that write, and the counts are
appended to a table, per batch for bronze, per version for tables that are rebuilt. A report adds up what is
recorded. It reads rows only of batches whose records are incomplete: batches written by others, replaced, or from
before a check was declared. Whether a batch is complete is told by its number of rows, which needs no column.

Observed counts are right also when tasks are tried again: they are taken in the last stage, of which Spark counts each
partition once.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.filters import null_critical
from tripmill.operators.quality import count_rows
from tripmill.plans.checks import row_conditions
from tripmill.schema import BRONZE_TRIPS, CHECK_COUNTS, SILVER_TRIPS
from tripmill.sources.warehouse import REPLACED, Warehouse

#: Recorded besides the checks: the number of rows, and of those that lack pickup time or total.
ROWS, NULL_CRITICAL = "rows", "null_critical"

_COUNTS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("failing", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Counted:
    """Failures that need no scan: ``rows`` is ``(check_name, failing)`` of the checks in ``names``."""

    names: frozenset[str]
    rows: DataFrame


class Observed:
    """Rows to be written, with their conditions counted on the way; ``counts`` is known after the write."""

    def __init__(self, df: DataFrame, conditions: Mapping[str, Column]) -> None:
        self._names = [ROWS, *conditions]
        self._observation = Observation()
        counts = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values(), 1)]
        self.df = df.observe(self._observation, F.count("*").alias("c0"), *counts)

    @property
    def counts(self) -> dict[str, int]:
        found = self._observation.get
        return {name: found[f"c{i}"] for i, name in enumerate(self._names)}


def observed_bronze(rows: DataFrame) -> Observed:
    return Observed(rows, {NULL_CRITICAL: null_critical(), **row_conditions(BRONZE_TRIPS)})


def observed_silver(rows: DataFrame) -> Observed:
    return Observed(rows, row_conditions(SILVER_TRIPS))


def record(
    warehouse: Warehouse, table: str, version: int, counts: Mapping[str, int], batch_id: str | None = None
) -> None:
    """Append the counts of one write."""
    rows = [(table, version, batch_id, name, n) for name, n in counts.items()]
    warehouse.append(warehouse.spark.createDataFrame(rows, _COUNTS).coalesce(1), CHECK_COUNTS)


def bronze_counts(warehouse: Warehouse) -> Counted:
    """Row checks of all of bronze: recorded counts, and a scan of the batches that lack them."""
    conditions = row_conditions(BRONZE_TRIPS)
    records = warehouse.read(CHECK_COUNTS).where(F.col("table_name") == BRONZE_TRIPS)
    wanted = F.col("check_name").isin(*conditions)
    # A write is complete if it has a count for every check of today, a batch if all its writes are.
    per_write = records.groupBy("batch_id", "version").agg(
        F.sum(F.when(F.col("check_name") == ROWS, F.col("failing"))).alias("rows"),
        F.count_distinct(F.when(wanted, F.col("check_name"))).alias("checks"),
        F.bool_or(F.col("check_name") == REPLACED).alias("replaced"),
    )
    per_batch = per_write.groupBy("batch_id").agg(
        F.sum("rows").alias("recorded"),
        F.bool_and((F.col("checks") == len(conditions)) & ~F.col("replaced")).alias("complete"),
    )
    present = warehouse.read(BRONZE_TRIPS).groupBy("batch_id").agg(F.count("*").alias("present"))
    same = F.coalesce(F.col("complete") & (F.col("recorded") == F.col("present")), F.lit(False))
    # One row per batch reaches the driver.
    batches = present.join(per_batch, "batch_id", "left").select("batch_id", same.alias("trusted")).collect()
    trusted = [b.batch_id for b in batches if b.trusted]
    rest = [b.batch_id for b in batches if not b.trusted]
    recorded = records.where(wanted & F.col("batch_id").isin(trusted)).select("check_name", "failing")
    if rest:
        read = F.col("batch_id").isin([b for b in rest if b is not None])
        read = read | F.col("batch_id").isNull() if None in rest else read
        recorded = recorded.union(count_rows(warehouse.bronze().where(read), conditions))
    total = recorded.groupBy("check_name").agg(F.sum("failing").alias("failing"))
    if not trusted and not rest:  # no batch at all: nothing fails
        total = count_rows(warehouse.bronze().where("false"), conditions)
    return Counted(frozenset(conditions), total)


def silver_counts(warehouse: Warehouse) -> Counted | None:
    """Row checks of the published silver table as they were counted when it was written; None if they were not."""
    version = warehouse.version_of(SILVER_TRIPS)
    conditions = row_conditions(SILVER_TRIPS)
    mine = (F.col("table_name") == SILVER_TRIPS) & (F.col("version") == version)
    records = warehouse.read(CHECK_COUNTS).where(mine & F.col("check_name").isin(*conditions))
    # The last record of a version that was built more than once is the one of the table that is there.
    rows = records.groupBy("check_name").agg(F.count("*").alias("times"), F.max("failing").alias("failing"))
    found = rows.collect()  # one row per check
    if len(found) < len(conditions) or any(r.times > 1 for r in found):
        return None
    return Counted(frozenset(conditions), rows.select("check_name", "failing"))


def known_counts(warehouse: Warehouse) -> dict[str, Counted]:
    """What a report need not count anew, by table."""
    silver = silver_counts(warehouse)
    return {BRONZE_TRIPS: bronze_counts(warehouse)} | ({SILVER_TRIPS: silver} if silver else {})
