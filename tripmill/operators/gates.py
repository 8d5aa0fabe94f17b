"""Gates between bronze and silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tripmill.operators.filters import null_critical


class BatchRejected(ValueError):
    """The batch must not go on to silver."""


def batch_counts(bronze: DataFrame, batch_id: str) -> DataFrame:
    """One row: ``row_count``, ``null_critical_count``, ``passed``; one pass over the partition."""
    return (
        bronze.where(F.col("batch_id") == batch_id)
        .agg(
            F.count("*").alias("row_count"),
            F.count_if(null_critical()).alias("null_critical_count"),
        )
        .select(
            F.lit(batch_id).alias("batch_id"),
            "row_count",
            "null_critical_count",
            _passed().alias("passed"),
        )
    )


def all_batch_counts(bronze: DataFrame) -> DataFrame:
    """As ``batch_counts``, for every batch present."""
    return (
        bronze.groupBy("batch_id")
        .agg(
            F.count("*").alias("row_count"),
            F.count_if(null_critical()).alias("null_critical_count"),
        )
        .withColumn("passed", _passed())
    )


def gate(batch_id: str, row_count: int, null_critical_count: int) -> Row:
    """The row of ``batch_counts`` of a batch whose rows were counted as they were written."""
    passed = row_count > 0 and null_critical_count * 10 <= row_count
    return Row(
        batch_id=batch_id, row_count=row_count, null_critical_count=null_critical_count, passed=passed
    )


def _passed() -> Column:
    # More than one row in ten is too many; exactly one in ten is not.
    return (F.col("row_count") > 0) & (F.col("null_critical_count") * 10 <= F.col("row_count"))


def require_passed(counts: Row) -> None:
    """Raise ``BatchRejected`` unless the batch of this ``batch_counts`` row may go on."""
    if counts.row_count == 0:
        raise BatchRejected(f"batch {counts.batch_id} has no rows")
    if not counts.passed:
        raise BatchRejected(
            f"batch {counts.batch_id}: {counts.null_critical_count} of {counts.row_count} rows "
            "lack pickup time or total"
        )


def validate_batch(bronze: DataFrame, batch_id: str) -> None:
    """Raise ``BatchRejected`` if the batch is empty or lacks too many critical fields."""
    require_passed(batch_counts(bronze, batch_id).first())
