"""Grand totals next to every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_totals(df: DataFrame, totals_of: DataFrame, **totals: Column) -> DataFrame:
    """Add aggregates over all of ``totals_of`` to each row of ``df``.

    A scalar subquery: the totals are one row, reduced on the map side, and reach the tasks as
    constants. There is no join, and the rows of ``df`` stay where they are (a window without a
    partition key would gather them all in one task).
    """
    row = totals_of.agg(F.struct(*[agg.alias(name) for name, agg in totals.items()])).scalar()
    return df.withColumns({name: row[name] for name in totals})
