"""Calendar parts. Names are blank-padded to nine letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME_WIDTH = 9


def hour(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def month(day: Column) -> Column:
    return F.month(day).cast("bigint")


def year(day: Column) -> Column:
    return F.year(day).cast("bigint")


def day_name(day: Column) -> Column:
    return F.rpad(F.date_format(F.to_date(day), "EEEE"), _NAME_WIDTH, " ")


def month_name(day: Column) -> Column:
    return F.rpad(F.date_format(F.to_date(day), "MMMM"), _NAME_WIDTH, " ")


def weekday_number(day: Column) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(day) - 1
