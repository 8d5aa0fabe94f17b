"""Data-quality checks.

A check yields a count of failures. Row checks (not null, expression) of a table share one
aggregation over it, allowed-value checks another, and each duplicate check groups its own column:
a few scans per table for any number of checks, each of only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.unique import repeated_ids

WARN, ERROR = "warn", "error"
NOT_NULL, UNIQUE, ACCEPTED, EXPRESSION = "not_null", "unique", "accepted_values", "expression"


@dataclass(frozen=True)
class Check:
    """One declared check of one column; ``rule`` completes ``<column> <rule>`` as a condition."""

    table: str
    column: str
    kind: str
    rule: str = ""
    values: tuple = ()

    @property
    def name(self) -> str:
        tail = f" {self.rule}" if self.rule else ""
        return f"{self.kind}:{self.table}.{self.column}{tail}"


def violation(check: Check) -> Column:
    """What a not-null or expression check counts."""
    if check.kind == NOT_NULL:
        return F.col(check.column).isNull()
    # An unknown outcome passes: count_if does not count NULL.
    return F.expr(f"NOT ({check.column} {check.rule})")


def _unpivoted(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(check_name, failing)`` from the one row of counts ``c0, c1, ...``."""
    pairs = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("failing"))
        for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*pairs)))


def count_rows(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """``(check_name, failing)``: rows that meet each condition, counted in one pass."""
    counts = [F.count_if(v).alias(f"c{i}") for i, v in enumerate(violations.values())]
    return _unpivoted(df.agg(*counts), list(violations))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)``: values that occur more than once; NULL is no value."""
    known = df.select(F.col(column).alias("value")).dropna()
    return known.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")


def unexpected_values(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check_name, value, n)``: distinct values outside the allowed list; NULL is allowed."""
    unexpected = {c: ~F.col(c.column).isin(*c.values) for c in checks}
    pairs = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.when(bad, F.col(c.column).cast("string")).alias("value"),
        )
        for c, bad in unexpected.items()
    ]
    # Only rows with something unexpected are taken apart.
    rows = df.where(reduce(Column.__or__, unexpected.values()))
    values = rows.select(F.inline(F.array(*pairs))).where("value IS NOT NULL")
    return values.groupBy("check_name", "value").agg(F.count("*").alias("n"))


def unique_checks(
    df: DataFrame, checks: Sequence[Check], batch: str | None = None
) -> DataFrame:
    """``(check_name, failing)``: number of values that occur more than once.

    Whole numbers of a table that has batches are compared by intervals and bits first (see ``unique``).
    """
    kinds = dict(df.dtypes)
    parts = []
    for c in checks:
        by_batch = batch is not None and kinds[c.column] in ("bigint", "int")
        found = repeated_ids(df, c.column, batch) if by_batch else duplicates(df, c.column)
        failing = found.agg(F.count("*").alias("failing"))
        parts.append(failing.select(F.lit(c.name).alias("check_name"), "failing"))
    return reduce(DataFrame.unionByName, parts)


def accepted_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check_name, failing)``: number of distinct values outside the list."""
    found = unexpected_values(df, checks).agg(
        *[F.count_if(F.col("check_name") == c.name).alias(f"c{i}") for i, c in enumerate(checks)]
    )
    return _unpivoted(found, [c.name for c in checks])


def check_table(
    df: DataFrame,
    checks: Iterable[Check],
    violations: Mapping[str, Column] | None = None,
    batch: str | None = None,
) -> DataFrame:
    """``(check_name, failing)`` of all checks of one table; ``batch`` is the column of its batches, if it has any.

    ``violations`` are conditions over several columns, by name; they are counted in the same pass
    as the not-null and expression checks.
    """
    checks = list(checks)
    rows = {c.name: violation(c) for c in checks if c.kind in (NOT_NULL, EXPRESSION)}
    unique = [c for c in checks if c.kind == UNIQUE]
    accepted = [c for c in checks if c.kind == ACCEPTED]
    parts = []
    if rows or violations:
        parts.append(count_rows(df, {**rows, **(violations or {})}))
    if unique:
        parts.append(unique_checks(df, unique, batch))
    if accepted:
        parts.append(accepted_checks(df, accepted))
    return reduce(DataFrame.unionByName, parts)


def missing_from(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Distinct non-null keys of ``df`` that ``other`` does not have."""
    # Distinct on both sides: a key that most rows share is merged before it is shuffled.
    wanted = df.select(*keys).dropna().distinct()
    return wanted.join(other.select(*keys).distinct(), list(keys), "left_anti")


def over_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """``(check_name, failing)``: rows whose text is longer than its column's limit."""
    return count_rows(df, {f"length({c}) <= {n}": F.length(c) > n for c, n in limits.items()})


def outcome(severity: Column, failing: Column) -> Column:
    """``pass``, ``warn`` or ``fail``."""
    return (
        F.when(failing == 0, F.lit("pass")).when(severity == ERROR, F.lit("fail")).otherwise("warn")
    )
