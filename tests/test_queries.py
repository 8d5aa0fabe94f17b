"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from tests.conftest import SF_DIR
from verification.compare import (
    connect,
    oracle_rows,
    oracle_types,
    spark_rows,
    spark_types,
)
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, connection, name):
    df, sql = driver.queries()[name](spark, SF_DIR), driver.oracle_sql()[name]
    columns, wanted = oracle_rows(connection, sql)
    assert sorted(df.columns) == columns
    assert spark_types(df) == oracle_types(connection, sql)
    assert spark_rows(df) == wanted
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "InArrow"):
        assert banned not in plan


@pytest.mark.parametrize("name", ["silver_trips", "calendar_parts", "run_log_state"])
def test_results_do_not_depend_on_the_session_zone(spark, connection, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark_rows(driver.queries()[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == oracle_rows(connection, driver.oracle_sql()[name])[1]


def test_flagship(spark):
    assert driver.entry(spark).count() == 161


def test_the_rest_stands_without_its_optional_part(monkeypatch):
    monkeypatch.setattr(driver, "find_spec", lambda name: None)
    assert driver.queries() == QUERIES
    assert set(driver.oracle_sql()) <= set(QUERIES)


def test_every_check_finds_something(spark):
    """No check of the report passes on the damaged tables: each is seen to count."""
    report = driver.queries()["dq_report"](spark, SF_DIR).collect()
    assert [r.check_name for r in report if r.failing == 0] == []
    assert len(report) == 72
