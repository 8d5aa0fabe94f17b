"""Queries against their SQL, on the given tables and on those with nulls, ties and copies."""

import pytest

from tests.conftest import SF_DIR
from tripmill.llm.queries import ORACLES, QUERIES
from verification.compare import connect, oracle_rows, oracle_types, spark_rows, spark_types


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    connection = connect(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    columns, wanted = oracle_rows(connection, ORACLES[name])
    assert sorted(df.columns) == columns
    assert spark_types(df) == oracle_types(connection, ORACLES[name])
    assert spark_rows(df) == wanted


def test_all_thirteen_are_registered():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))
