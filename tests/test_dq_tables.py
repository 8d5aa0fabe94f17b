"""The tables of the check report share one silver, worked out once."""

from tests.conftest import SF_DIR
from tripmill.schema import GOLD_DAILY, GOLD_HEATMAP, GOLD_PAYMENT, SILVER_TRIPS
from verification.queries import CHECKED_TABLES, RUN_LOG, damaged_tables


def test_silver_and_the_gold_made_from_it_read_one_stored_silver(spark):
    tables = damaged_tables(spark, SF_DIR, *CHECKED_TABLES, RUN_LOG)
    for name in (SILVER_TRIPS, GOLD_DAILY, GOLD_HEATMAP, GOLD_PAYMENT):
        plan = tables[name]._jdf.queryExecution().withCachedData().toString()
        assert "InMemoryRelation" in plan, name
    assert tables[SILVER_TRIPS].count() > 0
