"""Timings of the pipeline's stages and headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the input tables, ``BENCH_CPUS`` the local cores. The raw-trip fixture is
written to bronze once; every stage then reads the tables the stage before it wrote, as in use.
Queries are run to the end into a sink that drops the rows. Everything is timed on its second run, as
the first one also compiles.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import datetime

from tripmill.fixtures import raw_trips
from tripmill.operators.dedupe import latest_per_key
from tripmill.operators.gates import batch_counts
from tripmill.plans import gold
from tripmill.plans.bronze import ingest
from tripmill.plans.pipeline import build_gold, build_silver, check_warehouse, update_silver
from tripmill.plans.silver import clean, typed
from tripmill.schema import BRONZE_TRIPS, RUN_LOG, SILVER_TRIPS
from tripmill.session import build_session
from tripmill.sources.feed import newest
from tripmill.sources.warehouse import Warehouse
from verification.queries import PAGE_ROWS, landed_pages

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NOW = datetime(2024, 6, 1)


def main() -> None:
    home = tempfile.mkdtemp(prefix="tripmill-bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.warehouse.dir": home,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = Warehouse(spark).create()
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    def run(df):
        return lambda: df.write.format("noop").mode("overwrite").save()

    def stage(name, df):
        run(df)()
        timed(name, run(df))

    landing = os.path.join(home, "landing")
    os.makedirs(landing)
    for row in landed_pages(spark, SF_DIR).toLocalIterator():
        with open(os.path.join(landing, f"page-{row.page:06d}.json"), "w") as page:
            page.write(row.body)
    stage("ingest_pages", ingest(spark, landing, 1, "b", NOW, "file://landing", PAGE_ROWS))

    # The fixture has many batches at once: bring the rows of a batch together before the append.
    raw = raw_trips(spark, SF_DIR).hint("rebalance", "batch_id")
    Warehouse(spark, "warm_").create().append(raw, BRONZE_TRIPS)
    timed("bronze_append", lambda: warehouse.append(raw, BRONZE_TRIPS))
    bronze = warehouse.bronze()
    stage("typed_trips", typed(bronze))
    stage("dedupe_latest", latest_per_key(typed(bronze)))
    stage("silver_trips", clean(bronze))
    build_silver(warehouse, 1)
    timed("silver_table", lambda: build_silver(warehouse, 2))
    # By way of the trip state: all batches at first, then one more over what is stored.
    update_silver(warehouse, 3, buckets=int(CPUS))
    timed("silver_by_state", lambda: update_silver(warehouse, 4, also=("batch_redo",)))
    silver = warehouse.read(SILVER_TRIPS)
    stage("daily_trip_summary", gold.daily_trip_summary(silver, NOW))
    stage("hourly_demand_heatmap", gold.hourly_demand_heatmap(silver, NOW))
    stage("payment_analysis", gold.payment_analysis(silver, NOW))
    build_gold(warehouse, 1, NOW)
    timed("gold_tables", lambda: build_gold(warehouse, 2, NOW))
    stage("batch_validation", batch_counts(warehouse.bronze(), "batch_redo"))
    narrow = bronze.select("ingestion_id", "tpep_pickup_datetime", "total_amount")
    stage("newest_trips_topn", newest(narrow, "tpep_pickup_datetime", "ingestion_id", 10_000))
    run(check_warehouse(warehouse))()
    timed("dq_report", lambda: run(check_warehouse(warehouse))())
    stage("run_log_state", warehouse.read(RUN_LOG))
    print(
        json.dumps(
            {
                "metric": "trip pipeline stages and queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "raw_rows": bronze.count(),
            }
        )
    )


if __name__ == "__main__":
    main()
