import json
import sys
from datetime import datetime
from itertools import count
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmill.schema import BRONZE, FEED_COLUMNS  # noqa: E402
from tripmill.session import build_session  # noqa: E402
from tripmill.sources.warehouse import Warehouse  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def columns_of(table):
    return [(f.name, f.dataType.simpleString()) for f in table.fields]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


_numbers = count(1)


@pytest.fixture
def warehouse(spark):
    """An empty warehouse of its own."""
    return Warehouse(spark, prefix=f"t{next(_numbers)}_").create()


@pytest.fixture
def raw_row():
    """A sound raw trip; keyword arguments change it."""
    number = count(1)

    def make(**changes):
        row = {
            "ingestion_id": next(number),
            "vendor_id": "1",
            "tpep_pickup_datetime": "2024-03-03T10:00:00.000",
            "tpep_dropoff_datetime": "2024-03-03T10:30:00.000",
            "passenger_count": "1",
            "trip_distance": "6.00",
            "rate_code_id": "1",
            "store_and_fwd_flag": "N",
            "pu_location_id": "10",
            "do_location_id": "20",
            "payment_type": "1",
            "fare_amount": "20.00",
            "extra": "0",
            "mta_tax": "0.5",
            "tip_amount": "6.00",
            "tolls_amount": "0",
            "improvement_surcharge": "0.3",
            "total_amount": "30.00",
            "congestion_surcharge": "2.5",
            "airport_fee": None,
            "source_url": "x",
            "ingested_at": datetime(2024, 3, 4),
            "batch_id": "b1",
            "pipeline_run_id": 1,
        }
        assert not set(changes) - set(row)
        return {**row, **changes}

    return make


@pytest.fixture
def bronze(spark):
    def make(rows):
        return spark.createDataFrame([[r[f] for f in BRONZE.fieldNames()] for r in rows], BRONZE)

    return make


@pytest.fixture
def land():
    """Write records as landed pages."""

    def write(folder, records, page_size=1000):
        folder.mkdir(parents=True, exist_ok=True)
        pages = [records[i : i + page_size] for i in range(0, len(records), page_size)]
        for n, page in enumerate(pages):
            (folder / f"page-{n:05d}.json").write_text(json.dumps(page))
        return str(folder)

    return write


@pytest.fixture
def feed_record(raw_row):
    keys = {column: key for key, column in FEED_COLUMNS.items()}

    def make(**changes):
        row = raw_row(**changes)
        return {keys[c]: v for c, v in row.items() if c in keys and v is not None}

    return make
