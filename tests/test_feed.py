"""Landed pages, ingest and newest-first extracts."""

import json
import random
from datetime import datetime

import pytest

from tripmill.operators.conform import new_batch_id, normalise
from tripmill.plans.bronze import ingest, pages_left_out
from tripmill.schema import BRONZE
from tripmill.sources.feed import newest, page_slice, pages_to_last, read_pages, records
from tests.conftest import columns_of

AT = datetime(2024, 1, 2, 3, 4, 5)


def pages_read(spark, folder, **options):
    pages = pages_to_last(read_pages(spark, folder), **options)
    return sorted(r.page for r in pages.select("page").collect())


def test_record_keys_match_by_exact_case(spark, tmp_path, land):
    folder = land(
        tmp_path / "land",
        [
            {"VendorID": "1", "vendorid": "9", "fare_amount": 2.5, "surprise": {"a": 1}},
            {"vendorid": "9", "RatecodeID": None},
        ],
    )
    rows = records(read_pages(spark, folder)).orderBy("position").collect()
    assert [(r.page, r.position, r.VendorID, r.fare_amount) for r in rows] == [
        (0, 0, "1", "2.5"),
        (0, 1, None, None),
    ]
    assert "surprise" not in rows[0] and rows[1].RatecodeID is None


def test_page_number_is_the_last_number_of_the_name(spark, tmp_path):
    names = {"2024-06-01_page-3.json": 3, "page00042.json.txt": 42, "7": 7}
    for name in names:
        (tmp_path / name).write_text("[]")
    assert sorted(r.page for r in read_pages(spark, str(tmp_path)).collect()) == [3, 7, 42]


def test_normalise_fills_and_drops(spark):
    df = spark.createDataFrame([("1", "2", "9")], "VendorID string, vendor_id string, x string")
    row = normalise(df.select("VendorID", "x")).first()
    assert row.vendor_id == "1" and row.airport_fee is None and len(row) == 19


def test_read_ends_at_a_short_empty_or_absent_page(spark, tmp_path, land):
    ten = [{"VendorID": str(i)} for i in range(10)]
    folder = land(tmp_path / "short", ten, page_size=3)
    assert pages_read(spark, folder, page_size=3) == [0, 1, 2, 3]
    # All pages but the last are full; with a larger page size the first is short already.
    assert pages_read(spark, folder, page_size=4) == [0]
    assert pages_read(spark, folder, page_size=3, max_pages=2) == [0, 1]
    assert pages_read(spark, folder, page_size=3, max_pages=None) == [0, 1, 2, 3]

    (tmp_path / "short" / "page-00001.json").write_text("[]")
    assert pages_read(spark, folder, page_size=3) == [0, 1]
    (tmp_path / "short" / "page-00001.json").unlink()
    assert pages_read(spark, folder, page_size=3) == [0]
    (tmp_path / "short" / "page-00000.json").write_text("[]")
    assert records(pages_to_last(read_pages(spark, folder), 3)).count() == 0


def test_ingest(spark, tmp_path, land, feed_record):
    made = [feed_record(vendor_id=str(i)) for i in range(25)]
    folder = land(tmp_path / "land", made, page_size=10)
    bronze = ingest(spark, folder, 3, "batch_x", AT, "file://feed", page_size=10)
    assert bronze.dtypes == columns_of(BRONZE)
    rows = bronze.orderBy("ingestion_id").collect()
    # Feed order, and every id of run 3 is above every id of run 2.
    assert [r.vendor_id for r in rows] == [str(i) for i in range(25)]
    assert [r.ingestion_id for r in rows] == [(3 << 40) + i for i in range(25)]
    assert {(r.batch_id, r.pipeline_run_id, r.source_url, r.ingested_at) for r in rows} == {
        ("batch_x", 3, "file://feed", AT)
    }


def test_no_landed_page_is_dropped(spark, tmp_path, land, feed_record):
    folder = land(tmp_path / "land", [feed_record() for _ in range(250)], page_size=10)
    assert ingest(spark, folder, 1, "b", AT, "u", 10).count() == 250
    assert pages_left_out(spark, folder, 10) == 0
    (tmp_path / "land" / "page-00003.json").write_text(json.dumps([feed_record()] * 9))
    (tmp_path / "land" / "page-00007.json").unlink()
    assert ingest(spark, folder, 1, "b", AT, "u", 10).count() == 239
    # A larger page size only numbers the records differently.
    assert ingest(spark, folder, 1, "b", AT, "u", 1000).count() == 239
    # Both limits are options, and what they leave out is known.
    assert ingest(spark, folder, 1, "b", AT, "u", 10, max_pages=2).count() == 20
    assert pages_left_out(spark, folder, 10, max_pages=2) == 22
    assert ingest(spark, folder, 1, "b", AT, "u", 10, stop_at_short_page=True).count() == 39
    assert pages_left_out(spark, folder, 10, stop_at_short_page=True) == 20


def test_page_numbers_must_begin_at_zero_and_differ(spark, tmp_path, land, feed_record):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "page-1.json").write_text(json.dumps([feed_record()]))
    with pytest.raises(ValueError, match="page 0 is absent"):
        ingest(spark, str(tmp_path / "one"), 1, "b", AT, "u")
    (tmp_path / "two").mkdir()
    for name in ("a-0.json", "b-0.json", "b-1.json"):
        (tmp_path / "two" / name).write_text(json.dumps([feed_record()]))
    with pytest.raises(ValueError, match="page number 0 occurs twice"):
        ingest(spark, str(tmp_path / "two"), 1, "b", AT, "u")
    with pytest.raises(ValueError, match="no block of ids"):
        ingest(spark, land(tmp_path / "three", [feed_record()]), 1 << 23, "b", AT, "u")


def test_bad_pages_are_errors(spark, tmp_path, land, feed_record):
    folder = land(tmp_path / "long", [feed_record() for _ in range(5)], page_size=5)
    with pytest.raises(Exception, match="page longer than page_size"):
        ingest(spark, folder, 1, "b", AT, "u", page_size=4).collect()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "page-0.json").write_text('[{"VendorID": ')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        records(read_pages(spark, str(tmp_path / "cut"))).collect()
    (tmp_path / "name").mkdir()
    (tmp_path / "name" / "page.json").write_text("[]")
    with pytest.raises(Exception, match="without a page number"):
        read_pages(spark, str(tmp_path / "name")).collect()


def test_batch_ids():
    one, two = new_batch_id("2024-01-01"), new_batch_id("2024-01-01")
    assert one != two and len(one) == len("batch_2024-01-01_") + 8


def test_newest_and_pages_agree_with_a_full_sort(spark):
    pick = random.Random(7)
    # Two thirds of the rows share one time; some have none.
    times = [pick.choice(["2024-01-05", "2024-01-05", str(i), None]) for i in range(3000)]
    data = [(i, t) for i, t in enumerate(times)]
    pick.shuffle(data)
    df = spark.createDataFrame(data, "id int, t string").repartition(13)
    full = sorted(data, key=lambda r: (r[1] is not None, r[1] or "", r[0]), reverse=True)
    assert [tuple(r) for r in newest(df, "t", "id", 1700).collect()] == full[:1700]
    for page in (0, 3, 29):
        got = [tuple(r) for r in page_slice(df, "t", "id", page, 100).collect()]
        assert got == full[page * 100 : page * 100 + 100]
    assert page_slice(df, "t", "id", 30, 100).count() == 0


@pytest.mark.parametrize("kind", ["one second", "no times", "few rows", "timestamps"])
def test_newest_of_odd_times(spark, kind):
    from datetime import timedelta

    times = {
        "one second": ["2024-01-05 10:00:00"] * 500,
        "no times": [None] * 480 + ["2024-01-05"] * 20,
        "few rows": ["2024-01-05", "2024-01-06", None],
        "timestamps": [AT + timedelta(hours=i % 90) for i in range(499)] + [None],
    }[kind]
    data = list(enumerate(times))
    df = spark.createDataFrame(data, f"id int, t {'timestamp_ntz' if kind == 'timestamps' else 'string'}")
    known = sorted((r for r in data if r[1] is not None), key=lambda r: (r[1], r[0]), reverse=True)
    full = known + sorted((r for r in data if r[1] is None), reverse=True)
    assert [tuple(r) for r in newest(df, "t", "id", 100).collect()] == full[:100]
    for page in (0, 1, 4):
        got = [tuple(r) for r in page_slice(df, "t", "id", page, 50).collect()]
        assert got == full[page * 50 : page * 50 + 50]


def test_large_landed_numbers_stay_text(spark, tmp_path):
    (tmp_path / "land").mkdir()
    body = json.dumps([{"total_amount": 12345678.25, "payment_type": 1}])
    (tmp_path / "land" / "page-0.json").write_text(body)
    row = records(read_pages(spark, str(tmp_path / "land"))).first()
    assert float(row.total_amount) == 12345678.25 and row.payment_type == "1"
