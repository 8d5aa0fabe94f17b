"""Raw trips made from the ``events`` table: deterministic test input with every kind of defect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.schema import BRONZE, as_table

_COLUMNS = {
    "ingestion_id": "event_id + redo * 1000000000",
    "vendor_id": "element_at(array('1', '2', ' 1 ', '2.0', 'x'), cast(user_id % 5 + 1 AS int))",
    "tpep_pickup_datetime": "started",
    "tpep_dropoff_datetime": "if(event_id % 97 = 0, NULL, ended)",
    "passenger_count": """
        CASE WHEN redo = 1 AND event_id % 20 = 0 THEN 'bad'
             WHEN user_id % 7 = 6 THEN '25'
             WHEN user_id % 7 = 0 THEN NULL
             WHEN user_id % 2 = 0 THEN concat(user_id % 7, '.0')
             ELSE cast(user_id % 7 AS string) END""",
    "trip_distance": """
        CASE event_id % 50 WHEN 3 THEN '-1.5' WHEN 7 THEN 'NaN'
             ELSE cast(cast(k AS decimal(10,2)) * cast(0.1 AS decimal(2,1)) AS string) END""",
    "rate_code_id": """
        CASE user_id % 11 WHEN 10 THEN '99.0' WHEN 9 THEN NULL
             ELSE cast(user_id % 6 + 1 AS string) END""",
    "store_and_fwd_flag": "if(user_id % 4 = 0, ' Y ', 'N')",
    "pu_location_id": "user_id + 1",
    "do_location_id": "concat(k + 100, if(event_id % 2 = 0, '.0', ''))",
    "payment_type": """
        CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'purchase' THEN '3'
             WHEN 'signup' THEN '1.0' ELSE '9' END""",
    "fare_amount": """
        CASE WHEN event_id % 41 = 0 THEN ' 5.00' WHEN event_id % 40 = 1 THEN concat('-', v)
             ELSE cast(v AS string) END""",
    "extra": "if(event_id % 2 = 0, '0.5', '1')",
    "mta_tax": "'0.5'",
    "tip_amount": """
        CASE WHEN event_id % 3 = 0 THEN '0' WHEN event_id % 43 = 0 THEN '.5'
             ELSE cast(cast(v * cast(0.2 AS decimal(2,1)) AS decimal(10,2)) AS string) END""",
    "tolls_amount": "if(event_id % 17 = 0, '6.55', '0')",
    "improvement_surcharge": "'0.3'",
    "total_amount": "cast(v * cast(1.2 AS decimal(2,1)) AS decimal(10,2))",
    "congestion_surcharge": "if(event_id % 13 = 0, NULL, '2.5')",
    "airport_fee": """
        CASE WHEN event_id % 23 = 0 THEN 'NaN' WHEN event_id % 19 = 0 THEN '1.25' END""",
    "source_url": "'fixture://events'",
    "ingested_at": "if(redo = 1, timestamp_ntz'2024-02-02', timestamp_ntz'2024-02-01')",
    "batch_id": "if(redo = 1, 'batch_redo', concat('batch_', substr(started, 1, 10)))",
    "pipeline_run_id": "1 + redo",
}


# Helper values of an event, worked out once per event.
_HELPERS = {
    "started": "substr(cast(ts AS string), 1, 19)",
    "ended": """
        substr(cast(ts + make_dt_interval(0, 0, cast(get_json_object(props, '$.k') AS int) * 4, 0)
            AS string), 1, 19)""",
    "v": "cast(value AS decimal(10,2))",
    "k": "cast(get_json_object(props, '$.k') AS int)",
}


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows: every event once, every tenth delivered again later; one scan of the table."""
    helpers = F.struct(*[F.expr(e).alias(c) for c, e in _HELPERS.items()])
    deliveries = F.expr("if(event_id % 10 = 0, array(0, 1), array(0))")
    # As generated rows the helpers are plain columns to whatever filter or parser comes next, which
    # would otherwise repeat their expressions.
    events = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .select("event_id", "user_id", "event_type", F.inline(F.array(helpers)))
        .select("*", F.explode(deliveries).alias("redo"))
    )
    return as_table(events.select(*[F.expr(e).alias(c) for c, e in _COLUMNS.items()]), BRONZE)
