"""Trip state: the latest row of every trip, kept as a table, so that silver needs no look at old batches.

The state holds the parsed columns of the latest row per trip, *invalid ones included*: an invalid latest row
hides older valid ones, so it must be remembered. The table is bucketed by the trip's key. A new batch is
reduced to its latest rows, dealt to the same buckets, and joined bucket by bucket: of all that is stored nothing
is shuffled, only the batch is. Rows of silver are a filter and a projection of the state and stay in their buckets.

Every version of the state is written whole and published as any other table. The batches that it holds are
listed in an append-only table, so a run that failed after its append is made up for by the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.keys import surrogate_key
from tripmill.operators.dedupe import TRIP_KEY, latest_per_key
from tripmill.operators.filters import business_rules
from tripmill.plans.silver import derived, typed, without_malformed_times
from tripmill.schema import TRIP_STATE, TRIP_STATE_BATCHES
from tripmill.sources.warehouse import Warehouse

KEY = "trip_id"


def latest_rows(bronze: DataFrame) -> DataFrame:
    """Parsed columns of the latest row of each trip of ``bronze``, valid or not, with the trip's key."""
    return latest_per_key(typed(bronze)).select(
        surrogate_key(*[F.col(c) for c in TRIP_KEY]).alias(KEY), "*"
    )


def merged(history: DataFrame, fresh: DataFrame, buckets: int) -> DataFrame:
    """The later of both rows of each trip; ``history`` is bucketed by the key into ``buckets``.

    Both sides have one row per key. Only ``fresh`` is shuffled.
    """
    old = history.select(KEY, F.struct(*history.columns).alias("old"))
    new = fresh.repartition(buckets, KEY).select(F.col(KEY).alias("key"), F.struct(*history.columns).alias("new"))
    joined = old.join(new, F.col(KEY) == F.col("key"), "full_outer")
    before = F.coalesce(F.col("old.ingestion_id"), F.lit(-(1 << 63)))
    after = F.coalesce(F.col("new.ingestion_id"), F.lit(-(1 << 63)))
    later = F.col("old").isNull() | (F.col("new").isNotNull() & (after >= before))
    chosen = F.when(later, F.col("new")).otherwise(F.col("old"))
    return joined.select(chosen.alias("row")).select("row.*")


def advance_state(
    warehouse: Warehouse,
    version: int,
    also: Sequence[str] = (),
    buckets: int | None = None,
    from_scratch: bool = False,
    set_malformed_times_aside: bool = False,
) -> DataFrame:
    """Publish the state with all batches of bronze that it lacks; returns it as stored.

    Batches in ``also`` are merged even if the state holds them: rows appended to a batch later, or a batch
    that was replaced by one that holds every key of it. Merging a batch again changes nothing. ``buckets`` is
    the number of buckets, at first as many as there are shuffle tasks, later by default what the table has; another
    number deals the table anew once. ``from_scratch`` forgets the state and reads all of bronze.
    """
    base = None if from_scratch else warehouse.version_of(TRIP_STATE)
    present = warehouse.batches()
    bronze, taken = warehouse.bronze(), present
    if base is not None:
        applied = warehouse.read(TRIP_STATE_BATCHES).where(F.col("state_version") <= base)
        known = {row.batch_id for row in applied.select("batch_id").distinct().collect()}
        taken = sorted({b for b in present if b not in known} | set(also))
        if not taken:
            return warehouse.stored(TRIP_STATE, base)
        bronze = bronze.where(F.col("batch_id").isin(taken))
    if set_malformed_times_aside:
        bronze = without_malformed_times(bronze)
    rows = latest_rows(bronze)
    if base is None:
        buckets = buckets or int(warehouse.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(buckets, KEY)
    else:
        history = warehouse.stored(TRIP_STATE, base)
        buckets = buckets or warehouse.buckets_of(TRIP_STATE, base)
        rows = merged(history, rows, buckets)
    published = warehouse.publish(rows, TRIP_STATE, version, sort_by=("pickup_datetime",), buckets=(buckets, KEY))
    schema = T.StructType([T.StructField("state_version", T.LongType()), T.StructField("batch_id", T.StringType())])
    noted = warehouse.spark.createDataFrame([(version, b) for b in taken], schema).coalesce(1)
    warehouse.append(noted, TRIP_STATE_BATCHES)
    return published


def silver_of(state: DataFrame) -> DataFrame:
    """The silver table: valid rows of the state with measures and calendar parts; no shuffle."""
    return derived(state.where(business_rules()))
