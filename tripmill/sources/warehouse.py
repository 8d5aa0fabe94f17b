"""Tables of the four layers: bronze, silver, gold, metadata.

Bronze and the run log are append-only tables. A rebuilt table is written under a name of its own
version and then published by pointing the public view at it, so readers never meet a half-written
table and no data is moved to swap it in.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.runlog import state_sql
from tripmill.schema import (
    BRONZE,
    BRONZE_TRIPS,
    CHECK_COUNTS,
    LAYERS,
    READ_LEASES,
    RUN_EVENTS,
    RUN_LOG,
    RUN_LOG_EVENTS,
    TAKEN_PAGES,
    TRIP_STATE_BATCHES,
    as_table,
)

#: Name under which the check counts note that a batch was replaced.
REPLACED = "replaced"

# Small append-only tables beside the run log.
_NOTES = {
    TRIP_STATE_BATCHES: "state_version bigint, batch_id string",
    CHECK_COUNTS: "table_name string, version bigint, batch_id string, check_name string, failing bigint",
    READ_LEASES: "lease_id string, table_name string, version bigint, expires_at timestamp_ntz",
    TAKEN_PAGES: "stream string, run_id bigint, page bigint, micro_batch bigint",
}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _columns(table: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.fields)


def _require_plain(batch_id: str) -> None:
    if not re.fullmatch(r"[\w.-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r} may hold letters, digits, '_', '.' and '-' only")


class Warehouse:
    """Layer tables in the session's catalog; ``prefix`` keeps several warehouses apart."""

    def __init__(self, spark: SparkSession, prefix: str = "") -> None:
        self.spark = spark
        self.prefix = prefix

    def name(self, table: str) -> str:
        return self.prefix + table

    def create(self) -> Warehouse:
        """Create layers, append-only tables and the run-log view where they are missing."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name(layer)}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(BRONZE_TRIPS)} ({_columns(BRONZE)}) "
            "USING parquet PARTITIONED BY (batch_id)"
        )
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(RUN_LOG_EVENTS)} ({_columns(RUN_EVENTS)}) "
            "USING parquet"
        )
        for table, columns in _NOTES.items():
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(RUN_LOG)} AS {state_sql(self.name(RUN_LOG_EVENTS))}"
        )
        return self

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def bronze(self, batch_id: str | None = None) -> DataFrame:
        """All batches, or one of them (read from that batch's partition only)."""
        df = as_table(self.read(BRONZE_TRIPS), BRONZE)
        return df if batch_id is None else df.where(F.col("batch_id") == batch_id)

    def batches(self) -> list[str]:
        """Ids of all bronze batches, from the catalog's partitions alone."""
        shown = self.spark.sql(f"SHOW PARTITIONS {self.name(BRONZE_TRIPS)}").collect()
        return sorted(unquote(row.partition.split("=", 1)[1]) for row in shown)

    def version_of(self, table: str) -> int | None:
        """The version that the public view of a published table shows; None before the first."""
        public = self.name(table)
        if not self.spark.catalog.tableExists(public):
            return None
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {public}").where("col_name = 'View Text'")
        return int(re.search(r"__v(\d+)", described.first().data_type)[1])

    def stored(self, table: str, version: int) -> DataFrame:
        """The rows of one version of a published table."""
        return self.spark.table(f"{self.name(table)}__v{version}")

    def buckets_of(self, table: str, version: int) -> int:
        """Number of buckets of a version that was published in buckets."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}__v{version}")
        return int(described.where("col_name = 'Num Buckets'").first().data_type)

    def append(self, df: DataFrame, table: str) -> None:
        """Append rows; the job commits all of them or none."""
        as_table(df, self.read(table).schema).write.insertInto(self.name(table))

    def drop_batch(self, batch_id: str) -> None:
        """Take one bronze batch out."""
        _require_plain(batch_id)
        self.spark.sql(
            f"ALTER TABLE {self.name(BRONZE_TRIPS)} DROP IF EXISTS PARTITION (batch_id = '{batch_id}')"
        )

    def replace_batch(self, df: DataFrame, batch_id: str) -> None:
        """Write one bronze batch, replacing what an earlier try of it left."""
        _require_plain(batch_id)
        noted = self.spark.range(1).select(
            F.lit(BRONZE_TRIPS).alias("table_name"),
            F.lit(None).cast("bigint").alias("version"),
            F.lit(batch_id).alias("batch_id"),
            F.lit(REPLACED).alias("check_name"),
            F.lit(None).cast("bigint").alias("failing"),
        )
        self.append(noted, CHECK_COUNTS)
        columns = ", ".join(c for c in self.read(BRONZE_TRIPS).columns if c != "batch_id")
        # The partition is named in the statement: no other one is touched in any overwrite mode.
        # In the rows' own session, which a streaming micro-batch has.
        df.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {self.name(BRONZE_TRIPS)} "
            f"PARTITION (batch_id = '{batch_id}') SELECT {columns} FROM {{rows}}",
            rows=df,
        )

    def publish(
        self,
        df: DataFrame,
        table: str,
        version: int,
        order_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        statistics: Sequence[str] | str = (),
        buckets: tuple[int, str] | None = None,
        options: Mapping[str, str] | None = None,
        keep: int = 2,
    ) -> DataFrame:
        """Rebuild ``table`` as ``version`` and make it the public one.

        ``order_by`` is the order the public view reads in. ``cluster_by`` brings rows of equal
        values together in files and ``sort_by`` orders the rows of a file, both for min/max
        skipping; adaptive execution sizes the files, and spreads a value that many rows share over
        several. ``buckets`` is a number of buckets and the column that deals rows to them; rows that
        stand in such buckets already are written where they are, others with a file for each task and bucket,
        and ``sort_by`` orders a bucket's rows. ``statistics`` names the columns to analyze, or is
        ``"*"`` for all; ``options`` go to the file format. The newest ``keep`` versions stay, and older
        ones that readers hold (see ``reading``).
        """
        public = self.name(table)
        stored = f"{public}__v{version}"
        if cluster_by:
            df = df.hint("rebalance", *cluster_by)
        if sort_by and not buckets:
            df = df.sortWithinPartitions(*sort_by)
        self.spark.sql(f"DROP TABLE IF EXISTS {stored}")
        writer = df.write.format("parquet").options(**(options or {}))
        if buckets:
            writer = writer.bucketBy(*buckets)
            writer = writer.sortBy(*sort_by) if sort_by else writer
        with self._scans_by_bucket(bool(buckets)):
            writer.saveAsTable(stored)
        if statistics == "*":
            self.spark.sql(f"ANALYZE TABLE {stored} COMPUTE STATISTICS FOR ALL COLUMNS")
        elif statistics:
            names = ", ".join(statistics)
            self.spark.sql(f"ANALYZE TABLE {stored} COMPUTE STATISTICS FOR COLUMNS {names}")
        tail = f" ORDER BY {', '.join(order_by)}" if order_by else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {public} AS SELECT * FROM {stored}{tail}")
        self._drop_older(table, version, keep)
        return self.spark.table(stored)

    @contextmanager
    def _scans_by_bucket(self, wanted: bool) -> Iterator[None]:
        """Keep buckets apart in scans that no join or group asks it of: a bucket is then one task and one file."""
        key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
        before = self.spark.conf.get(key)
        if wanted:
            self.spark.conf.set(key, "false")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    @contextmanager
    def reading(
        self, table: str, seconds: int = 3600, clock: Callable[[], datetime] = utc_now
    ) -> Iterator[DataFrame]:
        """The published rows of ``table`` as they are now, kept until the block ends or ``seconds`` have passed.

        A lease is noted for the version; rebuilds drop no version that has one. A rebuild that began to drop
        versions before the lease was noted is told by the version being gone: the next one is taken.
        """
        while True:
            version, lease = self.version_of(table), uuid.uuid4().hex
            self._note_lease(lease, table, version, clock() + timedelta(seconds=seconds))
            if self.spark.catalog.tableExists(f"{self.name(table)}__v{version}"):
                break
        try:
            yield self.stored(table, version)
        finally:
            self._note_lease(lease, table, version, datetime(1970, 1, 1))

    def _note_lease(self, lease: str, table: str, version: int, until: datetime) -> None:
        row = self.spark.range(1).select(
            F.lit(lease).alias("lease_id"),
            F.lit(table).alias("table_name"),
            F.lit(version).cast("bigint").alias("version"),
            F.lit(until.isoformat(sep=" ")).cast("timestamp_ntz").alias("expires_at"),
        )
        self.append(row, READ_LEASES)

    def leased(self, table: str, now: datetime) -> set[int]:
        """Versions of ``table`` that readers hold: of leases not ended (an end is an earlier time) nor expired."""
        notes = self.read(READ_LEASES).where(F.col("table_name") == table)
        until = notes.groupBy("lease_id", "version").agg(F.min("expires_at").alias("until"))
        at = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
        return {row.version for row in until.where(F.col("until") > at).select("version").distinct().collect()}

    def create_once(self, table: str, name: str) -> bool:
        """Make an empty file beside the rows of ``table``; false if it was there already.

        One of several callers succeeds where the file system creates files atomically, as HDFS does.
        """
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}")
        folder = described.where("col_name = 'Location'").first().data_type
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/_claims/{name}")
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        try:
            return files.createNewFile(path)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise

    def _drop_older(self, table: str, current: int, keep: int) -> None:
        layer, bare = self.name(table).split(".")
        shown = self.spark.sql(f"SHOW TABLES IN {layer} LIKE '{bare}__v*'").collect()
        versions = {int(row.tableName.rsplit("__v", 1)[1]) for row in shown}
        older = sorted(versions - {current}, reverse=True)[keep - 1 :]
        held = self.leased(table, utc_now()) if older else set()
        for old in older:
            if old not in held:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}__v{old}")
