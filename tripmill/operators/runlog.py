"""Run log: append-only events, and the state of each run folded from them.

An event carries only the columns it sets. The state of a run takes, per column, the value of the
latest event that set it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.schema import RUN_EVENTS, RUN_LOG_EVENTS, RUNS

OPENED, INGESTED, CLOSED = 0, 1, 2
RUNNING_STATUS, INGESTED_STATUS = "running", "ingested"
SUCCESS, FAILED = "success", "failed"

_FOLDED = {
    # max_by skips rows whose ordering is NULL.
    name: f"max_by({name}, CASE WHEN {name} IS NOT NULL THEN event_seq END)"
    for name in RUNS.fieldNames()
    if name != "run_id"
}


def state_sql(events_table: str) -> str:
    """Current state of every run, as SQL text for a view."""
    columns = ", ".join(f"{fold} AS {name}" for name, fold in _FOLDED.items())
    return f"SELECT run_id, {columns} FROM {events_table} GROUP BY run_id"


def current_state(events: DataFrame) -> DataFrame:
    """Current state of every run: one row per ``run_id``."""
    return events.groupBy("run_id").agg(*[F.expr(f).alias(n) for n, f in _FOLDED.items()])


def latest_runs(state: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` runs opened last, newest first."""
    return state.orderBy(F.desc("run_id")).limit(n)


def _time(at: datetime):
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def _event(one_row: DataFrame, values: dict) -> DataFrame:
    """``values`` as an event row; columns it does not set are NULL."""
    columns = {f.name: values.get(f.name, F.lit(None)).cast(f.dataType) for f in RUN_EVENTS.fields}
    return one_row.select(*[c.alias(n) for n, c in columns.items()])


def next_run_id(events: DataFrame) -> int:
    """Id after that of all logged runs."""
    return events.agg(F.coalesce(F.max("run_id"), F.lit(0)) + 1).first()[0]


def open_event(
    spark: SparkSession, run_id: int, dag_id: str, task_id: str, execution_date: str, now: datetime
) -> DataFrame:
    return _event(
        spark.range(0, 1, numPartitions=1),
        {
            "event_seq": F.lit(OPENED),
            "run_id": F.lit(run_id),
            "dag_id": F.lit(dag_id),
            "task_id": F.lit(task_id),
            "execution_date": F.lit(execution_date),
            "status": F.lit(RUNNING_STATUS),
            "rows_ingested": F.lit(0),
            "rows_inserted": F.lit(0),
            "rows_updated": F.lit(0),
            "started_at": _time(now),
        },
    )


def ingested_event(spark: SparkSession, run_id: int, rows: int) -> DataFrame:
    return _event(
        spark.range(0, 1, numPartitions=1),
        {
            "event_seq": F.lit(INGESTED),
            "run_id": F.lit(run_id),
            "status": F.lit(INGESTED_STATUS),
            "rows_ingested": F.lit(rows),
        },
    )


def close_event(
    events: DataFrame,
    run_id: int,
    status: str,
    rows: int,
    now: datetime,
    error: str | None = None,
) -> DataFrame:
    """Closing event; no row if the run was never opened."""
    run = current_state(events.where(F.col("run_id") == run_id))
    seconds = (_time(now) - F.col("started_at")).cast("interval second")
    return _event(
        run,
        {
            "event_seq": F.lit(CLOSED),
            "run_id": F.col("run_id"),
            "status": F.lit(status),
            "rows_ingested": F.lit(rows),
            "error_message": F.lit(error),
            "completed_at": _time(now),
            # Two steps: an interval is cut to the scale it is cast to, a decimal is rounded.
            "duration_secs": seconds.cast("decimal(18,6)"),
        },
    )


class RunLog:
    """The run log of a warehouse."""

    def __init__(self, warehouse) -> None:
        self._warehouse = warehouse

    @property
    def events(self) -> DataFrame:
        return self._warehouse.read(RUN_LOG_EVENTS)

    def _append(self, event: DataFrame) -> None:
        self._warehouse.append(event, RUN_LOG_EVENTS)

    def open(self, dag_id: str, task_id: str, execution_date: str, now: datetime) -> int:
        """Log a new run; its id is the first after all logged ones that nobody has claimed.

        A claim is a file that only one of several drivers can create, so runs opened at once get ids of
        their own. A driver lost between claim and log leaves its id unused.
        """
        run_id = next_run_id(self.events)
        while not self._warehouse.create_once(RUN_LOG_EVENTS, f"run-{run_id}"):
            run_id += 1
        spark = self._warehouse.spark
        self._append(open_event(spark, run_id, dag_id, task_id, execution_date, now))
        return run_id

    def mark_ingested(self, run_id: int, rows: int) -> None:
        self._append(ingested_event(self._warehouse.spark, run_id, rows))

    def close(
        self, run_id: int, status: str, rows: int, now: datetime, error: str | None = None
    ) -> None:
        self._append(close_event(self.events, run_id, status, rows, now, error))

    def state(self) -> DataFrame:
        return current_state(self.events)

    def latest(self, n: int = 5) -> DataFrame:
        return latest_runs(self.state(), n)
