"""Medallion pipeline for ride-trip records on Spark: bronze, silver, gold, checks and run log."""

from tripmill.plans.bronze import ingest
from tripmill.plans.checks import run_checks
from tripmill.plans.gold import (
    daily_trip_summary,
    hourly_demand_heatmap,
    payment_analysis,
    trip_rollup,
)
from tripmill.plans.pipeline import PipelineResult, run_pipeline
from tripmill.plans.silver import clean
from tripmill.session import build_session

__all__ = [
    "PipelineResult",
    "build_session",
    "clean",
    "daily_trip_summary",
    "hourly_demand_heatmap",
    "ingest",
    "payment_analysis",
    "run_checks",
    "run_pipeline",
    "trip_rollup",
]
