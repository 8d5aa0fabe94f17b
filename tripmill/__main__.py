"""Command line: ``python -m tripmill run|check|runs`` (or through ``spark-submit``).

Tables live in the session's catalog; use one that outlasts the process, such as a Hive metastore.
"""

from __future__ import annotations

import argparse
from datetime import date

from tripmill.operators.quality import ERROR
from tripmill.operators.runlog import RunLog
from tripmill.plans.checks import raise_on_failures
from tripmill.plans.pipeline import check_warehouse, run_pipeline
from tripmill.session import build_session, size_to_input
from tripmill.sources.feed import PAGE_SIZE
from tripmill.sources.landing import Landing
from tripmill.sources.warehouse import Warehouse


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripmill")
    parser.add_argument("--prefix", default="", help="prefix of the layer databases' names")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="ingest landed pages and rebuild silver and gold")
    run.add_argument("landing_dir")
    run.add_argument("--source-url", required=True, help="where the pages were fetched from")
    run.add_argument("--day", default=date.today().isoformat(), help="execution date")
    run.add_argument("--page-size", type=int, default=PAGE_SIZE)
    run.add_argument("--max-pages", type=int, help="ingest pages below this number only")
    run.add_argument("--stop-at-short-page", action="store_true", help="end at a short page")
    run.add_argument("--set-malformed-times-aside", action="store_true", help="do not fail on them")
    run.add_argument("--buckets", type=int, help="number of buckets of the trip state and silver")
    run.add_argument("--from-scratch", action="store_true", help="rebuild silver from all of bronze")
    check = commands.add_parser("check", help="report the data-quality checks")
    for command in (run, check):
        command.add_argument(
            "--error",
            action="append",
            default=[],
            metavar="CHECK",
            help="check that fails the command, or '*' for all; may be repeated",
        )
    runs = commands.add_parser("runs", help="show the latest runs")
    runs.add_argument("-n", type=int, default=5)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(durable=True)
    warehouse = Warehouse(spark, args.prefix)
    if args.command == "run":
        landing = Landing(
            spark, args.landing_dir, args.page_size, args.max_pages, args.stop_at_short_page
        )
        size_to_input(spark, landing.bytes)
        result = run_pipeline(
            warehouse,
            landing,
            args.day,
            args.source_url,
            severities=dict.fromkeys(args.error, ERROR),
            set_malformed_times_aside=args.set_malformed_times_aside,
            buckets=args.buckets,
            from_scratch=args.from_scratch,
        )
        print(f"run {result.run_id}: {result.rows_ingested} rows in batch {result.batch_id}")
        if result.pages_left_out:
            print(f"{result.pages_left_out} landed pages left out")
        result.report.where("status <> 'pass'").show(100, truncate=False)
    elif args.command == "check":
        report = check_warehouse(warehouse, dict.fromkeys(args.error, ERROR))
        report.show(100, truncate=False)
        raise_on_failures(report)
    else:
        RunLog(warehouse).latest(args.n).show(args.n, truncate=False)


if __name__ == "__main__":
    main()
