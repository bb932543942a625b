"""Command line: ``python -m seatwise {generate,run,report,validate} ...``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from seatwise.plans.jobs import license_report
from seatwise.plans.pipeline import run_on_folder
from seatwise.plans.validation import validate
from seatwise.session import build_session, size_shuffles, temporary_store
from seatwise.sinks.parquet import write_tables
from seatwise.sinks.whole import whole_output
from seatwise.sources.generated import generate_tables, user_ids
from seatwise.sources.tables import preflight, read_parquet


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="seatwise")
    parser.add_argument("--master", help="Spark master; the cluster's own setting if not given")
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE",
                        help="a Spark setting; may be repeated")
    parser.add_argument("--rows", type=int, default=20, help="rows of each result to print")
    commands = parser.add_subparsers(dest="command", required=True)

    generate = commands.add_parser("generate", help="write synthetic tables")
    generate.add_argument("out")
    generate.add_argument("--users", type=int, default=100_000)
    generate.add_argument("--seed", type=int, default=0)

    run = commands.add_parser("run", help="decide requests, expire licenses, report")
    run.add_argument("tables")
    run.add_argument("out")
    run.add_argument("--now", help="timestamp for changed rows")
    run.add_argument("--by-status", action="store_true", help="one license folder per status")
    run.add_argument("--changes-only", action="store_true", help="write no full tables")

    report = commands.add_parser("report", help="count users and licenses")
    report.add_argument("tables")
    report.add_argument("out")
    for command in (run, report):
        command.add_argument("--include-expired", action="store_true")
        command.add_argument("--brief", action="store_true",
                             help="only counts by type and totals")

    validate = commands.add_parser("validate", help="count rows that break a constraint")
    validate.add_argument("tables")
    validate.add_argument("out")

    for command in (generate, run, report):
        command.add_argument("--as-of", help="reference date, today if not given")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    args = _arguments(argv)
    settings = dict(pair.split("=", 1) for pair in args.conf)
    spark = build_session(master=args.master, **settings)
    if args.command == "generate":
        as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
        write_tables(generate_tables(user_ids(spark, args.users), as_of, args.seed), args.out)
        return 0
    size_shuffles(spark, args.tables)
    if args.command == "run":
        results = run_on_folder(
            spark, args.tables, args.out, args.as_of, args.now,
            snapshots=not args.changes_only, by_status=args.by_status,
            include_expired=args.include_expired, brief=args.brief,
        )
    else:
        tables = read_parquet(spark, args.tables)
        with whole_output(spark, args.out, [args.tables]) as output, temporary_store(spark) as own:
            if args.command == "report":
                found = license_report(tables.licenses, args.as_of, args.include_expired,
                                       detailed=not args.brief, store=own)
            else:
                preflight(tables)
                found = validate(tables)
            for name, rows in found.items():
                output.store(rows, name)
        results = {name: output.table(name) for name in found}
    for name, rows in results.items():
        number = rows.count()
        print(f"{name}: {number} rows" + f", {args.rows} shown" * (number > args.rows))
        rows.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
