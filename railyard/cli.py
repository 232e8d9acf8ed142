"""Command line for the two jobs (J12, J11), for ``spark-submit`` or
``python -m railyard``:

    railyard batch --raw s3a://raw --warehouse s3a://wh --date 2024-05-01
    railyard mart --warehouse s3a://wh --date-from 2024-05-01 --date-to 2024-05-02

The master, resources and object-store credentials come from
``spark-submit`` / the cluster configuration.
"""

from __future__ import annotations

import argparse
import json

from railyard.session import get_session


def _day(value: str) -> str:
    """A date or timestamp argument as a timestamp string."""
    return f"{value} 00:00:00" if len(value) == 10 else value


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="railyard")
    sub = parser.add_subparsers(dest="job", required=True)
    batch = sub.add_parser("batch", help="load one landing date: staging, dimensions, facts")
    batch.add_argument("--raw", required=True, help="landing root holding dt=YYYY-MM-DD folders")
    batch.add_argument("--warehouse", required=True, help="warehouse root")
    batch.add_argument("--date", required=True, help="landing partition dt=YYYY-MM-DD")
    batch.add_argument("--as-of", help="instant dimension changes take effect (default: the date)")
    batch.add_argument("--lookup", choices=["current", "as_of"], default="as_of")
    mart = sub.add_parser("mart", help="build the hourly route mart for [date-from, date-to)")
    mart.add_argument("--warehouse", required=True)
    mart.add_argument("--date-from", required=True)
    mart.add_argument("--date-to", required=True)
    mart.add_argument("--mode", choices=["append", "overwrite"], default="append")
    return parser


def main(argv: list[str] | None = None) -> dict:
    args = build_parser().parse_args(argv)
    spark = get_session(f"railyard-{args.job}")
    from railyard.plans.batch import run_batch, run_mart

    if args.job == "batch":
        result = run_batch(
            spark, args.raw, args.warehouse, args.date, as_of=args.as_of, lookup_mode=args.lookup
        )
    else:
        result = {}
        run_mart(
            spark, args.warehouse, _day(args.date_from), _day(args.date_to),
            mode=args.mode, counts=result,
        )
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
