"""python -m tessera list | run QUERY DIRECTORY [--out PATH]: exit 0 done, 1 failed, 2 bad usage."""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    run = commands.add_parser("run")
    run.add_argument("query")
    run.add_argument("directory")
    run.add_argument("--out", help="write Parquet there instead of showing rows")
    try:
        args = parser.parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    from .plans import catalogue

    queries = catalogue.queries()
    if args.command == "list":
        print("\n".join(sorted(queries)))
        return 0
    if args.query not in queries:
        print(f"no query {args.query}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    try:
        df = queries[args.query](SparkSession.builder.appName("tessera").getOrCreate(), args.directory)
        df.write.parquet(args.out) if args.out else df.show(50, truncate=False)
    except Exception as e:  # noqa: BLE001
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
