"""Command line: ``ingest SOURCE RAW``, ``clean RAW CLEAN``, ``report CLEAN NAME``.

Ends with 1 if a table failed, which is named; the others are done all the same.
"""
from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from pavilion.plans.analytics import ANALYTICS
from pavilion.plans.jobs import clean_all, ingest, report
from pavilion.plans.specs import BALL_BY_BALL_PER_INNINGS, SPECS
from pavilion.sources import FAILURES, replaced, write_table


def _arguments(args: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pavilion", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    copy = commands.add_parser("ingest", help="copy the raw tables in full")
    clean = commands.add_parser("clean", help="clean the raw tables, print the audit")
    clean.add_argument("--per-innings", action="store_true", help="count innings among the keys of a delivery")
    show = commands.add_parser("report", help="one named analytic, all its rows unless -k is given")
    show.add_argument("-k", type=int, help="only the first rows")
    show.add_argument("--out", help="write to this folder instead of printing")
    show.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="of the folder")
    for command in (copy, clean):
        command.add_argument("source")
        command.add_argument("target")
    show.add_argument("source")
    show.add_argument("name", choices=sorted(ANALYTICS))
    return parser.parse_args(args)


def _print(df: DataFrame) -> None:
    """Every row, a partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main(args: list[str]) -> int:
    chosen = _arguments(args)
    spark = SparkSession.builder.appName("pavilion").getOrCreate()
    errors: dict[str, str] = {}
    if chosen.command == "ingest":
        errors = ingest(spark, chosen.source, chosen.target)
    elif chosen.command == "clean":
        per_innings = {BALL_BY_BALL_PER_INNINGS.table: BALL_BY_BALL_PER_INNINGS}
        audit, errors = clean_all(spark, chosen.source, chosen.target, specs=SPECS | per_innings if chosen.per_innings else SPECS)
        _print(audit)
    else:
        try:
            found = report(spark, chosen.source, chosen.name, chosen.k)
            if chosen.out:
                with replaced(spark, chosen.out) as path:
                    write_table(found, path, chosen.format)
            else:
                _print(found)
        except (LookupError, *FAILURES) as problem:
            errors = {chosen.name: str(problem)}
    for name, problem in errors.items():
        print(f"{name}: {problem}", file=sys.stderr)
    return 1 if errors else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
