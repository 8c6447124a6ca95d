"""Command of the history job: ``python -m lumenflow.plans.history_job 2 --table db.orders ...``.

Reads a source with any Spark format, creates or advances the history table and prints one JSON
line with the outcome. Credentials come in an options file, not on the command line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from lumenflow.plans.history import run_scd
from lumenflow.session import build_session


def arguments(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="history_job", description="Create or advance a history table of type 1 or 2.")
    p.add_argument("kind", type=int, choices=(1, 2), help="type of the history")
    p.add_argument("--table", required=True, help="catalog name of the history")
    p.add_argument("--keys", required=True, help="key columns, comma-separated")
    p.add_argument("--change-key", required=True, help="column that grows with every change")
    p.add_argument("--tiebreak", default="", help="columns that order equal changes, comma-separated")
    p.add_argument("--format", default="jdbc", help="format of the source (default jdbc); 'table' reads --option name=<table>")
    p.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="option of the reader; may repeat")
    p.add_argument("--options-file", help="JSON object of further reader options, such as user and password")
    p.add_argument("--location-root", help="folder for the files (default: the warehouse)")
    p.add_argument("--buckets", type=int, help="buckets of a new type 1 table")
    p.add_argument("--merge-sql", help="file whose statement gives the new table from the views history and increment")
    p.add_argument("--lookback", help="begin this far before the newest change, e.g. 'INTERVAL 2 DAYS' or a number")
    p.add_argument("--row-key", default="", help="columns that tell source rows apart with --lookback (default: all)")
    return p.parse_args(argv)


def run(spark: SparkSession, given: argparse.Namespace):
    options = dict(o.split("=", 1) for o in given.option)
    if given.options_file:
        with open(given.options_file) as fh:
            options |= json.load(fh)
    source = spark.table(options["name"]) if given.format == "table" else spark.read.format(given.format).options(**options).load()
    split = lambda text: [c for c in text.split(",") if c]
    lookback = int(given.lookback) if given.lookback and given.lookback.lstrip("-").isdigit() else given.lookback
    return run_scd(
        spark, given.kind, given.table, source, split(given.keys), given.change_key, split(given.tiebreak) or None,
        location_root=given.location_root, buckets=given.buckets, merge_sql=given.merge_sql,
        lookback=lookback, row_key=split(given.row_key) or None,
    )


def main(argv: list[str] | None = None) -> None:
    given = arguments(sys.argv[1:] if argv is None else argv)
    done = run(build_session("history-job"), given)
    print(json.dumps({"table": done.table, "written": done.written, "incoming_rows": done.incoming_rows}))


if __name__ == "__main__":
    main()
