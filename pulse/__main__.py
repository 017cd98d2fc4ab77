"""Write the reporting datasets: `python -m pulse --help`."""

from __future__ import annotations

import argparse
import logging
from datetime import datetime

from pulse.plans import DATASETS, Params, run, source_tables
from pulse.session import build_session
from pulse.sources import load_tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pulse", description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--database", help="catalog database of the source tables")
    source.add_argument("--folder", help="folder with one <table>.parquet per source table")
    parser.add_argument("--out", required=True)
    parser.add_argument("--as-of", required=True, type=datetime.fromisoformat,
                        help="reference time, UTC")
    parser.add_argument("--since", type=datetime.fromisoformat, help="first access time, UTC")
    parser.add_argument("--page-labels", help="Parquet table (source, target) of page labels")
    parser.add_argument("--formats", nargs="+", default=["parquet", "csv"])
    parser.add_argument("--only", nargs="+", choices=list(DATASETS))
    parser.add_argument("--single-file", action="store_true")
    parser.add_argument("--in-place", action="store_true",
                        help="write folders straight to their place (object stores)")
    parser.add_argument("--run-id", help="go on with the run of this name where it ended")
    parser.add_argument("--legacy-dates", action="store_true")
    parser.add_argument("--shuffle-partitions", type=int)
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = build_session(
        legacy_dates=args.legacy_dates, shuffle_partitions=args.shuffle_partitions
    )
    names, _ = source_tables(args.only or DATASETS)
    tables = load_tables(spark, names, database=args.database, folder=args.folder)
    if args.page_labels:
        tables["page_labels"] = spark.read.parquet(args.page_labels)
    since = {"since": args.since} if args.since else {}
    run(
        tables, Params(as_of=args.as_of, **since), args.out, args.formats, args.only,
        single_file=args.single_file, in_place=args.in_place, run_id=args.run_id,
    )


if __name__ == "__main__":
    main()
