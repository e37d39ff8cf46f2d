"""Run the whole batch: ``python -m rollcall --help``."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from rollcall.operators import master_sample, match_rate
from rollcall.plans import master_feeds, publish
from rollcall.rules import Settings
from rollcall.sources import Scratch, read_crm, read_transactions


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rollcall", description=__doc__)
    parser.add_argument("--crm", required=True, help="customer feed (CSV)")
    parser.add_argument("--transactions", required=True, help="purchase feed (CSV)")
    parser.add_argument("--layers", required=True, help="folder for both layers")
    parser.add_argument("--reports", required=True, help="folder for quality reports")
    parser.add_argument(
        "--scratch",
        help="shared folder for intermediate tables (default: spark.checkpoint.dir)",
    )
    parser.add_argument("--config", help="JSON file with thresholds and patterns")
    parser.add_argument(
        "--as-of", type=dt.date.fromisoformat, help="pin the reference day"
    )
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    settings = Settings()
    if args.config:
        with open(args.config, encoding="utf-8") as file:
            settings = Settings.from_mapping(json.load(file))
    spark = SparkSession.builder.appName("rollcall").getOrCreate()
    try:
        with Scratch(spark, args.scratch) as scratch:
            run = master_feeds(
                read_crm(spark, args.crm),
                read_transactions(spark, args.transactions),
                settings,
                as_of=args.as_of,
                scratch=scratch,
            )
            done = publish(run, args.layers, args.reports, settings)
        done.stats.show()
        match_rate(done.master).show()
        master_sample(done.master).show(truncate=20)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
