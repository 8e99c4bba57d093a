"""Run one cycle: ``python -m snapfold SNAPSHOT... ROOT``."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from snapfold.operators import cdc
from snapfold.plans.cycle import run_cycle
from snapfold.session import configure
from snapfold.sources.lake import Lake


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="snapfold", description=__doc__)
    parser.add_argument("snapshot", nargs="+", help="snapshot files or folders")
    parser.add_argument("root", help="folder of the tables")
    parser.add_argument("--as-of", help="the date that stands for today")
    parser.add_argument("--prefix", default="", help="prefix of the database names")
    parser.add_argument("--buckets", type=int, help="number of buckets of the state")
    parser.add_argument("--keep", type=int, help="versions to keep of every table")
    parser.add_argument("--apply-salary", action="store_true", help="take over raises")
    options = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = configure(SparkSession.builder.appName("snapfold").getOrCreate())
    lake = Lake(spark, options.root, options.prefix, options.buckets)
    rules = cdc.EMPLOYEES.also_applying("salary") if options.apply_salary else cdc.EMPLOYEES
    print(run_cycle(lake, options.snapshot, options.as_of, rules, keep=options.keep))


if __name__ == "__main__":
    main()
