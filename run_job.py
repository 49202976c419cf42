"""Run one daily job: ``spark-submit run_job.py load --help``."""

import argparse

from pyspark.sql import SparkSession

from tapeline.plans.jobs import run_clean, run_enrich, run_ingest, run_load
from tapeline.settings import configured


def main() -> None:
    parser = argparse.ArgumentParser(prog="run_job.py")
    parser.add_argument("--log", required=True, help="path of the run log table")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest", help="message files to the event table")
    job.add_argument("--csv", nargs="+", help="one format is enough")
    job.add_argument("--json", nargs="+")
    job.add_argument("--events", required=True)
    job.add_argument("--bad", help="path for the text of bad lines")

    job = jobs.add_parser("load", help="event table to daily trade and quote tables")
    job.add_argument("--events", required=True)
    job.add_argument("--tables", required=True)
    which = job.add_mutually_exclusive_group()
    which.add_argument("--dates", nargs="+", help="trade dates to rebuild, default those changed")
    job.add_argument("--zone", help="time zone of event times, such as America/New_York")
    which.add_argument("--everything", action="store_true", help="rebuild all dates")

    job = jobs.add_parser("enrich", help="trade and quote tables to enriched quotes")
    job.add_argument("--tables", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--dates", nargs="+", help="trade dates to write, default all")
    job.add_argument("--end-of-day", action="store_true")
    job.add_argument("--calendar-day", action="store_true")
    job.add_argument("--bid-price", action="store_true")

    job = jobs.add_parser("clean", help="delete what later runs replaced")
    job.add_argument("--tables", nargs="+", required=True, help="paths of single tables")
    job.add_argument("--keep-hours", type=float, default=24)

    args = parser.parse_args()
    spark = configured(SparkSession.builder).appName(f"tapeline-{args.job}").getOrCreate()
    if args.job == "ingest":
        run_ingest(spark, args.csv, args.json, args.events, args.log, args.bad)
    elif args.job == "load":
        run_load(spark, args.events, args.tables, args.log, args.dates, args.everything, args.zone)
    elif args.job == "clean":
        run_clean(spark, args.tables, args.log, args.keep_hours)
    else:
        run_enrich(
            spark,
            args.tables,
            args.output,
            args.log,
            args.dates,
            args.end_of_day,
            args.calendar_day,
            args.bid_price,
        )


if __name__ == "__main__":
    main()
