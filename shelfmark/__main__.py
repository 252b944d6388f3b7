"""Run the jobs from a shell: python -m shelfmark {bronze,silver,gold,all} --help"""

import argparse
import sys
from datetime import datetime, timezone

from .plans.gold import GOLD_JOBS
from .plans.jobs import SOURCES, Inputs, StepsFailed, run_all, run_bronze, run_gold, run_silver
from .session import Layers, ObjectStore, SessionSpec, build_session


def _moment(text):
    """A time, in UTC unless it says otherwise."""
    own = datetime.fromisoformat(text)
    return own if own.tzinfo else own.replace(tzinfo=timezone.utc)


def parse(argv):
    layers = Layers.from_env()
    parser = argparse.ArgumentParser(prog="shelfmark")
    for layer in ("bronze", "silver", "gold"):
        parser.add_argument(f"--{layer}", default=getattr(layers, layer), metavar="URI")
    parser.add_argument("--master")
    parser.add_argument("--input-bytes", type=int, help="size of the raw data, for the shuffles")
    parser.add_argument("--csv-format", choices=["csv", "json", "parquet"], help="of Bronze books")
    parser.add_argument("--silver-buckets", type=int, help="merge new batches into so many buckets")
    runs = parser.add_subparsers(dest="run", required=True)
    for run in ("bronze", "all"):
        raw = runs.add_parser(run)
        raw.add_argument("--pages", metavar="URI", help="fetched pages (url, html)")
        raw.add_argument("--landing-csv", metavar="URI", help="folder of CSV files")
        raw.add_argument("--responses", metavar="URI", help="fetched responses (subject, body)")
        raw.add_argument("--raw-format", default="parquet", choices=["parquet", "json"])
        raw.add_argument("--max-pages", type=int)
        raw.add_argument("--subjects", nargs="+")
        raw.add_argument("--works-per-subject", type=int)
        raw.add_argument("--raw-partitions", type=int, help="deal few raw files out anew")
        raw.add_argument("--pages-by-number", action="store_true", help="as store_raw_pages wrote")
        raw.add_argument("--batch", type=_moment, help="time of the batch, as 2025-01-31T12:30:45")
        if run == "all":
            raw.add_argument("--parallel", action="store_true")
            raw.add_argument("--resume", action="store_true", help="go on with the run of --batch")
    runs.add_parser("silver").add_argument("--sources", nargs="+", choices=SOURCES, default=SOURCES)
    tables = tuple(GOLD_JOBS)
    runs.add_parser("gold").add_argument("--tables", nargs="+", choices=tables, default=tables)
    return parser.parse_args(argv)


def main(argv=None):
    args = parse(argv)
    spark = build_session(SessionSpec(master=args.master, store=ObjectStore.from_env()))
    layers = Layers(args.bronze, args.silver, args.gold)
    try:
        status = _run(spark, args, layers)
        failed = False
    except StepsFailed as failure:
        status, failed = failure.status, True
    status.show(status.count(), truncate=False)
    return 1 if failed else 0


def _run(spark, args, layers):
    size, formats = args.input_bytes, {"csv": args.csv_format}
    if args.run == "silver":
        return run_silver(
            spark, layers, args.sources, input_bytes=size, formats=formats, buckets=args.silver_buckets
        )
    if args.run == "gold":
        return run_gold(spark, layers, args.tables, input_bytes=size)
    inputs = Inputs(
        args.pages,
        args.landing_csv,
        args.responses,
        args.raw_format,
        args.max_pages,
        tuple(args.subjects) if args.subjects else None,
        args.works_per_subject,
        args.raw_partitions,
        args.pages_by_number,
    )
    if args.run == "bronze":
        return run_bronze(spark, inputs, layers, args.batch, formats=formats)
    if args.resume and args.batch is None:
        raise SystemExit("--resume needs the --batch of the run to go on with")
    return run_all(
        spark,
        inputs,
        layers,
        args.batch,
        parallel=args.parallel,
        input_bytes=size,
        formats=formats,
        buckets=args.silver_buckets,
        resume=args.resume,
    )


if __name__ == "__main__":
    sys.exit(main())
