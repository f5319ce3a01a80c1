"""Run one job: `python -m shelfmark bronze.sales --raw data/raw/sales`."""

from __future__ import annotations

import argparse

from shelfmark.plans import jobs
from shelfmark.schemas import TABLES
from shelfmark.session import build_session
from shelfmark.sources.tables import Lakehouse
from shelfmark.streaming.contracts import CONTRACTS


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="shelfmark")
    streams = {f"bronze.{topic}": contract for topic, contract in CONTRACTS.items()}
    parser.add_argument("job", choices=sorted([*TABLES, *streams]), help="the table to load")
    parser.add_argument("--raw", help="CSV file, directory or glob; a stream's landing folder")
    parser.add_argument("--format", default="json", help="of a stream's files")
    parser.add_argument("--infer", action="store_true", help="let Spark guess the CSV types")
    parser.add_argument("--location", help="folder of the databases")
    parser.add_argument("--prefix", default="", help="prefix of the database names")
    parser.add_argument(
        "--rebalance",
        action=argparse.BooleanOptionalAction,
        help="whether raw rows are shuffled to their partition, for few full files; else measured",
    )
    parser.add_argument("--input-bytes", type=int, help="size of the input, for the shuffles' width")
    parser.add_argument("--master", help="Spark master, if not set by spark-submit")
    args = parser.parse_args(argv)

    if args.job.startswith("bronze.") and not args.raw:
        parser.error("bronze jobs need --raw")
    spark = build_session(master=args.master, input_bytes=args.input_bytes)
    lake = Lakehouse(spark, args.location, args.prefix, rebalance=args.rebalance)
    if args.job in streams:
        rows = jobs.ingest_events(lake, streams[args.job], args.raw, args.format)
    elif args.job in jobs.REFRESH:
        rows = jobs.REFRESH[args.job](lake)
    else:
        rows = jobs.ingest_raw(lake, TABLES[args.job], args.raw, args.infer)
    print(f"{args.prefix}{args.job}: {rows:,} rows written")
    return rows


if __name__ == "__main__":
    main()
