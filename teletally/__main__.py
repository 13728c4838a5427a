"""Command line of the batch job, for spark-submit or ``python -m teletally``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import types as T

from teletally.plans.job import build_profile, consolidate
from teletally.session import build_session
from teletally.sinks import export_names, write_csv, write_jdbc, write_parquet
from teletally.sources import read_log, read_parquet_log


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="teletally", description="Customer profiles from a daily viewing log")
    parser.add_argument("log", help="folder with the daily JSON files")
    parser.add_argument("start", help="first day, YYYYMMDD")
    parser.add_argument("end", help="last day, YYYYMMDD")
    parser.add_argument("output", help="target path, or table name with --format jdbc")
    parser.add_argument("--grain", choices=("customer", "day", "session"), default="customer")
    parser.add_argument("--layout", choices=("file", "folder"), default="file")
    parser.add_argument("--consolidated", action="store_true", help="the log is a Parquet table by log_date")
    parser.add_argument("--consolidate", action="store_true", help="only store the days read as such a table")
    parser.add_argument("--format", choices=("csv", "parquet", "jdbc"), default="csv")
    parser.add_argument("--mode", choices=("overwrite", "append", "errorifexists"), default="overwrite")
    parser.add_argument("--files", type=int, help="number of CSV files; only for small results")
    parser.add_argument("--duration", default="bigint", help="type of the durations, such as decimal(18,2)")
    parser.add_argument("--fail-on-broken", action="store_true", help="fail on a line that is no JSON")
    parser.add_argument("--drop-unknown-contract", action="store_true")
    parser.add_argument("--dedup", action="store_true")
    parser.add_argument(
        "--non-negative",
        action="store_true",
        help="no duration is negative: one shuffle less, and the job fails if one is",
    )
    parser.add_argument("--local-labels", action="store_true", help="category labels in the log's language")
    parser.add_argument("--jdbc-url", help="user and password are read from JDBC_USER and JDBC_PASSWORD")
    parser.add_argument("--jdbc-driver")
    args = parser.parse_args(argv)
    if args.format == "jdbc" and not (args.jdbc_url and args.jdbc_driver):
        parser.error("--format jdbc needs --jdbc-url and --jdbc-driver")

    spark = build_session("teletally")
    kind = T.StructType.fromDDL(f"duration {args.duration}")["duration"].dataType
    reading = {"layout": args.layout, "duration": kind, "fail_on_broken": args.fail_on_broken}
    if args.consolidate:
        consolidate(spark, args.log, args.output, args.start, args.end, **reading)
        return
    if args.consolidated:
        log = read_parquet_log(spark, args.log, args.start, args.end)
    else:
        log = read_log(spark, args.log, args.start, args.end, **reading)
    profile = build_profile(
        log,
        args.start,
        args.end,
        grain=args.grain,
        drop_unknown_contract=args.drop_unknown_contract,
        dedup=args.dedup,
        non_negative=args.non_negative,
    )
    table = export_names(profile, local_labels=args.local_labels)
    if args.format == "csv":
        write_csv(table, args.output, mode=args.mode, files=args.files)
    elif args.format == "parquet":
        write_parquet(table, args.output, mode=args.mode, by_day=False)
    else:
        properties = {
            "user": os.environ["JDBC_USER"],
            "password": os.environ["JDBC_PASSWORD"],
            "driver": args.jdbc_driver,
        }
        write_jdbc(table, args.jdbc_url, args.output, properties, mode=args.mode)


if __name__ == "__main__":
    main()
