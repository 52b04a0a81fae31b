"""Jobs for spark-submit: ``python -m siltstone <job> ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession, functions as F

from siltstone.operators.quality import Expectations, health_report
from siltstone.plans import refresh as r, silver
from siltstone.schemas import feed_schema
from siltstone.session import build_session
from siltstone.sources.feeds import CORRUPT, DAY_FOLDERS, parse_lines, read_lines, split_lines
from siltstone.sources.sinks import write_partitioned
from siltstone.sources.tables import read_table
from siltstone.streaming import read_feed_stream, silver_stream, upsert_stream


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siltstone")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *roots: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=about)
        for root in roots:
            sub.add_argument(f"--{root}", required=True, help=f"root folder of the {root} layer")
        sub.add_argument("--at", help="processing time to stamp rows with, instead of now")
        return sub

    feeds = sorted(silver.TABLES)
    job("refresh", "rebuild every table", "bronze", "silver", "gold").add_argument(
        "--holidays", help="Parquet table with a column named date"
    )
    job("update", "bring every table up to what has landed since the last run", "bronze", "silver", "gold").add_argument(
        "--holidays", help="Parquet table with a column named date"
    )
    job("silver", "rebuild one cleaned table", "bronze", "silver").add_argument("feed", choices=feeds)

    gold = job("gold", "rebuild one dimension or fact", "silver", "gold")
    gold.add_argument("table", choices=[*r.DIMENSIONS, *r.FACTS])
    gold.add_argument("--holidays", help="Parquet table with a column named date")

    backfill = job("backfill", "redo a range of days of a cleaned table", "bronze", "silver")
    backfill.add_argument("feed", choices=feeds)
    for sub in (gold, backfill):
        for end in ("first", "last"):
            sub.add_argument(f"--{end}", type=date.fromisoformat, required=sub is backfill, help="day, YYYY-MM-DD")

    stream = job("stream", "merge what has landed since the last run into a cleaned table", "bronze", "silver")
    stream.add_argument("feed", choices=feeds)
    stream.add_argument("--state", required=True, help="checkpoint folder of the stream")
    stream.add_argument("--watermark", help="also drop copies as they arrive, within this delay")

    quarantine = job("quarantine", "set aside the lines of a feed that do not parse", "bronze")
    quarantine.add_argument("feed", choices=feeds)
    quarantine.add_argument("--to", required=True, help="folder for the lines")

    job("health", "rows, newest ingest time and share of checks passed per cleaned table", "silver")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    holidays = spark.read.parquet(args.holidays) if getattr(args, "holidays", None) else None
    if args.job == "refresh":
        for name, path in r.refresh(spark, args.bronze, args.silver, args.gold, holidays, args.at).items():
            print(f"{name}: {path}")
    elif args.job == "update":
        for name, folders in r.refresh_new(spark, args.bronze, args.silver, args.gold, holidays, args.at).items():
            print(f"{name}: {len(folders)} folders changed")
    elif args.job == "silver":
        seen = r.refresh_silver(spark, args.feed, f"{args.bronze}/{args.feed}", f"{args.silver}/{args.feed}", args.at)
        print(f"{args.feed}: {seen.get['rows']} rows")
    elif args.job == "gold":
        paths = r.table_paths(args.silver, args.gold)
        if args.table in r.DIMENSIONS:
            r.refresh_dimension(spark, args.table, paths, holidays, args.at)
        else:
            r.refresh_fact(spark, args.table, paths, args.at, args.first, args.last)
    elif args.job == "backfill":
        source, path = f"{args.bronze}/{args.feed}", f"{args.silver}/{args.feed}"
        r.backfill(spark, args.feed, source, path, args.first, args.last, at=args.at)
    elif args.job == "stream":
        table = silver.TABLES[args.feed]
        stream = read_feed_stream(spark, f"{args.bronze}/{args.feed}", feed_schema(args.feed))
        if args.watermark:
            rows = silver_stream(table, stream, args.watermark, args.at)
        else:
            rows = silver.finish(table.clean(stream), table, args.at)
        upsert_stream(
            rows, f"{args.silver}/{args.feed}", args.state, table.keys, table.newest, filed_by_key=table.filed_by_key
        )
    elif args.job == "quarantine":
        lines = read_lines(spark, f"{args.bronze}/{args.feed}")
        _, bad = split_lines(parse_lines(lines, feed_schema(args.feed)))
        write_partitioned(bad.select(F.col(CORRUPT).alias("line"), "_file", *DAY_FOLDERS), args.to, DAY_FOLDERS)
    elif args.job == "health":
        health_report({
            name: (read_table(spark, f"{args.silver}/{name}"), silver.INGESTED, Expectations(table.keys[:1], table.keys))
            for name, table in silver.TABLES.items()
        }).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(build_session(f"siltstone {args.job}"), args)


if __name__ == "__main__":
    main()
