"""Command line: one step, or a whole month.

    spark-submit submit.py month --lake /lake --month 202404 --archives /landing/202404.zip

A failing step raises, so the process ends with a non-zero status.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tripmart.operators import quality
from tripmart.plans import monthly
from tripmart.schemas import RAW_TRIPS
from tripmart.sources.zones import read_zone

STEPS = ("ingest", "profile", "transform", "clear", "load", "month")


def parse(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripmart.jobs")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--lake", required=True, help="root folder of zones and mart")
    parser.add_argument("--month", help="yyyyMM; all months where a step allows it")
    parser.add_argument("--archives", nargs="+", help="landed zip files")
    parser.add_argument("--refresh", action="store_true", help="recompute rollups of known dates")
    options = parser.parse_args(args)
    if options.step in ("ingest", "clear", "month") and not options.month:
        parser.error(f"{options.step} needs --month")
    if options.step in ("ingest", "month") and not options.archives:
        parser.error(f"{options.step} needs --archives")
    return options


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    lake, month = monthly.Lake(options.lake), options.month
    run_ts = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    if options.step == "ingest":
        print("raw rows:", monthly.ingest_month(spark, options.archives, lake, month))
    elif options.step == "profile":
        raw = read_zone(spark, lake.raw, RAW_TRIPS, month)
        for profile in (quality.quality_report(raw), quality.cleaning_counts(raw)):
            profile.show(truncate=False, vertical=True)
    elif options.step == "transform":
        print("staged rows:", monthly.transform_month(spark, lake, run_ts, month))
    elif options.step == "clear":
        print("deleted:", monthly.clear_month(spark, lake, month))
    elif options.step == "load":
        changed = monthly.load_star(spark, lake, run_ts, month)
        monthly.load_rollups(spark, lake, days=changed)
        if options.refresh:
            monthly.load_rollups(spark, lake, month, refresh=True)
        monthly.require_references(monthly.check_references(spark, lake, month))
        monthly.refresh_statistics(spark, lake)
    else:
        report = monthly.run_month(
            spark, options.archives, lake, month, run_ts, options.refresh
        )
        print("raw rows:", report.raw_rows, "staged rows:", report.staged_rows)
        print("deleted:", report.deleted)
        for profile in (report.quality, report.cleaning, report.summary):
            profile.show(truncate=False, vertical=True)
        report.distribution.show(report.distribution.count(), truncate=False)


def main() -> None:
    options = parse()
    spark = (
        SparkSession.builder.appName(f"tripmart-{options.step}")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")  # see zones.with_compiled_steps
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    try:
        run(spark, options)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
