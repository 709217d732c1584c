"""Times the headline queries, the better of two runs each, and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import raw_trips, registered  # noqa: E402
from tripmart.plans import monthly, reports, rollups, sketches  # noqa: E402
from tripmart.schemas import AGG_SKETCHES, DIM_STATIONS, FACT_RIDES  # noqa: E402
from tripmart.sinks import zone_writer  # noqa: E402
from tripmart.sources import zones  # noqa: E402

HEADLINE = (
    "quality_report",
    "cleaning_counts",
    "fact_rides",
    "dim_stations",
    "category_distribution",
    "agg_daily_metrics",
    "agg_user_behavior",
    "agg_user_incremental",
    "upsert_fact",
    "member_distance_kpi",
    "hourly_distribution",
    "station_popularity",
    "top_routes",
    "database_stats",
    "monthly_comparison",
    "growth_trend",
)


MONTHS = ("202403", "202404")


def stored(spark: SparkSession, sf_dir: str, timed) -> dict[str, float]:
    """The load of a second month, and reports over the written tables."""
    lake, run_ts = monthly.Lake(zones.scratch_path(spark, "lake")), datetime(2025, 7, 1)
    raw = raw_trips(spark, sf_dir)
    for month in MONTHS:
        zone_writer.write_batch(zones.month_slice(raw, month), lake.raw, month)

    def load(month: str) -> None:
        monthly.transform_month(spark, lake, run_ts, month)
        changed = monthly.load_star(spark, lake, run_ts, month, replacing=True)
        monthly.load_rollups(spark, lake, days=changed)
        monthly.require_references(monthly.check_references(spark, lake, month))

    load(MONTHS[0])
    seconds = {"month_load": timed(lambda: load(MONTHS[1]))}
    facts = zones.read_table(spark, lake.table("fact_rides"), FACT_RIDES)
    stations = zones.read_table(spark, lake.table("dim_stations"), DIM_STATIONS)
    kept = zones.read_table(spark, lake.table("agg_sketches"), AGG_SKETCHES)
    frames = {
        "stored_member_distance_kpi": lambda: reports.member_distance_kpi(facts),
        "stored_top_routes": lambda: reports.top_routes(facts, stations),
        "stored_station_popularity": lambda: reports.station_popularity(facts, stations),
        "stored_monthly_comparison": lambda: reports.monthly_comparison(facts),
        "stored_agg_daily_metrics": lambda: rollups.daily_metrics(facts),
        "stored_agg_user_behavior": lambda: rollups.user_behavior(facts),
        "stored_sketch_kpi": lambda: sketches.range_kpi(kept),
        "stored_hourly_distribution": lambda: reports.hourly_distribution(facts),
        "stored_one_month": lambda: reports.daily_totals(zones.month_slice(facts, MONTHS[1])),
    }
    for name, frame in frames.items():
        write = lambda frame=frame: frame().write.format("noop").mode("overwrite").save()
        seconds[name] = min(timed(write), timed(write))
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tripmart-bench-"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return time.perf_counter() - start

    run("fact_rides")  # starts the JVM's workers and compiles the common stages
    seconds = {name: round(min(run(name), run(name)), 3) for name in HEADLINE}
    # what the made-up trips cost that most headlines begin with, and the same reports over stored trips
    seconds["fixture_trips"] = round(min(run("raw_trips"), run("raw_trips")), 3)
    seconds |= {name: round(value, 3) for name, value in stored(spark, sf_dir, timed).items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds[name] for name in HEADLINE), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
