"""Mart tables and report views under the names SQL users know."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripmart import schemas as S
from tripmart.plans import reports
from tripmart.plans.monthly import Lake
from tripmart.sources.zones import read_table

TABLES = {
    "dim_time": S.DIM_TIME,
    "dim_stations": S.DIM_STATIONS,
    "fact_rides": S.FACT_RIDES,
    "agg_daily_metrics": S.AGG_DAILY_METRICS,
    "agg_user_behavior": S.AGG_USER_BEHAVIOR,
}


def register_views(spark: SparkSession, lake: Lake) -> None:
    """Temporary views of the tables, and of three report queries over them."""
    tables = {name: read_table(spark, lake.table(name), kind) for name, kind in TABLES.items()}
    facts, stations = tables["fact_rides"], tables["dim_stations"]
    views = {
        **tables,
        "v_member_distance_kpi": reports.member_distance_kpi(facts),
        "v_daily_trends": reports.daily_totals(facts),
        "v_station_popularity": reports.station_totals(facts, stations),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
