"""Percentiles and distinct counts over any range of dates, from sketches kept by date and rider.

A quantile sketch (KLL) of distances and sketches (HyperLogLog) of stations and routes are
a few kilobytes each, and those of many dates merge to that of all their rides. So a year's
figures come from some hundred rows, not from its facts. Counts, sums and means are exact;
percentiles are those of a rank that is off by RANK_ERROR at most, and distinct counts off by
about DISTINCT_ERROR. The exact reports are in ``plans.reports``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import exact
from tripmart.operators.merge import absent_rows

#: Size of a quantile sketch, and how far the rank of a percentile may be off (99 of 100 times), merged or not.
KLL_K, RANK_ERROR = 400, 0.0085
#: Logarithm of a distinct sketch's size, and the relative error of its count (two standard deviations, some 95 of 100 times).
HLL_LG_K, DISTINCT_ERROR = 14, 0.017


def route(facts: DataFrame) -> Column:
    """A route by its two stations; null if one is."""
    return F.when(
        F.col("start_station_id").isNotNull() & F.col("end_station_id").isNotNull(),
        F.concat(F.length("start_station_id").cast("string"), F.lit(":"), F.col("start_station_id"), F.col("end_station_id")),
    )


def daily_sketches(facts: DataFrame) -> DataFrame:
    """Sums and sketches of each date and rider type. Percentiles are of positive distances of timed rides, as the
    reports' are; ``timed_rides`` counts those."""
    km, minutes = F.col("total_distance"), F.col("ride_duration_minutes")
    positive = (km > 0) & (minutes > 0)
    known = facts.withColumns({"route": route(facts), "counts": F.coalesce(positive, F.lit(False))})

    def among(value: Column) -> Column:
        return F.when(F.col("counts"), value)

    rows = known.groupBy(F.col("dt").alias("date_key"), F.col("member_casual").alias("member_type")).agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.count_if("counts").alias("timed_rides"),
        F.sum(among(km)).cast("decimal(28,6)").alias("total_distance"),
        F.sum(among(minutes)).cast("decimal(28,6)").alias("total_minutes"),
        F.kll_sketch_agg_double(among(km).cast("double"), F.lit(KLL_K)).alias("distances"),
        *(
            F.hll_sketch_agg(among(F.col(column)), F.lit(HLL_LG_K)).alias(name)
            for column, name in (("start_station_id", "start_stations"), ("end_station_id", "end_stations"), ("route", "routes"))
        ),
    )
    return rows.select(*S.AGG_SKETCHES.fieldNames())


def new_sketches(facts: DataFrame, existing: DataFrame) -> DataFrame:
    """Sketches of dates the target does not hold yet."""
    return daily_sketches(absent_rows(facts, existing.select(F.col("date_key").alias("dt")), ["dt"]))


def range_kpi(sketches: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Distance KPIs per rider type from the dates ``first`` to ``last``, both included: member_casual, total_rides,
    avg_distance_km, total_distance_km, avg_duration_minutes (exact), median_distance_km, p75_distance_km,
    p25_distance_km, unique_start_stations, unique_end_stations, unique_routes (from sketches)."""
    if first:
        sketches = sketches.filter(F.col("date_key") >= F.lit(first))
    if last:
        sketches = sketches.filter(F.col("date_key") <= F.lit(last))
    merged = (
        sketches.filter(F.col("timed_rides") > 0)
        .groupBy(F.col("member_type").alias("member_casual"))
        .agg(
            F.sum("timed_rides").alias("total_rides"),
            F.sum("total_distance").alias("km"),
            F.sum("total_minutes").alias("minutes"),
            F.kll_merge_agg_double("distances", F.lit(KLL_K)).alias("distances"),
            *(F.hll_sketch_estimate(F.hll_union_agg(x)).alias(f"unique_{x}") for x in ("start_stations", "end_stations", "routes")),
        )
    )
    percentile = lambda part: F.round(F.kll_sketch_get_quantile_double("distances", F.lit(part)), 3)
    return merged.select(
        "member_casual", "total_rides",
        exact.mean_of(F.col("km"), F.col("total_rides"), 3).cast("double").alias("avg_distance_km"),
        F.round("km", 3).cast("double").alias("total_distance_km"),
        exact.mean_of(F.col("minutes"), F.col("total_rides"), 2).cast("double").alias("avg_duration_minutes"),
        percentile(0.5).alias("median_distance_km"), percentile(0.75).alias("p75_distance_km"), percentile(0.25).alias("p25_distance_km"),
        "unique_start_stations", "unique_end_stations", "unique_routes",
    )
