"""Daily rollups of ``fact_rides``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import exact
from tripmart.operators.merge import absent_rows, not_in_pairs


def _with_station_counts(
    rollup: DataFrame, facts: DataFrame, keys: Sequence[str], name: str
) -> DataFrame:
    """Adds the number of different start stations per key.

    Counted on its own: the map tasks send each (key, station) once, instead of
    dragging the other aggregates through a regrouping by station.
    """
    used = facts.select(*keys, "start_station_id").distinct()
    counts = used.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(
        F.count("start_station_id").alias(name)
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rollup.join(counts, same, "left").drop(*(f"_{k}" for k in keys))


def daily_metrics(facts: DataFrame) -> DataFrame:
    """One row per date; the lowest of equally frequent hours is the peak."""
    km, minutes = F.col("total_distance"), F.col("ride_duration_minutes")
    member, casual = (F.col("member_casual") == rider for rider in (S.MEMBER, S.CASUAL))
    daily = facts.groupBy("dt").agg(
        F.count(F.lit(1)).alias("total_rides"),
        exact.total(km, 3).alias("total_distance"),
        exact.mean(km, 3).alias("avg_distance"),
        exact.mean(minutes, 2).alias("avg_duration_minutes"),
        F.count_if(member).alias("member_rides"),
        F.count_if(casual).alias("casual_rides"),
        exact.mean(F.when(member, km), 3).alias("member_avg_distance"),
        exact.mean(F.when(casual, km), 3).alias("casual_avg_distance"),
        F.mode("hour_of_day", True).alias("peak_hour"),
    )
    rollup = _with_station_counts(daily, facts, ["dt"], "total_stations_used")
    return rollup.withColumnRenamed("dt", "date_key").select(*S.AGG_DAILY_METRICS.fieldNames())


def user_behavior(facts: DataFrame) -> DataFrame:
    """One row per date and rider type, with the most frequent bands (lowest on ties)."""
    km, minutes = F.col("total_distance"), F.col("ride_duration_minutes")
    keys = ["dt", "member_casual"]
    behavior = facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_rides"),
        exact.mean(km, 6).alias("avg_distance"),
        exact.mean(minutes, 6).alias("avg_duration_minutes"),
        exact.total(km, 6).alias("total_distance"),
        F.mode("time_of_day", True).alias("preferred_time_of_day"),
        F.mode("distance_category", True).alias("preferred_distance_category"),
        F.mode("duration_category", True).alias("preferred_duration_category"),
    )
    rollup = _with_station_counts(behavior, facts, keys, "unique_stations_used")
    renamed = rollup.withColumnsRenamed({"dt": "date_key", "member_casual": "member_type"})
    return renamed.select(*S.AGG_USER_BEHAVIOR.fieldNames())


def _known_dates(existing: DataFrame) -> DataFrame:
    return existing.select(F.col("date_key").alias("dt"))


def _without_known_pairs(rides: DataFrame, existing: DataFrame) -> DataFrame:
    return not_in_pairs(rides, existing, ("dt", "member_casual"), ("date_key", "member_type"))


def new_daily_metrics(facts: DataFrame, existing: DataFrame) -> DataFrame:
    """Rollup rows of dates the target does not hold yet."""
    return daily_metrics(absent_rows(facts, _known_dates(existing), ["dt"]))


def new_user_behavior(facts: DataFrame, existing: DataFrame) -> DataFrame:
    """Rollup rows of (date, rider type) pairs the target does not hold yet.

    The known pairs go from the rollup's rows, not from the rides, which are many more.
    Of a large fact table, pass the dates of ``dates_without_behavior`` only.
    """
    keys = ("date_key", "member_type")
    return not_in_pairs(user_behavior(facts), existing, keys, keys)


def dates_without_metrics(facts: DataFrame, existing: DataFrame) -> DataFrame:
    """Dates ``new_daily_metrics`` has rows for; reads the date column only."""
    return absent_rows(facts.select("dt").distinct(), _known_dates(existing), ["dt"])


def dates_without_behavior(facts: DataFrame, existing: DataFrame) -> DataFrame:
    """Dates ``new_user_behavior`` has rows for; reads date and rider type only."""
    pairs = facts.select("dt", "member_casual").distinct()
    return _without_known_pairs(pairs, existing).select("dt").distinct()
