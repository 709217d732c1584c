"""Star schema of staged trips."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import bands, exact, periods
from tripmart.operators.merge import orphans


def fact_rides(
    staged: DataFrame,
    run_ts: datetime,
    data_source: str = "trip_archive",
    batch_id: str | None = None,
) -> DataFrame:
    """One row per ride; measures are decimals from here on."""
    stamp = periods.run_stamp(run_ts)
    minutes, km = F.col("trip_duration_minutes"), F.col("trip_distance_km")
    hours = minutes / F.lit(60.0)
    # Durations are whole seconds, so speed divides decimals and rounds once.
    seconds = F.round(minutes * 60).cast("bigint")
    speed = F.when(seconds > 0, exact.measure(km) * 3600 / seconds).otherwise(F.lit(0))
    return staged.select(
        "ride_id",
        F.col("started_at_ts").alias("started_at"),
        F.col("ended_at_ts").alias("ended_at"),
        "start_station_id",
        "end_station_id",
        F.upper("member_casual").alias("member_casual"),
        "rideable_type",
        exact.measure(minutes).alias("ride_duration_minutes"),
        exact.measure(hours).alias("ride_duration_hours"),
        exact.measure(km).alias("total_distance"),
        exact.measure(speed).alias("avg_speed_kmh"),
        F.col("trip_distance_category").alias("distance_category"),
        F.col("trip_duration_category").alias("duration_category"),
        "time_of_day",
        F.col("start_hour").alias("hour_of_day"),
        F.col("start_day_of_week").alias("day_of_week"),
        F.col("start_month").alias("month"),
        F.col("start_year").alias("year"),
        "dt",
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
        F.lit(data_source).alias("data_source"),
        F.lit(batch_id or run_ts.strftime("%Y-%m-%d_%H%M%S")).alias("batch_id"),
        F.lit(True).alias("is_valid"),
        F.to_date(stamp).alias("processing_date"),
    )


def dim_time(dates: DataFrame, date_col: str = "dt") -> DataFrame:
    """Attributes of every date present."""
    key = F.col("time_key")
    days = dates.select(F.col(date_col).alias("time_key")).distinct().filter(key.isNotNull())
    return days.select(
        key,
        F.year(key).alias("year"),
        F.month(key).alias("month"),
        F.dayofmonth(key).alias("day_of_month"),
        F.dayofweek(key).alias("day_of_week"),
        F.weekofyear(key).alias("week_of_year"),
        F.quarter(key).alias("quarter"),
        F.dayofweek(key).isin(*S.WEEKEND_DAYS).alias("is_weekend"),
        F.upper(bands.season(F.month(key))).alias("season"),
    )


#: Where a ride began or ended, as recorded.
PLACE = ("station_id", "station_name", "latitude", "longitude")


def ride_ends(staged: DataFrame, *carried: str) -> DataFrame:
    """The two ends of each trip: its place, ``departed``, the trip's minutes, and the columns ``carried``."""
    minutes = exact.measure(F.col("trip_duration_minutes"))

    def end(side: str):
        return F.struct(
            F.col(f"{side}_station_id").alias("station_id"),
            F.col(f"{side}_station_name").alias("station_name"),
            F.col(f"{side}_lat").alias("latitude"),
            F.col(f"{side}_lng").alias("longitude"),
            F.lit(side == "start").alias("departed"),
            minutes.alias("minutes"),
        )

    ends = staged.select(*carried, F.inline(F.array(end("start"), end("end"))))
    return ends.filter(F.col("station_id").isNotNull())


def place_sums(ends: DataFrame, *by: str, sign: Column | None = None) -> DataFrame:
    """Departures and arrivals of each place: rides, rides with a duration, and minutes, times ``sign`` where given."""
    sign = F.lit(1) if sign is None else sign
    return ends.groupBy(*by, *PLACE).agg(
        *(
            F.sum(F.when(condition, value).otherwise(0)).cast(kind).alias(f"{side}_{name}")
            for side, condition in (("out", F.col("departed")), ("in", ~F.col("departed")))
            for name, value, kind in (
                ("rides", sign, "long"),
                ("timed", F.when(F.col("minutes").isNotNull(), sign).otherwise(0), "long"),
                ("minutes", F.coalesce(F.col("minutes") * sign, F.lit(0)), "decimal(28,6)"),
            )
        )
    )


def stations_of(places: DataFrame) -> DataFrame:
    """Stations from the sums of their places: the lowest place, known values before missing ones."""
    parts = PLACE[1:]
    lowest = F.min(F.struct(*(x for c in parts for x in (F.isnull(c).alias(f"no_{c}"), F.col(c)))))
    stations = places.groupBy("station_id").agg(
        lowest.alias("place"),
        F.sum("out_rides").alias("total_departures"),
        F.sum("in_rides").alias("total_arrivals"),
        exact.mean_of(F.sum("out_minutes"), F.sum("out_timed"), 6).alias("avg_departure_duration"),
        exact.mean_of(F.sum("in_minutes"), F.sum("in_timed"), 6).alias("avg_arrival_duration"),
    )
    place = [F.col(f"place.{c}").alias(c) for c in parts]
    return stations.select("station_id", *place, *S.DIM_STATIONS.fieldNames()[4:])


def dim_stations(staged: DataFrame) -> DataFrame:
    """One row per station, with departures and arrivals.

    Each trip yields its two ends, which are counted per place in one shuffle
    with map-side partial sums; the second step merges the few places a station
    was recorded at. Grouping the ends by station gives what joining the distinct
    stations to both counts gives, without the joins.
    """
    return stations_of(place_sums(ride_ends(staged)))


def orphan_facts(facts: DataFrame, times: DataFrame, stations: DataFrame) -> DataFrame:
    """Facts whose date or station has no dimension row, counted per foreign key."""
    return orphans(
        facts,
        {
            "dt": (times, "time_key"),
            "start_station_id": (stations, "station_id"),
            "end_station_id": (stations, "station_id"),
        },
    )


def fact_sample(facts: DataFrame, rows: int = 5) -> DataFrame:
    """The first few facts by ride id."""
    return (
        facts.select("ride_id", "member_casual", "total_distance", "dt")
        .orderBy("ride_id")
        .limit(rows)
    )
