"""From raw trips to staged trips."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import bands, periods, trip


def first_per_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key: the first in a total order, so reruns keep the same row.

    ``row_number() = 1`` lets Spark drop the losers of a key in each map task, so
    a key with very many copies reaches the reducer as one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = order or [F.col(c) for c in df.columns if c not in keys]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def removed_by_key(df: DataFrame, key: str) -> DataFrame:
    """Rows before, rows after and rows removed by keeping one row per key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).select("*", (F.col("rows_before") - F.col("rows_after")).alias("removed"))


def filter_required(trips: DataFrame) -> DataFrame:
    return trips.filter(trip.has_required_fields())


def with_measures(trips: DataFrame) -> DataFrame:
    """Parsed timestamps, minutes and kilometres."""
    start, end = trip.parse_timestamp("started_at"), trip.parse_timestamp("ended_at")
    return trips.withColumns(
        {
            "started_at_ts": start,
            "ended_at_ts": end,
            "trip_duration_minutes": trip.minutes_between(start, end),
            "trip_distance_km": trip.great_circle_km(
                "start_lat", "start_lng", "end_lat", "end_lng"
            ),
        }
    )


def plausible() -> Column:
    return trip.is_plausible(F.col("trip_duration_minutes"), F.col("trip_distance_km"))


def filter_plausible(trips: DataFrame) -> DataFrame:
    return trips.filter(plausible())


def valid_trips(raw: DataFrame) -> DataFrame:
    """Complete, plausible trips with their measures, one per ride id.

    Any copy of a ride may survive; here a plausible one does if there is any.
    Incomplete rows go in the scan, so rows without a ride id never meet on one
    key. Plausibility orders the copies instead of filtering them first: a filter
    below the shuffle would parse and measure each row several times over, to
    spare the shuffle a few percent of the rows. The shuffle carries the raw
    columns only, so plans that use trips twice share it, whatever they select.
    """
    columns = S.TRIP_COLUMNS.fieldNames()
    flagged = with_measures(filter_required(raw)).select(
        *columns, (~F.coalesce(plausible(), F.lit(False))).alias("_implausible")
    )
    order = [F.col(c) for c in ["_implausible", *columns] if c != "ride_id"]
    first = first_per_key(flagged, "ride_id", order).filter(~F.col("_implausible"))
    return with_measures(first.select(*columns))


def with_calendar(trips: DataFrame) -> DataFrame:
    return trips.withColumns(trip.calendar(F.col("started_at_ts")))


def with_standard_types(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "rideable_type_clean": trip.known_or_unknown(F.col("rideable_type"), S.RIDEABLE_TYPES),
            "member_casual_clean": trip.known_or_unknown(F.col("member_casual"), S.RIDER_TYPES),
        }
    )


def with_bands(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "trip_duration_category": bands.duration_band(F.col("trip_duration_minutes")),
            "trip_distance_category": bands.distance_band(F.col("trip_distance_km")),
            "time_of_day": bands.day_part(F.col("start_hour")),
            "day_type": bands.day_type(F.col("start_day_of_week")),
            "season": bands.season(F.col("start_month")),
        }
    )


def stage_trips(raw: DataFrame, run_ts: datetime) -> DataFrame:
    """Raw trips to the stage zone's columns; ``run_ts`` stamps the whole run."""
    stamp = periods.run_stamp(run_ts)
    trips = with_bands(with_standard_types(with_calendar(valid_trips(raw))))
    stamped = trips.withColumns({"processed_at": stamp, "processing_date": F.to_date(stamp)})
    return stamped.select(*S.STAGED_TRIPS.fieldNames())
