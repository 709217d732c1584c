"""Profiles of raw and staged trips, one aggregate pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import exact, trip
from tripmart.operators.cleaning import plausible, with_measures


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Number of different keys, a null counting as one. Shuffles the key alone."""
    return df.select(key).distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))


def quality_report(raw: DataFrame) -> DataFrame:
    """Rows, nulls per required field, duplicate ids, date range, out-of-area rows.

    One pass without a shuffle, and a second one over ``ride_id`` only for the
    exact distinct count: cheaper than sending every counter along with every id.
    """
    started = trip.parse_timestamp("started_at")
    profile = raw.agg(
        F.count(F.lit(1)).alias("total_records"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in S.REQUIRED_FIELDS),
        F.count_if(F.col("started_at").isNotNull() & started.isNull()).alias(
            "unparsable_started_at"
        ),
        F.min(started).alias("min_started_at"),
        F.max(started).alias("max_started_at"),
        F.count_if(trip.outside_service_area()).alias("invalid_coordinates"),
    )
    unique = distinct_keys(raw, "ride_id").scalar()
    return profile.withColumn("duplicate_ride_ids", F.col("total_records") - unique)


def cleaning_counts(raw: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, and rows each step removed.

    A ride id passes a step if one of its copies does, which is what
    ``valid_trips`` keeps.
    """
    complete = trip.has_required_fields()

    def flag(condition):
        return F.max(F.when(condition, 1).otherwise(0))

    per_id = with_measures(raw).groupBy("ride_id").agg(
        F.count(F.lit(1)).alias("copies"),
        flag(complete).alias("complete"),
        flag(complete & plausible()).alias("valid"),
    )
    totals = per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("after_dedup"),
        F.count_if(F.col("complete") == 1).alias("after_required"),
        F.count_if(F.col("valid") == 1).alias("after_plausible"),
    )
    return totals.select(
        "*",
        (F.col("total_records") - F.col("after_dedup")).alias("removed_duplicates"),
        (F.col("after_dedup") - F.col("after_required")).alias("removed_incomplete"),
        (F.col("after_required") - F.col("after_plausible")).alias("removed_implausible"),
    )


def data_summary(staged: DataFrame) -> DataFrame:
    """Counts, date range and means of staged trips."""
    minutes, km = (
        exact.measure(F.col(c)) for c in ("trip_duration_minutes", "trip_distance_km")
    )
    summary = staged.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("start_date").alias("earliest_date"),
        F.max("start_date").alias("latest_date"),
        exact.mean(minutes, 2).alias("avg_duration_minutes"),
        exact.mean(km, 2).alias("avg_distance_km"),
    )
    unique = distinct_keys(staged.filter(F.col("ride_id").isNotNull()), "ride_id").scalar()
    return summary.withColumn("unique_rides", unique)


def category_distribution(
    staged: DataFrame, categories: Sequence[str] = S.SUMMARY_CATEGORIES, top: int = 10
) -> DataFrame:
    """Most frequent values of each category column.

    The rows are counted once, by all columns together: few combinations, so the
    map tasks reduce them to almost nothing and only those are unpivoted.
    """
    combos = staged.groupBy(*categories).agg(F.count(F.lit(1)).alias("rides"))
    values = combos.unpivot(["rides"], list(categories), "category", "value")
    counts = values.groupBy("category", "value").agg(F.sum("rides").alias("rides"))
    order = (F.col("rides").desc(), F.col("value").asc_nulls_last())
    place = F.row_number().over(Window.partitionBy("category").orderBy(*order))
    ranked = counts.withColumn("place", place).filter(F.col("place") <= top)
    return ranked.orderBy("category", "place")


def invalid_coordinates(raw: DataFrame) -> DataFrame:
    """Trips out of the service area; counted by the reports, never removed."""
    return raw.filter(trip.outside_service_area())
