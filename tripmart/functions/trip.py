"""Measures and calendar columns of one trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas as S


def parse_timestamp(column: str) -> Column:
    """Timestamp of a fixed pattern; null where the text does not follow it.

    Every raw row is parsed twice, and Spark's cast takes a fraction of the time
    of parsing by format. It also takes more forms, so the form is checked: by
    length and separators for the common one, by pattern for all others.
    """
    return F.expr(
        f"""
        CASE WHEN octet_length({column}) = 19
              AND instr({column}, '-') = 5
              AND instr({column}, ' ') = 11
              AND locate(':', {column}, 15) = 17
              AND NOT endswith({column}, 'Z')
             THEN TRY_CAST({column} AS TIMESTAMP)
             WHEN {column} RLIKE r'{S.TIMESTAMP_PATTERN}'
             THEN TRY_CAST({column} AS TIMESTAMP)
        END
        """
    )


def load_date(column: str) -> Column:
    return F.to_date(parse_timestamp(column))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, as fractional minutes."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)


def great_circle_km(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    """Spherical law of cosines, between two points given as columns in degrees.

    For equal points rounding may leave the cosine just below 1, which reads as
    some decimetres, or just above, where ``acos`` has no value. Equal points are
    0 apart by rule, and the clamp covers points that are nearly equal. A missing
    coordinate, or one that is not a number, gives no distance.
    """
    cosine = f"""(
        sin(radians({lat1})) * sin(radians({lat2}))
        + cos(radians({lat1})) * cos(radians({lat2})) * cos(radians({lng2}) - radians({lng1})))
    """
    return F.expr(
        f"""
        CASE WHEN isnan({cosine}) THEN NULL
             WHEN {lat1} = {lat2} AND {lng1} = {lng2} THEN 0.0D
             WHEN {cosine} IS NOT NULL
             THEN acos(greatest(-1.0D, least(1.0D, {cosine}))) * {S.EARTH_RADIUS_KM}
        END
        """
    )


def known_or_unknown(value: Column, known: Sequence[str]) -> Column:
    """The value where it is a listed one, else ``unknown`` (nulls too)."""
    return F.when(value.isin(*known), value).otherwise(F.lit("unknown"))


def calendar(ts: Column) -> dict[str, Column]:
    """Calendar columns of a start timestamp."""
    return {
        "start_date": F.to_date(ts),
        "dt": F.to_date(ts),
        "start_hour": F.hour(ts),
        "start_day_of_week": F.dayofweek(ts),
        "start_month": F.month(ts),
        "start_year": F.year(ts),
    }


def has_required_fields() -> Column:
    present = F.lit(True)
    for name in S.REQUIRED_FIELDS:
        present = present & F.col(name).isNotNull()
    return present


def is_plausible(minutes: Column, km: Column) -> Column:
    """Strict bounds; a missing measure is not plausible."""
    return (minutes > S.MIN_MINUTES) & (minutes < S.MAX_MINUTES) & (km < S.MAX_KM)


def outside_service_area() -> Column:
    """True if any of the eight coordinate limits is broken; nulls break none."""
    broken = F.lit(False)
    for side in ("start", "end"):
        for axis, (low, high) in (("lat", S.LATITUDE_RANGE), ("lng", S.LONGITUDE_RANGE)):
            value = F.col(f"{side}_{axis}")
            broken = broken | (value < low) | (value > high)
    return F.coalesce(broken, F.lit(False))
