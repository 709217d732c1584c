"""Bands: numbers and hours mapped to words, and words mapped to an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas as S


def upper_bound_band(value: Column, bounds: Sequence[tuple[float, str]], rest: str) -> Column:
    """First band whose inclusive upper bound holds the value, else ``rest``."""
    (bound, word), *others = bounds
    chain = F.when(value <= bound, word)
    for bound, word in others:
        chain = chain.when(value <= bound, word)
    return chain.otherwise(rest)


def range_band(value: Column, ranges: Sequence[tuple[str, float, float | None]]) -> Column:
    """Band of half-open ranges ``[low, high)``; null outside all of them."""
    return F.coalesce(
        *(
            F.when((value >= low) & (F.lit(True) if high is None else value < high), word)
            for word, low, high in ranges
        )
    )


def hour_band(hour: Column, windows: Sequence[tuple[str, int, int]]) -> Column:
    """Band of inclusive hour windows; one that ends before it starts wraps midnight."""
    return F.coalesce(
        *(
            F.when(
                hour.between(first, last)
                if first <= last
                else (hour >= first) | (hour <= last),
                word,
            )
            for word, first, last in windows
        )
    )


def duration_band(minutes: Column) -> Column:
    return upper_bound_band(minutes, S.DURATION_BANDS, S.LAST_BAND)


def distance_band(km: Column) -> Column:
    return upper_bound_band(km, S.DISTANCE_BANDS, S.LAST_BAND)


def day_part(hour: Column) -> Column:
    return F.coalesce(hour_band(hour, S.DAY_PARTS), F.lit("night"))


def day_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*S.WEEKEND_DAYS), "weekend").otherwise("weekday")


def season(month: Column) -> Column:
    named = (F.when(month.isin(*months), word) for word, months in S.SEASON_MONTHS)
    return F.coalesce(*named, F.lit(S.LAST_SEASON))


def rank_of(word: Column, order: Sequence[str]) -> Column:
    """Place of a word in an ordered list, whatever its case; null if absent."""
    return F.coalesce(
        *(F.when(F.lower(word) == name, F.lit(place)) for place, name in enumerate(order, 1))
    )
