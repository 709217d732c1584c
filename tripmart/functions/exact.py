"""Decimal aggregates: the same digits whatever the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas as S


def measure(value: Column) -> Column:
    return value.cast(S.MEASURE)


def total(value: Column, digits: int) -> Column:
    """Sum of a measure, rounded half up."""
    return F.round(F.sum(value), digits).cast(f"decimal(38,{digits})")


def mean_of(total_value: Column, rows: Column, digits: int) -> Column:
    """``total / rows`` rounded half up; null where there are no rows."""
    return F.round(total_value / F.nullif(rows, F.lit(0)), digits).cast(f"decimal(18,{digits})")


def mean(value: Column, digits: int) -> Column:
    """Average of a measure. Divides at 16 decimals, so the one visible
    rounding is the last step."""
    return mean_of(F.sum(value), F.count(value), digits)


def percent(part: Column, whole: Column, digits: int = 6) -> Column:
    """``100 * part / whole`` where the whole is positive, else null."""
    whole = F.when(whole > 0, whole.cast("decimal(20,6)"))
    ratio = part.cast("decimal(20,6)") * F.lit(100) / whole
    return F.round(ratio, digits).cast(f"decimal(28,{digits})")
