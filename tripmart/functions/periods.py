"""Labels of days, months, quarters and years; month bounds; run stamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_label(dt: Column) -> Column:
    return F.date_format(dt, "yyyy-MM-dd")


def month_label(dt: Column) -> Column:
    return F.date_format(dt, "yyyy-MM")


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def month_name(dt: Column) -> Column:
    return F.date_format(dt, "MMMM")


def day_name(day_of_week: Column) -> Column:
    """English name of a day number, 1 = Sunday."""
    # 2023-01-01 was a Sunday.
    return F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), day_of_week - 1), "EEEE")


def first_of_month(dt: Column) -> Column:
    return F.trunc(dt, "month")


def month_bounds(month: str) -> tuple[Column, Column]:
    """First and last day of a ``yyyyMM`` month, as foldable expressions."""
    first = F.to_date(F.lit(month), "yyyyMM")
    return first, F.last_day(first)


def in_month(dt: Column, month: str) -> Column:
    return dt.between(*month_bounds(month))


def run_stamp(run_ts: datetime) -> Column:
    """One timestamp for a whole run, read in the session's time zone."""
    return F.lit(f"{run_ts:%Y-%m-%d %H:%M:%S}").cast("timestamp")
