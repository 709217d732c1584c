"""Change, growth and trend over a report of periods.

The windows here have no partition and so run in one task. Their input is one
row per day, month, quarter or year, after aggregation, which the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions import exact


def _previous(value: Column, order: str) -> Column:
    return F.lag(value).over(Window.orderBy(order))


def period_change(report: DataFrame, order: str, value: str = "total_rides") -> DataFrame:
    """Last period against the one before; no row if there are fewer than two."""
    current, previous = F.col("current_period"), F.col("previous_period")
    steps = report.select(
        F.col(order).alias("_order"),
        F.col(value).alias("current_period"),
        _previous(F.col(value), order).alias("previous_period"),
    )
    last = steps.orderBy(F.col("_order").desc()).limit(1).filter(previous.isNotNull())
    change = current - previous
    return last.select(
        current,
        previous,
        change.alias("change"),
        F.coalesce(exact.percent(change, previous), F.lit(0)).alias("change_pct"),
    )


def growth_rates(report: DataFrame, order: str, value: str = "total_rides") -> DataFrame:
    """Each period with its growth in percent; null where there is no basis."""
    previous = _previous(F.col(value), order)
    growth = exact.percent(F.col(value) - previous, previous)
    return report.withColumn("growth_pct", growth)


def growth_trend(report: DataFrame, order: str, value: str = "total_rides") -> DataFrame:
    """Mean growth, its label and the number of periods, in one row."""
    rates = growth_rates(report, order, value)
    totals = rates.agg(
        F.count(F.lit(1)).alias("periods"),
        F.count("growth_pct").alias("steps"),
        F.avg(F.col("growth_pct").cast("double")).alias("mean_growth"),
    )
    mean = F.col("mean_growth")
    label = (
        F.when(F.col("periods") < 2, "Insufficient Data")
        .when(F.col("steps") == 0, "No Growth Data")
        .when(mean > 5, "Growing")
        .when(mean > 0, "Stable Growth")
        .when(mean > -5, "Slight Decline")
        .otherwise("Declining")
    )
    rounded = F.round(F.coalesce(mean, F.lit(0.0)).cast("decimal(28,9)"), 4)
    return totals.select(
        label.alias("direction"),
        rounded.cast("decimal(18,4)").alias("avg_growth"),
        "periods",
    )


def trend_line(report: DataFrame, order: str, value: str = "total_rides") -> DataFrame:
    """Least-squares line over the row position, for reports of more than 3 rows."""
    whole = Window.partitionBy()
    placed = report.withColumns(
        {
            "_x": (F.row_number().over(Window.orderBy(order)) - 1).cast("double"),
            "_rows": F.count(F.lit(1)).over(whole),
        }
    ).filter(F.col("_rows") > 3)
    y = F.col(value).cast("double")
    slope = F.regr_slope(y, F.col("_x")).over(whole)
    intercept = F.regr_intercept(y, F.col("_x")).over(whole)
    fitted = F.round((intercept + slope * F.col("_x")).cast("decimal(28,9)"), 4)
    return placed.withColumn("trend", fitted.cast("decimal(28,4)")).drop("_x", "_rows")
