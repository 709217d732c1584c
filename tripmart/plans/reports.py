"""Report queries over ``fact_rides``.

Each takes the facts, and ``dim_stations`` where names are needed, and returns a
lazy, ordered DataFrame. Nulls sort last ascending and first descending.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import bands, exact, periods
from tripmart.operators.percentile import exact_percentiles
from tripmart.operators.reshape import pivot_counts


def _rides() -> Column:
    return F.count(F.lit(1))


def _km() -> Column:
    return F.col("total_distance")


def _minutes() -> Column:
    return F.col("ride_duration_minutes")


def _rider() -> Column:
    return F.col("member_casual")


def _ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def positive_rides(facts: DataFrame) -> DataFrame:
    return facts.filter((_km() > 0) & (_minutes() > 0))


def _since(dt: Column, as_of: date | None, days: int) -> Column:
    """Rows from ``days`` before a date on; today unless a date is given."""
    end = F.lit(as_of) if as_of else F.current_date()
    return dt >= F.date_sub(end, days)


def _in_quarter(quarter: int, year: int | None) -> Column:
    """A quarter of every year, or of one."""
    inside = F.quarter("dt") == quarter
    return inside & (F.year("dt") == year) if year else inside


# --- riders -----------------------------------------------------------------


def member_distance_kpi(facts: DataFrame) -> DataFrame:
    """Per rider type: rides, distance mean, total and quartiles, minutes, stations.

    Rides collapse to (rider, start, end) partial sums in the map tasks; the two
    distinct counts then run over those few rows.
    """
    rides = positive_rides(facts)
    routes = rides.groupBy("member_casual", "start_station_id", "end_station_id").agg(
        _rides().alias("rides"), F.sum(_km()).alias("km"), F.sum(_minutes()).alias("minutes")
    )
    totals = routes.groupBy("member_casual").agg(
        F.sum("rides").alias("total_rides"),
        exact.mean_of(F.sum("km"), F.sum("rides"), 3).alias("avg_distance_km"),
        exact.total(F.col("km"), 3).alias("total_distance_km"),
        exact.mean_of(F.sum("minutes"), F.sum("rides"), 2).alias("avg_duration_minutes"),
        F.count_distinct("start_station_id").alias("unique_start_stations"),
        F.count_distinct("end_station_id").alias("unique_end_stations"),
    )
    quartiles = exact_percentiles(
        rides,
        "member_casual",
        "total_distance",
        {"median_distance_km": 0.5, "p75_distance_km": 0.75, "p25_distance_km": 0.25},
    ).withColumnRenamed("member_casual", "_rider")
    report = totals.join(quartiles, _rider().eqNullSafe(F.col("_rider")), "left")
    return report.select(
        "member_casual",
        "total_rides",
        "avg_distance_km",
        "total_distance_km",
        "median_distance_km",
        "p75_distance_km",
        "p25_distance_km",
        "avg_duration_minutes",
        "unique_start_stations",
        "unique_end_stations",
    ).orderBy(*_ascending("member_casual"))


def kpi_pivot(kpi: DataFrame, riders: Sequence[str] | None = None) -> DataFrame:
    """Every KPI row against the rider types, with its rides in its own column."""
    index = [c for c in kpi.columns if c != "member_casual"]
    return pivot_counts(kpi, index, "member_casual", "total_rides", riders)


def _side_by_side(kpi: DataFrame) -> DataFrame:
    """One row with members' and casual riders' KPIs; none if either is missing."""
    values = [c for c in kpi.columns if c != "member_casual"]
    riders = {"member": S.MEMBER, "casual": S.CASUAL}
    wide = kpi.agg(
        *(
            F.max(F.when(_rider() == rider, F.col(c))).alias(f"{side}_{c}")
            for side, rider in riders.items()
            for c in values
        )
    )
    return wide.filter("member_total_rides IS NOT NULL AND casual_total_rides IS NOT NULL")


def member_vs_casual(kpi: DataFrame) -> DataFrame:
    """Members minus casual riders; total distance in percent of the casual one."""

    def gap(name: str) -> Column:
        return F.col(f"member_{name}") - F.col(f"casual_{name}")

    return _side_by_side(kpi).select(
        F.col("member_avg_distance_km"),
        gap("avg_distance_km").alias("avg_distance_delta"),
        F.col("member_total_distance_km"),
        exact.percent(gap("total_distance_km"), F.col("casual_total_distance_km"), 4).alias(
            "total_distance_delta_pct"
        ),
        F.col("member_median_distance_km"),
        gap("median_distance_km").alias("median_distance_delta"),
        F.col("member_avg_duration_minutes"),
        gap("avg_duration_minutes").alias("avg_duration_delta"),
    )


#: Topics of the insights: KPI, unit, decimals in the text.
INSIGHTS = (
    ("distance", "avg_distance_km", "km", 3),
    ("duration", "avg_duration_minutes", "min", 1),
    ("stations", "unique_start_stations", "stations", 0),
)


def member_insights(kpi: DataFrame) -> DataFrame:
    """Per topic the side that leads, both values, and a line of text; casual riders lead a tie."""

    def row(topic: str, name: str, unit: str, digits: int) -> Column:
        member, casual = F.col(f"member_{name}"), F.col(f"casual_{name}")
        leads = member > casual
        texts = [F.round(v, digits).cast(f"decimal(18,{digits})").cast("string") for v in (member, casual)]
        ahead, behind = F.when(leads, texts[0]).otherwise(texts[1]), F.when(leads, texts[1]).otherwise(texts[0])
        leader = F.when(leads, S.MEMBER).otherwise(S.CASUAL)
        return F.struct(
            F.lit(topic).alias("topic"),
            leader.alias("leading"),
            member.cast("double").alias("member_value"),
            casual.cast("double").alias("casual_value"),
            F.concat(F.lit(f"{topic}: "), leader, F.lit(" leads with "), ahead, F.lit(" to "), behind, F.lit(f" {unit}")).alias("insight"),
        )

    return _side_by_side(kpi).select(F.inline(F.array(*(row(*one) for one in INSIGHTS))))


# --- distributions ----------------------------------------------------------


def _by_rider(facts: DataFrame, column: str, *more: Column) -> DataFrame:
    return (
        positive_rides(facts)
        .groupBy(column, "member_casual")
        .agg(
            _rides().alias("ride_count"),
            exact.mean(_km(), 6).alias("avg_distance"),
            exact.mean(_minutes(), 6).alias("avg_duration"),
            *more,
        )
    )


def hourly_distribution(facts: DataFrame) -> DataFrame:
    return _by_rider(facts, "hour_of_day").orderBy(*_ascending("hour_of_day", "member_casual"))


def weekly_patterns(facts: DataFrame) -> DataFrame:
    weekly = _by_rider(facts, "day_of_week").withColumn(
        "day_name", periods.day_name(F.col("day_of_week"))
    )
    return weekly.orderBy(*_ascending("day_of_week", "member_casual"))


def distance_category_analysis(facts: DataFrame) -> DataFrame:
    """By distance band, shortest first."""
    rank = bands.rank_of(F.col("distance_category"), S.BAND_ORDER)
    by_band = _by_rider(facts, "distance_category", exact.total(_km(), 6).alias("total_distance"))
    return by_band.orderBy(rank.asc_nulls_last(), *_ascending("member_casual"))


def time_of_day_analysis(facts: DataFrame) -> DataFrame:
    """By day part, morning first."""
    rank = bands.rank_of(F.col("time_of_day"), S.DAY_PART_ORDER)
    by_part = _by_rider(facts, "time_of_day")
    return by_part.orderBy(rank.asc_nulls_last(), *_ascending("member_casual"))


def distance_category_pivot(facts: DataFrame, riders: Sequence[str] | None = None) -> DataFrame:
    """Rides per distance band, one column per rider type."""
    rides = positive_rides(facts).groupBy("distance_category", "member_casual")
    return pivot_counts(
        rides.agg(_rides().alias("ride_count")),
        ["distance_category"],
        "member_casual",
        "ride_count",
        riders,
    )


# --- stations and routes ----------------------------------------------------


def station_totals(facts: DataFrame, stations: DataFrame) -> DataFrame:
    """Rides from each station, without a name where no station row has one. Names join the totals, not the rides."""
    per_station = (
        facts.filter(F.col("start_station_id").isNotNull())
        .groupBy("start_station_id", "dt")
        .agg(
            _rides().alias("rides"),
            F.sum(_km()).alias("km"),
            F.sum(_minutes()).alias("minutes"),
            F.count_if(_rider() == S.MEMBER).alias("member"),
            F.count_if(_rider() == S.CASUAL).alias("casual"),
        )
        .groupBy(F.col("start_station_id").alias("station_id"))
        .agg(
            F.sum("rides").alias("total_rides"),
            F.count(F.lit(1)).alias("active_days"),
            exact.mean_of(F.sum("km"), F.sum("rides"), 6).alias("avg_distance"),
            exact.mean_of(F.sum("minutes"), F.sum("rides"), 6).alias("avg_duration"),
            F.sum("member").alias("member_rides"),
            F.sum("casual").alias("casual_rides"),
        )
    )
    names = stations.select("station_id", "station_name")
    totals = [c for c in per_station.columns if c != "station_id"]
    return per_station.join(names, "station_id", "left").select("station_name", "station_id", *totals)


def station_popularity(facts: DataFrame, stations: DataFrame, limit: int = 20) -> DataFrame:
    """Start stations with the most rides."""
    return (
        station_totals(facts, stations)
        .orderBy(F.col("total_rides").desc(), *_ascending("station_name", "station_id"))
        .limit(limit)
    )


def top_routes(facts: DataFrame, stations: DataFrame, limit: int = 10) -> DataFrame:
    """Most ridden pairs of different station names.

    Rides are summed per pair of ids before the two name lookups. A station without
    a name goes by its id.
    """
    pairs = (
        facts.filter(
            F.col("start_station_id").isNotNull()
            & F.col("end_station_id").isNotNull()
            & (_km() > 0)
        )
        .groupBy("start_station_id", "end_station_id")
        .agg(
            _rides().alias("rides"),
            F.sum(_km()).alias("km"),
            F.sum(_minutes()).alias("minutes"),
            F.count_if(_rider() == S.MEMBER).alias("member"),
            F.count_if(_rider() == S.CASUAL).alias("casual"),
        )
    )

    def names(side: str) -> DataFrame:
        return stations.select(
            F.col("station_id").alias(f"{side}_station_id"),
            F.col("station_name").alias(f"{side}_station_name"),
        )

    start, end = F.col("start_station_name"), F.col("end_station_name")
    named = pairs.join(names("start"), "start_station_id", "left").join(names("end"), "end_station_id", "left")
    named = named.withColumns(
        {f"{side}_station_name": F.coalesce(f"{side}_station_name", f"{side}_station_id") for side in ("start", "end")}
    )
    routes = (
        named.filter(start != end)
        .groupBy("start_station_name", "end_station_name")
        .agg(
            F.sum("rides").alias("ride_count"),
            exact.mean_of(F.sum("km"), F.sum("rides"), 6).alias("avg_distance"),
            exact.mean_of(F.sum("minutes"), F.sum("rides"), 6).alias("avg_duration"),
            F.sum("member").alias("member_rides"),
            F.sum("casual").alias("casual_rides"),
        )
    )
    top = routes.orderBy(
        F.col("ride_count").desc(), *_ascending("start_station_name", "end_station_name")
    ).limit(limit)
    return top.withColumn("route", F.concat(start, F.lit(" → "), end))


# --- periods ----------------------------------------------------------------


def daily_totals(facts: DataFrame) -> DataFrame:
    """Per date and rider type, all dates."""
    return facts.groupBy("dt", "member_casual").agg(
        _rides().alias("daily_rides"),
        exact.mean(_km(), 3).alias("avg_daily_distance"),
        exact.total(_km(), 3).alias("total_daily_distance"),
        exact.mean(_minutes(), 2).alias("avg_daily_duration"),
    )


def daily_trends(facts: DataFrame, days: int = 30, as_of: date | None = None) -> DataFrame:
    """Per date and rider type over the last days, newest first."""
    recent = daily_totals(facts).filter(_since(F.col("dt"), as_of, days))
    return recent.orderBy(F.col("dt").desc_nulls_first(), *_ascending("member_casual"))


def database_stats(facts: DataFrame) -> DataFrame:
    """Four text metrics; rides collapse to one row per start station first."""
    totals = (
        facts.groupBy("start_station_id")
        .agg(
            _rides().alias("rides"),
            F.sum(_km()).alias("km"),
            F.min("dt").alias("first_dt"),
            F.max("dt").alias("last_dt"),
        )
        .agg(
            F.coalesce(F.sum("rides"), F.lit(0)).alias("rides"),
            exact.total(F.col("km"), 2).alias("km"),
            F.count("start_station_id").alias("stations"),
            F.min("first_dt").alias("first_dt"),
            F.max("last_dt").alias("last_dt"),
        )
    )

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    def or_empty(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    dates = F.concat(or_empty(text("first_dt")), F.lit(" to "), or_empty(text("last_dt")))
    metrics = F.array(
        *(
            F.struct(F.lit(metric).alias("metric"), value.alias("value"))
            for metric, value in (
                ("Total Rides", text("rides")),
                ("Total Distance (km)", text("km")),
                ("Unique Stations", text("stations")),
                ("Date Range", dates),
            )
        )
    )
    return totals.select(F.inline(metrics))


def quarter_analysis(facts: DataFrame, quarter: int, year: int | None = None) -> DataFrame:
    return facts.filter(_in_quarter(quarter, year)).agg(
        _rides().alias("total_rides"),
        exact.total(_km(), 2).alias("total_distance"),
        exact.mean(_km(), 2).alias("avg_distance"),
        exact.mean(_minutes(), 2).alias("avg_duration"),
    )


def quarter_by_member(facts: DataFrame, quarter: int, year: int | None = None) -> DataFrame:
    by_rider = facts.filter(_in_quarter(quarter, year)).groupBy("member_casual")
    return by_rider.agg(
        _rides().alias("total_rides"),
        exact.total(_km(), 2).alias("total_distance"),
        exact.mean(_km(), 2).alias("avg_distance"),
    ).orderBy(*_ascending("member_casual"))


def _period_totals(facts: DataFrame, **keys: Column) -> DataFrame:
    """Rides and distance per period. Days are summed before anything coarser."""
    per_day = facts.groupBy("dt").agg(_rides().alias("rides"), F.sum(_km()).alias("km"))
    return (
        per_day.groupBy(*(key.alias(name) for name, key in keys.items()))
        .agg(F.sum("rides").alias("total_rides"), exact.total(F.col("km"), 2).alias("total_distance"))
        .orderBy(*_ascending(*keys))
    )


def quarter_monthly_trend(facts: DataFrame, quarter: int, year: int | None = None) -> DataFrame:
    dt = F.col("dt")
    chosen = facts.filter(_in_quarter(quarter, year))
    return _period_totals(chosen, month=F.month(dt), month_name=periods.month_name(dt))


def daily_comparison(facts: DataFrame, days: int = 30, as_of: date | None = None) -> DataFrame:
    dt = F.col("dt")
    recent = facts.filter(_since(dt, as_of, days))
    return _period_totals(recent, period=dt, period_label=periods.day_label(dt))


def monthly_comparison(facts: DataFrame) -> DataFrame:
    dt = F.col("dt")
    return _period_totals(
        facts, period=periods.first_of_month(dt), period_label=periods.month_label(dt)
    )


def quarterly_comparison(facts: DataFrame) -> DataFrame:
    year, quarter = F.year("dt"), F.quarter("dt")
    return _period_totals(
        facts, year=year, quarter=quarter, period_label=periods.quarter_label(year, quarter)
    )


def yearly_comparison(facts: DataFrame) -> DataFrame:
    year = F.year("dt")
    return _period_totals(facts, year=year, period_label=year.cast("string"))
