"""Totals that different operators must agree on, over the small data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import queries as Q
from tests.conftest import SMALL
from tripmart import schemas as S
from tripmart.operators import quality
from tripmart.plans import reports, rollups, star


@pytest.fixture(scope="module")
def staged(spark):
    return Q.staged(spark, SMALL)


@pytest.fixture(scope="module")
def facts(staged):
    return star.fact_rides(staged, Q.RUN_TS)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_frames_have_their_declared_schema(staged, facts):
    declared = {
        S.STAGED_TRIPS: staged,
        S.FACT_RIDES: facts,
        S.DIM_TIME: star.dim_time(staged),
        S.DIM_STATIONS: star.dim_stations(staged),
        S.AGG_DAILY_METRICS: rollups.daily_metrics(facts),
        S.AGG_USER_BEHAVIOR: rollups.user_behavior(facts),
    }
    for schema, frame in declared.items():
        found = [(f.name, f.dataType.typeName()) for f in frame.schema.fields]
        assert found == [(f.name, f.dataType.typeName()) for f in schema.fields]


def test_category_counts_add_up(staged):
    rows = staged.count()
    per_category = quality.category_distribution(staged).groupBy("category")
    sums = {r.category: r.n for r in per_category.agg(F.sum("rides").alias("n")).collect()}
    assert sums == dict.fromkeys(S.SUMMARY_CATEGORIES, rows)


def test_periods_add_up_to_all_rides(facts):
    rows = facts.count()
    for report in (
        reports.monthly_comparison(facts),
        reports.quarterly_comparison(facts),
        reports.yearly_comparison(facts),
        rollups.daily_metrics(facts),
        rollups.user_behavior(facts),
    ):
        assert total(report, "total_rides") == rows
    quarters = [reports.quarter_analysis(facts, q).first().total_rides for q in (1, 2, 3, 4)]
    assert sum(quarters) == rows
    by_year = [
        reports.quarter_analysis(facts, 2, year).first().total_rides for year in (2024, 2025)
    ]
    assert sum(by_year) == quarters[1]


def test_departures_and_rides_without_a_start_add_up(staged):
    stations = star.dim_stations(staged)
    without_start = staged.filter("start_station_id IS NULL").count()
    without_end = staged.filter("end_station_id IS NULL").count()
    assert total(stations, "total_departures") + without_start == staged.count()
    assert total(stations, "total_arrivals") + without_end == staged.count()


def test_distributions_hold_the_same_rides(facts):
    rows = reports.positive_rides(facts).count()
    for report in (
        reports.hourly_distribution(facts),
        reports.weekly_patterns(facts),
        reports.distance_category_analysis(facts),
        reports.time_of_day_analysis(facts),
    ):
        assert total(report, "ride_count") == rows
    assert total(reports.member_distance_kpi(facts), "total_rides") == rows


def test_reports_are_ordered(facts):
    band_rows = reports.distance_category_analysis(facts).collect()
    bands = list(dict.fromkeys(r.distance_category for r in band_rows))
    assert bands == [b for b in S.BAND_ORDER if b in bands]
    parts = list(dict.fromkeys(r.time_of_day for r in reports.time_of_day_analysis(facts).collect()))
    assert parts == [p for p in S.DAY_PART_ORDER if p in parts]
    days = [r.dt for r in reports.daily_trends(facts, as_of=Q.AS_OF).collect()]
    assert days == sorted(days, reverse=True)


def test_staging_twice_gives_the_same_rows(spark, staged):
    again = Q.staged(spark, SMALL)
    assert staged.exceptAll(again).count() == 0
    assert again.exceptAll(staged).count() == 0
