"""Edge rows of the cleaning rules, bands, trends and percentiles."""

from __future__ import annotations

import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.helpers import RUN_TS, raw_frame, rows_of, trip_row
from tripmart import schemas as S
from tripmart.functions import bands, exact, periods, trip
from tripmart.operators import cleaning, merge, quality, reshape, trends
from tripmart.operators.percentile import exact_percentiles
from tripmart.plans import reports, rollups, star


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_duration_bounds_are_strict(spark):
    ends = {
        "minute": "2024-04-10 08:01:00",
        "over": "2024-04-10 08:01:01",
        "day": "2024-04-11 08:00:00",
        "under": "2024-04-11 07:59:59",
        "backwards": "2024-04-10 07:00:00",
    }
    raw = raw_frame(spark, [trip_row(k, ended_at=v) for k, v in ends.items()])
    kept = {r.ride_id for r in cleaning.valid_trips(raw).collect()}
    assert kept == {"over", "under"}


def test_unparsable_and_missing_values_drop_the_trip(spark):
    raw = raw_frame(
        spark,
        [
            trip_row("ok"),
            trip_row("fraction", started_at="2024-04-10 08:00:00.123"),
            trip_row("text", started_at="yesterday"),
            trip_row("nolat", end_lat=None),
            trip_row("far", end_lat=44.0),
            trip_row("notype", rideable_type=None),
            trip_row(None),
        ],
    )
    assert {r.ride_id for r in cleaning.valid_trips(raw).collect()} == {"ok", "fraction"}
    report = quality.quality_report(raw).first()
    assert report.total_records == 7
    assert report.null_ride_id == 1
    assert report.unparsable_started_at == 1
    assert report.invalid_coordinates == 1
    assert report.duplicate_ride_ids == 0


def test_parsing_accepts_what_the_format_accepts(spark):
    texts = [
        "2024-02-29 23:59:59",
        "2024-02-29 23:59:59.123",
        "2024-02-30 00:00:00",
        "2024-02-29 24:00:00",
        "2024-02-29T23:59:59",
        "2024-02-29 23:59:5Z",
        "2024-02-29 23:59+01",
        "2024-02-29 23:59:59 UTC",
        "2024-02-29 23:59:59.1+1",
        "2024-02-29 23:59:59.12",
        "2024-02-29 23:59",
        "2024-2-29 23:59:59",
        "12024-2-29 23:59:59",
        "+024-02-29 23:59:59",
        "-024-02-29 23:59:59",
        " 2024-02-29 23:59:5",
        "2024-02-29",
        "2024",
        "now",
        "",
        None,
    ]
    both = column(spark, texts, "string").select(
        "x",
        trip.parse_timestamp("x").alias("ours"),
        F.try_to_timestamp("x", F.lit("yyyy-MM-dd HH:mm:ss[.SSS]")).alias("format"),
    )
    rows = both.collect()
    assert [(r.x, r.ours) for r in rows] == [(r.x, r.format) for r in rows]
    assert sum(r.ours is not None for r in rows) == 3


def test_equal_points_are_zero_apart(spark):
    spots = [(41.6 + i * 0.013, -87.9 + (i % 7) * 0.05) for i in range(40)]
    raw = raw_frame(
        spark,
        [
            trip_row(f"R{i}", start_lat=a, end_lat=a, start_lng=b, end_lng=b)
            for i, (a, b) in enumerate(spots)
        ],
    )
    kept = cleaning.valid_trips(raw)
    assert [r.trip_distance_km for r in kept.collect()] == [0.0] * 40


def test_survivor_of_a_ride_is_a_valid_copy(spark):
    copies = [
        trip_row("R1", ended_at=None),
        trip_row("R1", ended_at="2024-04-10 08:00:10"),
        trip_row("R1", ended_at="2024-04-10 08:30:00"),
        trip_row("R1", ended_at="2024-04-10 08:20:00"),
        trip_row(None),
        trip_row(None),
    ]
    for rows in (copies, copies[::-1]):
        raw = raw_frame(spark, rows).repartition(3)
        assert [r.ended_at for r in cleaning.valid_trips(raw).collect()] == ["2024-04-10 08:20:00"]
        counts = quality.cleaning_counts(raw).first().asDict()
        assert counts == {
            "total_records": 6,
            "after_dedup": 2,
            "after_required": 1,
            "after_plausible": 1,
            "removed_duplicates": 4,
            "removed_incomplete": 1,
            "removed_implausible": 0,
        }


def test_copies_of_a_hot_ride_are_dropped_before_the_shuffle(spark):
    raw = raw_frame(spark, [trip_row()] * 50 + [trip_row(f"R{i}") for i in range(2, 10)])
    plan = cleaning.valid_trips(raw)._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning(ride_id") :]
    assert "WindowGroupLimit" in below_shuffle
    assert cleaning.valid_trips(raw).count() == 9


def test_quality_counts_null_id_as_one_key(spark):
    raw = raw_frame(spark, [trip_row(None), trip_row(None), trip_row("R1"), trip_row("R1")])
    assert quality.quality_report(raw).first().duplicate_ride_ids == 2
    assert quality.distinct_keys(raw, "ride_id").first()[0] == 2


def test_profiles_of_an_empty_month(spark):
    raw = raw_frame(spark, [])
    assert quality.quality_report(raw).first().total_records == 0
    assert quality.cleaning_counts(raw).first().removed_duplicates == 0
    staged = cleaning.stage_trips(raw, RUN_TS)
    assert quality.data_summary(staged).first().avg_distance_km is None
    facts = star.fact_rides(staged, RUN_TS)
    assert reports.database_stats(facts).count() == 4
    assert reports.member_distance_kpi(facts).count() == 0


def test_upper_bound_bands(spark):
    minutes = column(spark, [5.0, 5.01, 15.0, 30.0, 60.0, 60.01], "double")
    words = [r[0] for r in minutes.select(bands.duration_band(F.col("x"))).collect()]
    assert words == ["very_short", "short", "short", "medium", "long", "very_long"]


def test_day_parts(spark):
    hours = column(spark, [5, 6, 11, 12, 17, 18, 21, 22], "int")
    words = [r[0] for r in hours.select(bands.day_part(F.col("x"))).collect()]
    expected = "night morning morning afternoon afternoon evening evening night"
    assert words == expected.split()


def test_second_band_set(spark):
    hours = column(spark, [5, 6, 22, 23, 0], "int")
    words = [r[0] for r in hours.select(bands.hour_band(F.col("x"), S.DASHBOARD_DAY_PARTS)).collect()]
    assert words == ["NIGHT", "MORNING", "EVENING", "NIGHT", "NIGHT"]
    km = column(spark, [0.0, 1.0, 4.99, 5.0, 15.0, -1.0], "double")
    words = [
        r[0]
        for r in km.select(bands.range_band(F.col("x"), S.DASHBOARD_DISTANCE_BANDS)).collect()
    ]
    assert words == ["SHORT", "MEDIUM", "MEDIUM", "LONG", "VERY_LONG", None]


def test_rank_ignores_case_and_unknown_words_sort_last(spark):
    words = column(spark, ["LONG", "very_short", "other"], "string")
    ranks = [r[0] for r in words.select(bands.rank_of(F.col("x"), S.BAND_ORDER)).collect()]
    assert ranks == [4, 1, None]


def test_half_up_rounding(spark):
    values = column(spark, [Decimal("1.004"), Decimal("1.006")], "decimal(18,6)")
    assert values.agg(exact.mean(F.col("x"), 2)).first()[0] == Decimal("1.01")


def test_month_bounds(spark):
    first, last = periods.month_bounds("202402")
    row = spark.range(1).select(first.cast("string"), last.cast("string")).first()
    assert tuple(row) == ("2024-02-01", "2024-02-29")


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 97, 1000])
def test_percentiles_match_brute_force(spark, rows):
    rng = random.Random(rows)
    data = [
        (rng.choice(["a", "b", None]), Decimal(rng.randrange(0, 30_000_000)) / 1_000_000)
        for _ in range(rows)
    ]
    # a third of the rows share one group and one value
    data += [("hot", Decimal("2.500000"))] * rows
    df = spark.createDataFrame(data, "g string, v decimal(18,6)").repartition(5)
    wanted = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    found = {r.g: r for r in exact_percentiles(df, "g", "v", wanted, digits=4).collect()}
    groups = {}
    for g, v in data:
        groups.setdefault(g, []).append(v)
    assert set(found) == set(groups)
    for g, values in groups.items():
        values.sort()
        for name, p in wanted.items():
            position = Fraction(str(p)) * (len(values) - 1)
            low = int(position)
            high = min(low + 1, len(values) - 1)
            weight = position - low
            exactly = Fraction(values[low]) * (1 - weight) + Fraction(values[high]) * weight
            assert abs(Fraction(found[g][name]) - exactly) <= Fraction(1, 20_000)


def periods_frame(spark, rides):
    return spark.createDataFrame(
        [(i, n) for i, n in enumerate(rides)], "period int, total_rides bigint"
    )


@pytest.mark.parametrize(
    ("rides", "direction", "growth"),
    [
        ([], "Insufficient Data", 0),
        ([10], "Insufficient Data", 0),
        ([0, 0], "No Growth Data", 0),
        ([100, 110], "Growing", 10),
        ([100, 103], "Stable Growth", 3),
        ([100, 97], "Slight Decline", -3),
        ([100, 90], "Declining", -10),
        ([0, 100, 110], "Growing", 10),
    ],
)
def test_growth_trend(spark, rides, direction, growth):
    row = trends.growth_trend(periods_frame(spark, rides), "period").first()
    assert (row.direction, float(row.avg_growth), row.periods) == (direction, growth, len(rides))


def test_period_change(spark):
    assert trends.period_change(periods_frame(spark, [5]), "period").collect() == []
    row = trends.period_change(periods_frame(spark, [1, 50, 60]), "period").first()
    assert (row.change, float(row.change_pct)) == (10, 20.0)
    row = trends.period_change(periods_frame(spark, [0, 60]), "period").first()
    assert (row.change, float(row.change_pct)) == (60, 0.0)


@pytest.mark.parametrize("rides", [[], [1], [1, 2, 3]])
def test_no_trend_line_for_few_periods(spark, rides):
    assert trends.trend_line(periods_frame(spark, rides), "period").count() == 0


def test_trend_line(spark):
    fitted = trends.trend_line(periods_frame(spark, [1, 3, 5, 7]), "period").orderBy("period")
    assert [float(r.trend) for r in fitted.collect()] == [1, 3, 5, 7]


def test_mode_takes_lowest_of_ties_and_stations_ignore_null(spark):
    times = ["2024-04-10 09:00:00", "2024-04-10 07:00:00"]
    raw = raw_frame(
        spark,
        [
            trip_row(f"R{i}", started_at=t, ended_at=t[:13] + ":20:00", start_station_id=s)
            for i, (t, s) in enumerate(zip(times, ["A", None]))
        ],
    )
    facts = star.fact_rides(cleaning.stage_trips(raw, RUN_TS), RUN_TS)
    day = rollups.daily_metrics(facts).first()
    assert (day.peak_hour, day.total_rides, day.total_stations_used) == (7, 2, 1)


def test_pairs_not_in_follow_sql_nulls(spark):
    source = spark.createDataFrame(
        [("d1", "a"), ("d1", None), ("d2", "a"), ("d3", None), ("d4", "a"), ("d4", "b")],
        "d string, m string",
    )
    known = spark.createDataFrame([("d1", "b"), ("d2", None), ("d4", "a")], "kd string, km string")
    left = merge.not_in_pairs(source, known, ("d", "m"), ("kd", "km"))
    source.createOrReplaceTempView("s")
    known.createOrReplaceTempView("k")
    expected = spark.sql("SELECT * FROM s WHERE (d, m) NOT IN (SELECT kd, km FROM k)")
    assert rows_of(left) == rows_of(expected) == [("d1", "a"), ("d3", None), ("d4", "b")]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_station_survivor_and_totals(spark):
    raw = raw_frame(
        spark,
        [
            trip_row("R1", start_station_name="Zed"),
            trip_row("R2", start_station_name="Abe"),
            trip_row("R3", start_station_id=None, start_station_name=None),
        ],
    )
    stations = {r.station_id: r for r in star.dim_stations(cleaning.stage_trips(raw, RUN_TS)).collect()}
    assert set(stations) == {"A", "B"}
    assert stations["A"].station_name == "Abe"
    assert (stations["A"].total_departures, stations["A"].total_arrivals) == (2, 0)
    assert stations["A"].avg_arrival_duration is None
    assert (stations["B"].total_departures, stations["B"].total_arrivals) == (0, 3)


def test_pivot_finds_its_own_names(spark):
    report = spark.createDataFrame(
        [("short", "MEMBER", 2), ("short", "GUEST", 1), ("long", "MEMBER", 3)],
        "band string, rider string, rides bigint",
    )
    wide = reshape.pivot_counts(report, ["band"], "rider", "rides").orderBy("band")
    assert [r.asDict() for r in wide.collect()] == [
        {"band": "long", "GUEST": 0, "MEMBER": 3},
        {"band": "short", "GUEST": 1, "MEMBER": 2},
    ]


def test_a_coordinate_that_is_no_number_gives_no_distance(spark):
    nan = float("nan")
    raw = raw_frame(
        spark,
        [
            trip_row("ok"),
            trip_row("one", end_lat=nan),
            trip_row("same", start_lat=nan, end_lat=nan),
            trip_row("all", start_lat=nan, start_lng=nan, end_lat=nan, end_lng=nan),
        ],
    )
    assert {r.ride_id for r in cleaning.valid_trips(raw).collect()} == {"ok"}
    km = cleaning.with_measures(raw).select("ride_id", "trip_distance_km")
    assert {r.ride_id for r in km.filter("trip_distance_km IS NULL").collect()} == {"one", "same", "all"}


def test_a_known_station_name_comes_before_a_missing_one(spark):
    rows = [trip_row("R1"), trip_row("R2", start_station_name=None), trip_row("R3", end_station_id="C", end_station_name=None)]
    staged = cleaning.stage_trips(raw_frame(spark, rows), RUN_TS)
    names = {r.station_id: r.station_name for r in star.dim_stations(staged).collect()}
    assert names == {"A": "A street", "B": "B street", "C": None}
    facts = star.fact_rides(staged, RUN_TS)
    routes = reports.top_routes(facts, star.dim_stations(staged)).collect()
    assert [(r.route, r.ride_count) for r in routes] == [("A street → B street", 2), ("A street → C", 1)]
    none = star.dim_stations(staged).limit(0)
    assert [(r.station_id, r.station_name, r.total_rides) for r in reports.station_popularity(facts, none).collect()] == [("A", None, 3)]


def test_pivots_have_all_riders(spark):
    rows = [trip_row("R1"), trip_row("R2", member_casual="casual"), trip_row("R3", member_casual="robot")]
    facts = star.fact_rides(cleaning.stage_trips(raw_frame(spark, rows), RUN_TS), RUN_TS)
    pivot = reports.distance_category_pivot(facts)
    assert set(pivot.columns) == {"distance_category", "MEMBER", "CASUAL", "ROBOT"}
    assert sum(reports.kpi_pivot(reports.member_distance_kpi(facts)).agg(F.sum("ROBOT")).first()) == 1
