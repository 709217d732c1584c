"""Station totals by batch, rollups of moved rides, and sketches, against what a whole computation gives."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import RUN_TS, raw_frame, rows_of, trip_row
from tripmart import schemas as S
from tripmart.operators import cleaning
from tripmart.plans import monthly, reports, rollups, sketches, star, station_totals
from tripmart.sinks import keys, tables, zone_writer
from tripmart.sources import zones


def month_rows(seed, month, n, shared=()):
    rng = random.Random(seed)
    names = [f"{month}-{k}" for k in range(n)] + list(shared)
    rows = []
    for name in names:
        day, a, b = rng.randint(1, 28), rng.randint(0, 4), rng.randint(0, 4)
        rows.append(
            trip_row(
                name, started_at=f"2024-{month}-{day:02d} 08:00:00", ended_at=f"2024-{month}-{day:02d} 08:{rng.randint(10, 50)}:00",
                start_station_id=None if a == 4 else f"S{a}", start_station_name=rng.choice(["x", "y", None]),
                end_station_id=f"S{b}", start_lat=41.8 + a / 100, end_lat=41.9 - b / 100, member_casual=rng.choice(["member", "casual"]),
            )
        )
    return rows


def put(spark, lake, month, rows):
    zone_writer.write_batch(raw_frame(spark, rows), lake.raw, f"2024{month}")
    monthly.transform_month(spark, lake, RUN_TS, f"2024{month}")


def whole(spark, lake):
    zone = zones.read_zone(spark, lake.stage, S.STAGED_TRIPS, with_batch=True)
    return rows_of(star.dim_stations(cleaning.first_per_key(zone, "ride_id", [F.col("batch").desc()]).drop("batch")))


def test_batches_in_any_order_and_again(spark, tmp_path):
    lake = monthly.Lake(str(tmp_path / "lake"))
    shared = ["both-1", "both-2", "both-3"]
    steps = [("04", shared), ("06", shared[:2]), ("05", shared[1:]), ("06", []), ("04", shared[:1]), ("06", shared)]
    for k, (month, rides) in enumerate(steps):
        put(spark, lake, month, month_rows(k, month, 12, rides))
        assert rows_of(monthly.station_rows(spark, lake, f"2024{month}")) == whole(spark, lake), k
    # loads that count, and the one just replaced
    assert len(keys.loads(spark, lake.table("station_rides"))) <= 4


def test_a_load_reads_no_other_stage_partition(spark, tmp_path):
    lake = monthly.Lake(str(tmp_path / "lake"))
    put(spark, lake, "04", month_rows(1, "04", 10, ["both"]))
    monthly.load_star(spark, lake, RUN_TS, "202404")
    put(spark, lake, "05", month_rows(2, "05", 10, ["both"]))
    expected = whole(spark, lake)
    for file in (tmp_path / "lake" / "stage_trips" / "batch=202404").rglob("*.parquet"):
        file.write_bytes(b"not to be read")
    monthly.load_star(spark, lake, RUN_TS, "202405")
    assert rows_of(zones.read_table(spark, lake.table("dim_stations"), S.DIM_STATIONS)) == expected


def test_a_run_that_died_leaves_sums_and_rides_as_they_were(spark, tmp_path, monkeypatch):
    lake = monthly.Lake(str(tmp_path / "lake"))
    put(spark, lake, "04", month_rows(1, "04", 10, ["both"]))
    put(spark, lake, "05", month_rows(2, "05", 10, ["both"]))
    monthly.station_rows(spark, lake, None)
    before = rows_of(zones.read_table(spark, lake.table("station_parts"), S.STATION_PARTS))
    put(spark, lake, "05", month_rows(3, "05", 10))

    def dies(*_):
        raise RuntimeError("died")

    monkeypatch.setattr(station_totals, "replace_table", dies)
    with pytest.raises(RuntimeError, match="died"):
        monthly.station_rows(spark, lake, "202405")
    monkeypatch.undo()
    assert rows_of(zones.read_table(spark, lake.table("station_parts"), S.STATION_PARTS)) == before
    assert rows_of(monthly.station_rows(spark, lake, "202405")) == whole(spark, lake)


def test_rollups_follow_rides_of_other_batches(spark, tmp_path):
    lake = monthly.Lake(str(tmp_path / "lake"))
    moved = lambda name, day: trip_row(name, started_at=f"{day} 08:00:00", ended_at=f"{day} 08:20:00")
    put(spark, lake, "04", [moved("R1", "2024-04-29"), moved("R2", "2024-04-30"), moved("R3", "2024-04-01")])
    monthly.load_rollups(spark, lake, days=monthly.load_star(spark, lake, RUN_TS, "202404"))
    # May's batch has a stray ride of April, and R2 on another date
    put(spark, lake, "05", [moved("R4", "2024-04-30"), moved("R2", "2024-05-02"), moved("R5", "2024-05-02")])
    changed = monthly.load_star(spark, lake, RUN_TS, "202405")
    assert changed == {date(2024, 4, 30), date(2024, 5, 2)}
    monthly.load_rollups(spark, lake, days=changed)
    facts = zones.read_table(spark, lake.table("fact_rides"), S.FACT_RIDES)
    for name, schema, complete, *_ in monthly.SUMMED[:2]:
        assert rows_of(zones.read_table(spark, lake.table(name), schema)) == rows_of(complete(facts))
    daily = {r.date_key: r.total_rides for r in zones.read_table(spark, lake.table("agg_daily_metrics"), S.AGG_DAILY_METRICS).collect()}
    assert daily == {date(2024, 4, 1): 1, date(2024, 4, 29): 1, date(2024, 4, 30): 1, date(2024, 5, 2): 2}
    # the only ride of a date leaves it
    put(spark, lake, "05", [moved("R3", "2024-05-03"), moved("R4", "2024-04-30"), moved("R2", "2024-05-02")])
    monthly.load_rollups(spark, lake, days=monthly.load_star(spark, lake, RUN_TS, "202405", replacing=True))
    facts = zones.read_table(spark, lake.table("fact_rides"), S.FACT_RIDES)
    assert rows_of(zones.read_table(spark, lake.table("agg_daily_metrics"), S.AGG_DAILY_METRICS)) == rows_of(rollups.daily_metrics(facts))


def test_sketches_of_a_range(spark):
    """Ranks and distinct counts are as near as is said, whatever dates are merged."""
    n = 60_000
    facts = spark.range(n).select(
        F.expr("date_add(DATE '2024-01-01', CAST(id % 90 AS INT))").alias("dt"), F.when(F.col("id") % 3 == 0, "CASUAL").otherwise("MEMBER").alias("member_casual"),
        F.when(F.col("id") % 50 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 1000).cast(S.MEASURE).alias("total_distance"),
        F.lit(10).cast(S.MEASURE).alias("ride_duration_minutes"),
        F.concat(F.lit("S"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(700)).cast("string")).alias("start_station_id"),
        F.concat(F.lit("S"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(300)).cast("string")).alias("end_station_id"),
    )
    kept = spark.createDataFrame(sketches.daily_sketches(facts).collect(), S.AGG_SKETCHES)
    first, last = date(2024, 1, 10), date(2024, 3, 10)
    found = {r.member_casual: r for r in sketches.range_kpi(kept, first, last).collect()}
    within = facts.filter(F.col("dt").between(F.lit(first), F.lit(last)))
    exact = {r.member_casual: r for r in reports.member_distance_kpi(within).collect()}
    assert set(found) == set(exact)
    for rider, row in found.items():
        for name in ("total_rides", "avg_distance_km", "total_distance_km", "avg_duration_minutes"):
            assert float(row[name]) == float(exact[rider][name]), name
        for name in ("unique_start_stations", "unique_end_stations"):
            assert abs(row[name] - exact[rider][name]) <= 2 * sketches.DISTINCT_ERROR * exact[rider][name]
        distances = sorted(float(r[0]) for r in within.filter((F.col("member_casual") == rider) & (F.col("total_distance") > 0)).select("total_distance").collect())
        for name, part in (("p25_distance_km", 0.25), ("median_distance_km", 0.5), ("p75_distance_km", 0.75)):
            below, upto = sum(x < row[name] for x in distances), sum(x <= row[name] for x in distances)
            assert below / len(distances) - sketches.RANK_ERROR <= part <= upto / len(distances) + sketches.RANK_ERROR
    plan = sketches.range_kpi(kept)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert sketches.range_kpi(kept.limit(0)).count() == 0
