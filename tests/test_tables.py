"""Writes: zones, merges, month deletes, archives, the monthly run."""

from __future__ import annotations

import random
import zipfile
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import functions as F

from tests.helpers import RUN_TS, raw_frame, rows_of, trip_row
from tripmart import jobs
from tripmart import schemas as S
from tripmart.operators import cleaning, merge
from tripmart.plans import monthly, star, views
from tripmart.sinks import days, keys, tables, zone_writer
from tripmart.sources import archives, jdbc, sql, zones

LATER = datetime(2025, 8, 1)


def staged_frame(spark, rows):
    return cleaning.stage_trips(raw_frame(spark, rows), RUN_TS)


def fact_frame(spark, rows, run_ts=RUN_TS, source="trip_archive"):
    return star.fact_rides(staged_frame(spark, rows), run_ts, source)


def moved(ride_id, day, **changes):
    return trip_row(
        ride_id, started_at=f"{day} 08:00:00", ended_at=f"{day} 08:20:00", **changes
    )


def read_facts(spark, path):
    return zones.read_table(spark, path, S.FACT_RIDES)


def test_a_batch_replaces_itself_and_no_other(spark, tmp_path):
    path = str(tmp_path / "zone")
    april = raw_frame(spark, [moved("R1", "2024-04-01"), moved("R2", "2024-04-30"), trip_row("R3", started_at="bad")])
    may = raw_frame(spark, [moved("R4", "2024-04-30"), trip_row("R5", started_at=None)])
    assert zone_writer.write_batch(april, path, "202404") == 3
    assert zone_writer.write_batch(may, path, "202405") == 2
    assert zones.read_zone(spark, path, S.RAW_TRIPS).count() == 5
    again = raw_frame(spark, [moved("R2", "2024-04-30"), trip_row("R6", started_at="bad")])
    zone_writer.write_batch(again, path, "202404")
    zone = zones.read_zone(spark, path, S.RAW_TRIPS, with_batch=True)
    assert rows_of(zone.select("batch", "ride_id")) == [("202404", "R2"), ("202404", "R6"), ("202405", "R4"), ("202405", "R5")]
    read = zones.read_zone(spark, path, S.RAW_TRIPS, "202404")
    assert tuple(zone_writer.verify_zone(again, read).first()) == (2, 2, 2, True)
    assert not zone_writer.verify_zone(april, read).first().ok
    assert [r.dt for r in zone_writer.first_partitions(read).collect()] == [None, date(2024, 4, 30)]


def test_a_short_write_raises(spark, tmp_path):
    path = str(tmp_path / "zone")
    zone_writer.write_batch(raw_frame(spark, [moved("R1", "2024-04-01")]), path, "202404")
    with pytest.raises(zone_writer.WriteMismatch):
        zone_writer.verify_rows(spark, f"{path}/batch=202404", 2)


def test_batch_read_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "zone")
    for batch in ("202403", "202404"):
        zone_writer.write_batch(raw_frame(spark, [moved(f"R{batch}", "2024-03-31")]), path, batch)
    april = zones.read_zone(spark, path, S.RAW_TRIPS, "202404")
    assert [r.ride_id for r in april.collect()] == ["R202404"]
    plan = april._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_a_version_counts_when_it_is_whole(spark, tmp_path):
    path = str(tmp_path / "dim_time")
    march, april = (star.dim_time(staged_frame(spark, [moved("R", d)])) for d in ("2024-03-05", "2024-04-05"))
    tables.merge_table(spark, march, path, S.TIME_MERGE)
    # a run died while it wrote the next version
    april.write.parquet(zones.version_path(path, 2))
    (tmp_path / "dim_time" / "v=2" / "_SUCCESS").unlink()
    assert zones.read_table(spark, path, S.DIM_TIME).count() == 1
    tables.merge_table(spark, april, path, S.TIME_MERGE)
    assert rows_of(zones.read_table(spark, path, S.DIM_TIME).select("month")) == [(3,), (4,)]
    assert zones.versions(spark, path) == {1: True, 3: True}


def test_only_a_first_load_may_find_no_table(spark, tmp_path):
    path = str(tmp_path / "mistyped")
    with pytest.raises(AnalysisException):
        zones.read_table(spark, path, S.DIM_TIME)
    assert zones.read_table(spark, path, S.DIM_TIME, first_load=True).count() == 0


def test_merges_raise_on_what_they_cannot_hold(spark, tmp_path):
    path = str(tmp_path / "dim_stations")
    row = ("A", "a", 1.0, 2.0, 1, 1, None, None)
    good = spark.createDataFrame([row], S.DIM_STATIONS)
    with pytest.raises(Exception, match="total_departures cannot hold many"):
        tables.merge_table(spark, good.withColumn("total_departures", F.lit("many")), path, S.STATION_MERGE)
    with pytest.raises(ValueError, match="without station_id"):
        tables.merge_table(spark, spark.createDataFrame([row, (None, *row[1:])], S.DIM_STATIONS), path, S.STATION_MERGE)
    assert zones.versions(spark, path) == {}


def test_upsert_keeps_preserved_columns_and_other_rows(spark, tmp_path):
    path = str(tmp_path / "fact_rides")
    old = fact_frame(spark, [moved("R1", "2024-04-01"), moved("R2", "2024-04-01")], source="old")
    tables.merge_table(spark, old, path, S.FACT_MERGE)
    new = fact_frame(
        spark, [moved("R1", "2024-04-05", member_casual="casual"), moved("R3", "2024-04-01")], LATER
    )
    for _ in range(2):
        tables.merge_table(spark, new, path, S.FACT_MERGE)
        rows = {r.ride_id: r for r in read_facts(spark, path).collect()}
        assert set(rows) == {"R1", "R2", "R3"}
        assert rows["R1"].dt == date(2024, 4, 5)
        assert rows["R1"].member_casual == "CASUAL"
        assert (rows["R1"].data_source, rows["R1"].created_at) == ("old", RUN_TS)
        assert rows["R1"].updated_at == LATER
        assert rows["R2"].updated_at == RUN_TS
        assert (rows["R3"].data_source, rows["R3"].created_at) == ("trip_archive", LATER)
        assert read_facts(spark, path).count() == 3


def test_a_moved_ride_empties_its_old_partition(spark, tmp_path):
    path = str(tmp_path / "fact_rides")
    tables.merge_table(spark, fact_frame(spark, [moved("R1", "2024-04-01")]), path, S.FACT_MERGE)
    tables.merge_table(spark, fact_frame(spark, [moved("R1", "2024-04-02")]), path, S.FACT_MERGE)
    assert [r.dt for r in read_facts(spark, path).collect()] == [date(2024, 4, 2)]


class Died(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["add_load", "write_days", "commit", "replace_table", "remove_folders"])
def test_a_merge_that_dies_anywhere_shows_the_old_month_or_the_new(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "fact_rides")
    old = fact_frame(spark, [moved("R1", "2024-04-01"), moved("R2", "2024-04-02"), moved("R9", "2024-03-01")], source="old")
    new = fact_frame(spark, [moved("R1", "2024-04-02"), moved("R3", "2024-04-03")], LATER)
    tables.merge_table(spark, old, path, S.FACT_MERGE)
    tables.merge_table(spark, old, path, S.FACT_MERGE)  # a version before, to be removed
    state = lambda: sorted((r.ride_id, r.dt.isoformat(), r.data_source) for r in read_facts(spark, path).collect())
    before = state()
    open_reader = read_facts(spark, path)
    after = [("R1", "2024-04-02", "trip_archive"), ("R3", "2024-04-03", "trip_archive"), ("R9", "2024-03-01", "old")]
    where = {"add_load": tables.keys, "write_days": tables.dated, "commit": tables.dated, "replace_table": days, "remove_folders": days}[step]
    called = getattr(where, step)

    def dies(*args, **options):
        if step in ("add_load", "write_days"):
            called(*args, **options)  # it was done, and nothing after it
        raise Died

    monkeypatch.setattr(where, step, dies)
    with pytest.raises(Died):
        tables.merge_table(spark, new, path, S.FACT_MERGE, replacing="202404")
    monkeypatch.undo()
    assert state() == (after if step == "remove_folders" else before)
    assert sorted(r.ride_id for r in open_reader.collect()) == ["R1", "R2", "R9"]
    tables.merge_table(spark, new, path, S.FACT_MERGE, replacing="202404")
    assert state() == after


def test_merge_takes_one_row_per_key(spark, tmp_path):
    path = str(tmp_path / "dim_stations")
    stations = star.dim_stations(staged_frame(spark, [trip_row()]))
    twice = stations.unionByName(stations.withColumn("station_name", F.lit("Zzz")))
    tables.merge_table(spark, twice, path, S.STATION_MERGE)
    names = zones.read_table(spark, path, S.DIM_STATIONS).select("station_id", "station_name")
    assert rows_of(names) == [("A", "A street"), ("B", "B street")]
    assert cleaning.removed_by_key(twice, "station_id").first().removed == 2


def test_insert_if_absent_leaves_known_rows(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    both = merge.insert_if_absent(target, source.union(source).union(spark.createDataFrame([(2, "newer")], source.schema)), ["k"])
    assert rows_of(both) == [(1, "old"), (2, "new")]


def test_month_delete_of_any_dated_table(spark, tmp_path):
    path = str(tmp_path / "station_metrics")
    rows = [(date(2024, 3, 31), 1), (date(2024, 4, 1), 2), (date(2024, 4, 30), 3), (None, 4)]
    frame = spark.createDataFrame(rows, "date_key date, rides int")
    tables.replace_table(spark, frame, path)
    assert tables.delete_month(spark, path, frame.schema, "date_key", "202404") == 2
    assert tables.delete_month(spark, path, frame.schema, "date_key", "202404") == 0
    left = zones.read_table(spark, path, frame.schema)
    assert sorted(r.rides for r in left.collect()) == [1, 4]


def test_month_delete_before_the_first_load(spark, tmp_path):
    path = str(tmp_path / "nothing")
    assert tables.delete_month(spark, path, S.FACT_RIDES, "dt", "202404", partitioned=True) == 0


def test_guarded_delete_keeps_referenced_dates(spark):
    days = [date(2024, 4, 1), date(2024, 4, 2), date(2024, 5, 1)]
    dimension = spark.createDataFrame([(d,) for d in days], "time_key date")
    facts = spark.createDataFrame([(days[1],)], "dt date")
    left = merge.guarded_delete(dimension, "time_key", "202404", facts, "dt")
    assert sorted(r.time_key for r in left.collect()) == days[1:]


def write_archive(path, member, rows):
    names = S.TRIP_COLUMNS.fieldNames()
    lines = [",".join(names)]
    lines += [",".join("" if v is None else str(v) for v in row) for row in rows]
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("__MACOSX/readme.txt", "x")
        archive.writestr(member, "\n".join(lines) + "\n")


def test_archive_rows(spark, tmp_path):
    path = tmp_path / "202404.zip"
    rows = [
        moved("R1", "2024-04-01"),
        trip_row("R2", start_station_id=None, end_lat=None),
        trip_row("NA", started_at="bad"),
    ]
    write_archive(path, "202404-city-tripdata.csv", rows)
    trips = archives.read_archives(spark, str(path), "202404")
    assert trips.schema.fieldNames() == S.RAW_TRIPS.fieldNames()
    found = {r.ride_id: r for r in trips.collect()}
    assert set(found) == {"R1", "R2", "NA"}
    assert found["R1"].dt == date(2024, 4, 1)
    assert found["R2"].start_station_id is None
    assert found["R2"].end_lat is None
    assert found["NA"].dt is None


def test_archive_without_the_month_fails(spark, tmp_path):
    path = tmp_path / "202404.zip"
    write_archive(path, "202403-city-tripdata.csv", [trip_row()])
    with pytest.raises(PythonException, match="no 202404"):
        archives.read_archives(spark, str(path), "202404").count()


def test_archive_without_a_column_fails(spark, tmp_path):
    path = tmp_path / "202404.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("202404-city-tripdata.csv", "ride_id,started_at\nR1,2024-04-01 08:00:00\n")
    with pytest.raises(ValueError, match="no column rideable_type"):
        archives.read_archives(spark, str(path), "202404")


def test_archives_of_several_layouts(spark, tmp_path):
    names = S.TRIP_COLUMNS.fieldNames()
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("__MACOSX/202404-city-tripdata.csv", "junk")
        row = [str(x) for x in trip_row("R1")]
        row[names.index("start_station_name")] = '"A ""big""\nstreet, north"'
        row[names.index("end_station_name")] = '""'
        archive.writestr("202404-city-tripdata.csv", ",".join(names) + "\r\n" + ",".join(row) + "\r\n")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as archive:
        row = [str(x) for x in trip_row("R2")][::-1]
        archive.writestr("in/202404-city-tripdata.csv", "\ufeff" + ",".join(names[::-1]) + ",more\n" + ",".join(row) + ",x\n")
    trips = archives.read_archives(spark, [str(tmp_path / "a.zip"), str(tmp_path / "b.zip")], "202404")
    found = {r.ride_id: r for r in trips.collect()}
    assert found["R1"].start_station_name == 'A "big"\nstreet, north' and found["R1"].end_station_name is None
    assert found["R2"].start_lat == 41.8 and found["R2"].dt == date(2024, 4, 10)
    plan = trips._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "Python" not in plan and "MapInArrow" not in plan


def test_missing_references_fail(spark, tmp_path):
    lake = monthly.Lake(str(tmp_path / "lake"))
    tables.merge_table(spark, fact_frame(spark, [moved("R1", "2024-04-01")]), lake.table("fact_rides"), S.FACT_MERGE)
    with pytest.raises(monthly.MissingReferences, match="dt: 1 rows"):
        monthly.require_references(monthly.check_references(spark, lake))


def test_undated_rows_are_profiled_and_strays_loaded(spark, tmp_path):
    lake = monthly.Lake(str(tmp_path / "lake"))
    rows = [moved("R1", "2024-04-30"), moved("R2", "2024-05-01"), trip_row("R3", started_at="bad"), trip_row("R4", started_at=None)]
    write_archive(tmp_path / "202405.zip", "202405-city-tripdata.csv", rows)
    report = monthly.run_month(spark, str(tmp_path / "202405.zip"), lake, "202405", RUN_TS, statistics=False)
    profile = report.quality.first()
    assert (profile.total_records, profile.null_started_at, profile.unparsable_started_at) == (4, 1, 1)
    assert sorted(r.dt for r in read_facts(spark, lake.table("fact_rides")).collect()) == [date(2024, 4, 30), date(2024, 5, 1)]
    assert zones.read_table(spark, lake.table("agg_daily_metrics"), S.AGG_DAILY_METRICS).count() == 2


def mart_rows(spark, lake):
    return {
        name: rows_of(zones.read_table(spark, lake.table(name), schema))
        for name, schema in (
            ("dim_time", S.DIM_TIME),
            ("dim_stations", S.DIM_STATIONS),
            ("fact_rides", S.FACT_RIDES),
            ("agg_daily_metrics", S.AGG_DAILY_METRICS),
            ("agg_user_behavior", S.AGG_USER_BEHAVIOR),
        )
    }


def test_monthly_run_and_reload(spark, tmp_path):
    lake = monthly.Lake(str(tmp_path / "lake"))
    for month, days in (("202403", ["2024-03-05"]), ("202404", ["2024-04-01", "2024-04-02"])):
        rows = [moved(f"R{d}-{i}", d) for d in days for i in range(3)]
        rows += rows[:1] + [moved(None, days[0]), moved(f"S{month}", days[0], end_lat=50.0)]
        write_archive(tmp_path / f"{month}.zip", f"{month}-city-tripdata.csv", rows)

    reports = {}
    for month in ("202403", "202404"):
        reports[month] = monthly.run_month(
            spark, str(tmp_path / f"{month}.zip"), lake, month, RUN_TS
        )
    april = reports["202404"]
    assert (april.raw_rows, april.staged_rows) == (9, 6)
    assert april.cleaning.first().removed_implausible == 1
    assert april.quality.first().duplicate_ride_ids == 1
    assert april.summary.first().unique_rides == 6
    assert april.orphans.count() == 0
    assert april.deleted["fact_rides"] == 0
    before = mart_rows(spark, lake)
    assert {name: len(rows) for name, rows in before.items()} == {
        "dim_time": 3,
        "dim_stations": 2,
        "fact_rides": 9,
        "agg_daily_metrics": 3,
        "agg_user_behavior": 3,
    }
    views.register_views(spark, lake)
    popular = sql.run_sql(
        spark,
        "SELECT station_id, total_rides FROM v_station_popularity WHERE total_rides > :n",
        {"n": 5},
    )
    assert rows_of(popular) == [("A", 9)]
    assert spark.table("v_daily_trends").count() == 3
    assert spark.table("v_member_distance_kpi").first().total_rides == 9

    again = monthly.run_month(spark, str(tmp_path / "202404.zip"), lake, "202404", RUN_TS)
    assert again.deleted == {
        "agg_user_behavior": 2,
        "agg_daily_metrics": 2,
        "fact_rides": 6,
        "dim_time": 2,
    }
    assert mart_rows(spark, lake) == before


def test_rollups_of_late_rides(spark, tmp_path):
    lake = monthly.Lake(str(tmp_path / "lake"))
    path, agg = lake.table("fact_rides"), lake.table("agg_daily_metrics")
    tables.merge_table(spark, fact_frame(spark, [moved("R1", "2024-04-01")]), path, S.FACT_MERGE)
    monthly.load_rollups(spark, lake)
    tables.merge_table(spark, fact_frame(spark, [moved("R2", "2024-04-01")]), path, S.FACT_MERGE)
    monthly.load_rollups(spark, lake)
    daily = lambda: zones.read_table(spark, agg, S.AGG_DAILY_METRICS).collect()
    assert [r.total_rides for r in daily()] == [1]
    monthly.load_rollups(spark, lake, refresh=True)
    assert [r.total_rides for r in daily()] == [2]


def scanned_rows(spark, name):
    described = spark.sql(f"DESCRIBE EXTENDED {name}").collect()
    return next(r.data_type for r in described if r.col_name == "Statistics")


def test_statistics_of_unpartitioned_tables(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim_time")
    tables.merge_table(spark, star.dim_time(staged_frame(spark, [moved("R1", "2024-04-01"), moved("R2", "2024-04-02")])), path, S.TIME_MERGE)
    tables.refresh_statistics(spark, {"time_statistics": path})
    assert "2 rows" in scanned_rows(spark, "time_statistics")
    tables.merge_table(spark, star.dim_time(staged_frame(spark, [moved("R3", "2024-04-03")])), path, S.TIME_MERGE)
    tables.refresh_statistics(spark, {"time_statistics": path})
    assert "3 rows" in scanned_rows(spark, "time_statistics")


def test_statistics_of_changed_dates_only(spark, tmp_path):
    path, name = str(tmp_path / "fact_rides"), "day_statistics"
    tables.merge_table(spark, fact_frame(spark, [moved("R1", "2024-03-01"), moved("R2", "2024-04-01"), moved("R3", "2024-04-02")]), path, S.FACT_MERGE)
    assert len(tables.refresh_day_statistics(spark, name, path, S.FACT_RIDES)) == 3
    rows = lambda day: next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name} PARTITION (dt = DATE '{day}')").collect() if r.col_name == "Partition Statistics")
    assert "1 rows" in rows("2024-04-01")
    tables.merge_table(spark, fact_frame(spark, [moved("R4", "2024-04-01"), moved("R3", "2024-04-05")]), path, S.FACT_MERGE)
    # no date of another month, though it is in the table
    assert tables.refresh_day_statistics(spark, name, path, S.FACT_RIDES) == [date(2024, 4, 1), date(2024, 4, 5)]
    assert "2 rows" in rows("2024-04-01")
    assert spark.table(name).count() == 4 and "bytes" in scanned_rows(spark, name)
    assert tables.refresh_day_statistics(spark, name, path, S.FACT_RIDES) == []


def test_a_swapped_value_fails_the_load(spark, tmp_path, monkeypatch):
    """As many rows, the same values in each column, but two of them changed places."""
    path = str(tmp_path / "fact_rides")
    facts = fact_frame(spark, [moved("R1", "2024-04-01", start_station_id="A", end_station_id="B"), moved("R2", "2024-04-01", start_station_id="B", end_station_id="A")])
    write = days.write_observed

    def tampered(df, folder, partition, mode):
        contents = write(df, folder, partition, mode)
        swapped = spark.read.schema(df.schema).parquet(folder).withColumns({"start_station_id": F.col("end_station_id"), "end_station_id": F.col("start_station_id")}).select(df.columns)
        rows = [tuple(r) for r in swapped.collect()]
        write(spark.createDataFrame(rows, df.schema), folder, partition, mode)
        return contents

    monkeypatch.setattr(days, "write_observed", tampered)
    with pytest.raises(zone_writer.WriteMismatch, match="not the same ones"):
        tables.merge_table(spark, facts, path, S.FACT_MERGE)
    assert zones.read_table(spark, path, S.FACT_RIDES, first_load=True).count() == 0
    monkeypatch.undo()
    tables.merge_table(spark, facts, path, S.FACT_MERGE)
    days.require_sound(spark, path, S.FACT_RIDES)
    [part] = zones.day_parts(spark, path).values()
    folder = f"{path}/data/run={part.run}/dt={part.day}"
    rows = [tuple(r)[:-1] for r in read_facts(spark, path).select(*[c for c in S.FACT_RIDES.fieldNames() if c != "dt"], "dt").collect()]
    schema = S.T.StructType([x for x in S.FACT_RIDES if x.name != "dt"])
    changed = spark.createDataFrame(rows, schema).withColumn("start_station_id", F.lit("A"))
    changed.write.mode("overwrite").parquet(folder)
    with pytest.raises(zone_writer.WriteMismatch, match="2024-04-01"):
        days.require_sound(spark, path, S.FACT_RIDES)


def test_nulls_that_change_columns_are_seen(spark):
    schema = "a string, b string"
    one, other = (spark.createDataFrame(rows, schema) for rows in ([("x", None)], [(None, "x")]))
    assert one.agg(*zone_writer.contents_of(one.schema)).first() != other.agg(*zone_writer.contents_of(other.schema)).first()


def test_keys_are_looked_up_without_a_shuffle_of_what_is_stored(spark, tmp_path):
    path = str(tmp_path / "fact_rides")
    for month in ("2024-02", "2024-03"):
        tables.merge_table(spark, fact_frame(spark, [moved(f"R{month}{k}", f"{month}-0{k}") for k in range(1, 6)]), path, S.FACT_MERGE)
    source = fact_frame(spark, [moved("R2024-031", "2024-04-01")])
    before = {x: spark.conf.get(x) for x in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = keys.dates_of(spark, source, f"{path}/keys", tables.key_schema(S.FACT_MERGE), "ride_id", "dt")
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert [r.dt for r in found.collect()] == [date(2024, 3, 1)]
    stored = plan[plan.index("Join") : plan.index("tripmart_keys_")]
    assert "Exchange" not in stored and "Bucketed: true" in plan and plan.count("FileScan") == 1


def test_a_merge_reads_no_other_dates(spark, tmp_path):
    """Other dates' files may even be gone."""
    path = tmp_path / "fact_rides"
    tables.merge_table(spark, fact_frame(spark, [moved("R1", "2024-03-01"), moved("R2", "2024-04-01")]), str(path), S.FACT_MERGE)
    march = zones.day_parts(spark, str(path))[date(2024, 3, 1)]
    hidden = path / "data" / f"run={march.run}" / "dt=2024-03-01"
    hidden.rename(tmp_path / "away")
    changed = tables.merge_table(spark, fact_frame(spark, [moved("R2", "2024-04-02"), moved("R3", "2024-04-01")]), str(path), S.FACT_MERGE)
    assert changed == {date(2024, 4, 1), date(2024, 4, 2)}
    (tmp_path / "away").rename(hidden)
    assert sorted((r.ride_id, r.dt.day) for r in read_facts(spark, str(path)).collect()) == [("R1", 1), ("R2", 2), ("R3", 1)]


def test_keys_are_merged_after_some_loads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "MOST_LOADS", 2)
    path = str(tmp_path / "fact_rides")
    for day in (1, 2, 3, 4):
        tables.merge_table(spark, fact_frame(spark, [moved("R1", f"2024-04-0{day}"), moved(f"S{day}", f"2024-04-0{day}")]), path, S.FACT_MERGE)
    assert len(keys.loads(spark, f"{path}/keys")) <= 2
    assert sorted((r.ride_id, r.dt.day) for r in read_facts(spark, path).collect()) == [("R1", 4), ("S1", 1), ("S2", 2), ("S3", 3), ("S4", 4)]


def test_merge_statement_casts_and_preserves():
    text = jdbc.merge_statement(S.FACT_MERGE, "mart.fact_rides", "mart.fact_rides_temp")
    assert "CAST(started_at AS TIMESTAMP)" in text
    assert "ON CONFLICT (ride_id) DO UPDATE SET" in text
    updates = text.split("DO UPDATE SET")[1]
    assert "created_at" not in updates
    assert "data_source" not in updates
    assert "updated_at = EXCLUDED.updated_at" in updates


def test_jdbc_write_options():
    assert jdbc.write_options() == {
        "numPartitions": "8",
        "batchsize": "20000",
        "isolationLevel": "NONE",
    }


def test_job_steps(spark, tmp_path, capsys):
    lake, archive = str(tmp_path / "lake"), str(tmp_path / "202404.zip")
    write_archive(archive, "202404-city-tripdata.csv", [trip_row("R1"), trip_row("R2")])
    common = ["--lake", lake, "--month", "202404"]
    for step in ("ingest", "profile", "transform", "clear", "load"):
        extra = ["--archives", archive] if step == "ingest" else []
        jobs.run(spark, jobs.parse([step, *common, *extra]))
    printed = capsys.readouterr().out
    assert "raw rows: 2" in printed
    assert "staged rows: 2" in printed
    assert len(mart_rows(spark, monthly.Lake(lake))["fact_rides"]) == 2
    with pytest.raises(SystemExit):
        jobs.parse(["ingest", "--lake", lake])


def test_a_hot_date_is_split_over_files(spark, tmp_path):
    path = str(tmp_path / "zone")
    rows = [moved(f"R{i}", "2024-04-01") for i in range(6000)]
    rows += [moved(f"S{i}", f"2024-05-{i:02d}") for i in range(1, 29)]
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "10k")
    try:
        frame = raw_frame(spark, rows).repartition(8)
        assert zone_writer.write_partitions(frame, path) == 6028
    finally:
        spark.conf.set(size, before)
    files = spark.read.parquet(path).select("dt", F.input_file_name().alias("f")).distinct()
    per_date = {r.dt: r.n for r in files.groupBy("dt").agg(F.count("f").alias("n")).collect()}
    assert per_date[date(2024, 4, 1)] > 1
    assert set(per_date.values()) - {per_date[date(2024, 4, 1)]} == {1}


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_against_a_dictionary(spark, seed):
    rng = random.Random(seed)

    def rows(n, tag):
        keys = rng.sample(range(60), n)
        return [(f"S{k}", f"{tag}{k}", 1.0, 2.0, k, k, None, None) for k in keys]

    old, new = rows(30, "old"), rows(40, "new")
    spec = replace(S.STATION_MERGE, preserved=("latitude", "total_arrivals"))
    new = [(k, name, 9.0, 9.0, 9, 9, None, None) for k, name, *_ in new]
    target, source = (spark.createDataFrame(r, S.DIM_STATIONS) for r in (old, new))
    expected = {row[0]: row for row in old}
    for row in new:
        kept = expected.get(row[0])
        expected[row[0]] = row if kept is None else (*row[:2], kept[2], *row[3:5], kept[5], *row[6:])
    merged = merge.upsert(target, source, spec)
    assert rows_of(merged) == sorted(expected.values(), key=repr)
    assert rows_of(merge.upsert(merged, source, spec)) == rows_of(merged)


def test_a_month_without_rides_changes_nothing(spark, tmp_path):
    lake = monthly.Lake(str(tmp_path / "lake"))
    zone_writer.write_batch(raw_frame(spark, [moved("R1", "2024-04-01")]), lake.raw, "202404")
    assert monthly.transform_month(spark, lake, RUN_TS, "202404") == 1
    assert monthly.transform_month(spark, lake, RUN_TS, "203001") == 0
    monthly.load_star(spark, lake, RUN_TS, "202404")
    monthly.load_rollups(spark, lake, "202404")
    before = mart_rows(spark, lake)
    assert monthly.clear_month(spark, lake, "203001") == dict.fromkeys(
        ("agg_user_behavior", "agg_daily_metrics", "fact_rides", "dim_time"), 0
    )
    monthly.load_star(spark, lake, RUN_TS, "203001")
    monthly.load_rollups(spark, lake, "203001")
    assert mart_rows(spark, lake) == before
