"""The monthly run: archive to raw zone, stage zone, star schema, rollups.

Each step reads what the one before wrote, so nothing is computed twice and a
step can be repeated on its own. Repeating a month leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S
from tripmart.operators import cleaning, merge, quality
from tripmart.plans import rollups, sketches, star, station_totals
from tripmart.sinks import tables, zone_writer
from tripmart.sources import zones
from tripmart.sources.archives import read_archives


@dataclass(frozen=True)
class Lake:
    """Where zones and mart tables live."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw_trips"

    @property
    def stage(self) -> str:
        return f"{self.root}/stage_trips"

    def table(self, name: str) -> str:
        return f"{self.root}/mart/{name}"


@dataclass
class MonthReport:
    """Row counts of a run, and the profiles as lazy frames."""

    raw_rows: int = 0
    staged_rows: int = 0
    deleted: dict[str, int] = field(default_factory=dict)
    quality: DataFrame | None = None
    cleaning: DataFrame | None = None
    summary: DataFrame | None = None
    distribution: DataFrame | None = None
    orphans: DataFrame | None = None


def ingest_month(
    spark: SparkSession, archives: str | list[str], lake: Lake, month: str, **options
) -> int:
    """Landed archives to the raw zone, as the batch of their month; replaces that batch, no other."""
    return zone_writer.write_batch(read_archives(spark, archives, month, **options), lake.raw, month)


def transform_month(
    spark: SparkSession, lake: Lake, run_ts: datetime, month: str | None = None
) -> int:
    """Raw zone to stage zone, batch by batch, for one month or all; returns the rows staged."""
    batches = [month] if month else zones.batches(spark, lake.raw)
    rows = 0
    for batch in batches:  # one for each month there is
        raw = zones.read_zone(spark, lake.raw, S.RAW_TRIPS, batch)
        rows += zone_writer.write_batch(cleaning.stage_trips(raw, run_ts), lake.stage, batch)
    return rows


#: Rollups that a month is deleted from: name, schema, date column.
ROLLUPS = (
    ("agg_user_behavior", S.AGG_USER_BEHAVIOR, "date_key"),
    ("agg_daily_metrics", S.AGG_DAILY_METRICS, "date_key"),
)
#: Sketches kept beside them, for questions over many dates.
SKETCHES = ("agg_sketches", S.AGG_SKETCHES, "date_key")


def clear_month(
    spark: SparkSession,
    lake: Lake,
    month: str,
    others: Sequence[tuple[str, T.StructType, str]] = (),
) -> dict[str, int]:
    """Delete a month from the mart: rollups, facts, then dates no fact needs.

    ``others`` are further unpartitioned tables with a date column, as (name, schema,
    date column), that are kept outside this package.
    """
    deleted = {}
    for name, schema, date_col in (*others, *ROLLUPS):
        deleted[name] = tables.delete_month(spark, lake.table(name), schema, date_col, month)
    tables.delete_month(spark, lake.table(SKETCHES[0]), *SKETCHES[1:], month)
    fact_path = lake.table("fact_rides")
    deleted["fact_rides"] = tables.delete_month(
        spark, fact_path, S.FACT_RIDES, "dt", month, partitioned=True
    )
    deleted["dim_time"] = tables.delete_unreferenced_month(
        spark,
        lake.table("dim_time"),
        S.TIME_MERGE,
        month,
        zones.read_table(spark, fact_path, S.FACT_RIDES, first_load=True),
        "dt",
    )
    return deleted


def count_month(spark: SparkSession, lake: Lake, month: str) -> dict[str, int]:
    """Rows that replacing a month deletes, as ``clear_month`` tells them."""
    counts = {}
    for name, schema, date_col in ROLLUPS:
        table = zones.read_table(spark, lake.table(name), schema, first_load=True)
        counts[name] = merge.month_rows(table, date_col, month).count()
    parts = zones.day_parts(spark, lake.table("fact_rides"))
    counts["fact_rides"] = sum(part.n_rows for day, part in parts.items() if f"{day:%Y%m}" == month)
    times = zones.read_table(spark, lake.table("dim_time"), S.DIM_TIME, first_load=True)
    counts["dim_time"] = merge.month_rows(times, "time_key", month).count()
    return counts


def station_rows(spark: SparkSession, lake: Lake, month: str | None) -> DataFrame:
    """Stations over all batches, after taking in the month's, or those not taken in yet."""
    parts_path = lake.table("station_parts")
    parts = zones.read_table(spark, parts_path, S.STATION_PARTS, first_load=True)
    known = station_totals.counted_loads(parts)
    for batch in zones.batches(spark, lake.stage):
        if batch == month or month is None or batch not in known:
            staged = zones.read_zone(spark, lake.stage, S.STAGED_TRIPS, batch)
            parts = station_totals.update_batch(spark, staged, batch, parts_path, lake.table("station_rides"))
    return station_totals.stations(parts)


def load_star(
    spark: SparkSession,
    lake: Lake,
    run_ts: datetime,
    month: str | None = None,
    data_source: str = "trip_archive",
    replacing: bool = False,
) -> set[date]:
    """Stage zone to star schema, dimensions before the facts that refer to them. Returns the dates whose facts changed.

    A month is a batch: the rides of its archive, on whatever dates. Station totals
    cover all batches; of a ride in several batches the latest counts. They are kept by
    batch, so a month's load reads no other month's stage zone. With ``replacing`` the
    facts of the month go in the same moment as the new ones come.
    """
    if month:
        chosen = zones.read_zone(spark, lake.stage, S.STAGED_TRIPS, month)
    else:
        whole = zones.read_zone(spark, lake.stage, S.STAGED_TRIPS, with_batch=True)
        chosen = cleaning.first_per_key(whole, "ride_id", [F.col("batch").desc()]).drop("batch")
    changed = set()
    for spec, rows in (
        (S.TIME_MERGE, star.dim_time(chosen)),
        (S.STATION_MERGE, station_rows(spark, lake, month)),
        (S.FACT_MERGE, star.fact_rides(chosen, run_ts, data_source)),
    ):
        changed |= tables.merge_table(spark, rows, lake.table(spec.table), spec, month if replacing else None)
    return changed


#: What is summed up by date from the facts: name, schema, how, dates that lack it, and how to sum up only those.
SUMMED = (
    ("agg_daily_metrics", S.AGG_DAILY_METRICS, rollups.daily_metrics, rollups.dates_without_metrics, rollups.new_daily_metrics),
    ("agg_user_behavior", S.AGG_USER_BEHAVIOR, rollups.user_behavior, rollups.dates_without_behavior, rollups.new_user_behavior),
    ("agg_sketches", S.AGG_SKETCHES, sketches.daily_sketches, rollups.dates_without_metrics, sketches.new_sketches),
)


def load_rollups(
    spark: SparkSession, lake: Lake, month: str | None = None, refresh: bool = False, days: set[date] | None = None
) -> None:
    """Add rollup rows of new dates; ``refresh`` recomputes dates already there.

    ``days`` are the dates that a merge has changed: they are recomputed, whichever month
    they are in, and no others. The dates to add are looked up first, so that the facts'
    other dates are not read. There is one per day, few enough to pass through the driver.
    """
    path = lake.table("fact_rides")
    if days is not None:
        _follow(spark, lake, days)
        return
    facts = zones.read_table(spark, path, S.FACT_RIDES, first_load=True)
    if month:  # the dates of the batch, which may lie outside the month
        staged = zones.read_zone(spark, lake.stage, S.STAGED_TRIPS, month)
        facts = facts.filter(F.col("dt").isin([row.dt for row in staged.select("dt").distinct().collect()]))
    for name, schema, complete, missing, fresh in SUMMED:
        path = lake.table(name)
        existing = zones.read_table(spark, path, schema, first_load=True)
        if refresh:
            dates = facts.select(F.col("dt").alias("date_key")).distinct()
            kept = existing.join(dates, "date_key", "left_anti")
            tables.replace_table(spark, kept.unionByName(complete(facts)), path)
            continue
        dates = [row.dt for row in missing(facts, existing).collect()]
        if dates:
            tables.append_rows(spark, fresh(facts.filter(F.col("dt").isin(dates)), existing), path, schema)


def _follow(spark: SparkSession, lake: Lake, days: set[date]) -> None:
    """Recompute the given dates; one without facts loses its rows."""
    if not days:
        return
    there = zones.day_parts(spark, lake.table("fact_rides"))
    facts = zones.read_days(spark, lake.table("fact_rides"), S.FACT_RIDES, [there[day] for day in sorted(days) if day in there])
    for name, schema, complete, *_ in SUMMED:
        existing = zones.read_table(spark, lake.table(name), schema, first_load=True)
        kept = existing.filter(~F.col("date_key").isin(sorted(days)))
        tables.replace_table(spark, kept.unionByName(complete(facts)), lake.table(name))


class MissingReferences(RuntimeError):
    """Facts refer to dimension rows that are not there."""


def check_references(spark: SparkSession, lake: Lake, month: str | None = None) -> DataFrame:
    """Facts without their dimension rows; empty after a sound load. A month checks the dates of its batch."""
    facts, times, stations = (
        zones.read_table(spark, lake.table(spec.table), spec.schema, first_load=True)
        for spec in (S.FACT_MERGE, S.TIME_MERGE, S.STATION_MERGE)
    )
    if month:
        staged = zones.read_zone(spark, lake.stage, S.STAGED_TRIPS, month)
        facts = facts.filter(F.col("dt").isin([row.dt for row in staged.select("dt").distinct().collect()]))
    return star.orphan_facts(facts, times, stations)


def require_references(orphans: DataFrame) -> None:
    """Raise if any fact lacks a dimension row."""
    rows = orphans.collect()  # one for each foreign key at most
    if rows:
        raise MissingReferences("; ".join(f"{r['reference']}: {r['orphan_rows']} rows" for r in rows))


def refresh_statistics(spark: SparkSession, lake: Lake) -> list[date]:
    """Statistics of all mart tables, for the optimizer of those who read them by name.

    Of the facts only dates that changed are scanned; they are returned. The others are
    small, and only those that have another version than before are.
    """
    names = [spec.table for spec in (S.TIME_MERGE, S.STATION_MERGE)] + [name for name, *_ in ROLLUPS]
    tables.refresh_statistics(spark, {f"mart_{name}": lake.table(name) for name in names})
    return tables.refresh_day_statistics(spark, "mart_fact_rides", lake.table("fact_rides"), S.FACT_RIDES)


def run_month(
    spark: SparkSession,
    archives: str | list[str],
    lake: Lake,
    month: str,
    run_ts: datetime,
    refresh: bool = False,
    statistics: bool = True,
    **ingest_options,
) -> MonthReport:
    """All steps for one ``yyyyMM`` month. Writes are verified, and missing references fail the run.

    The month's facts are replaced in one step: readers see the old month or the new one.
    """
    report = MonthReport(raw_rows=ingest_month(spark, archives, lake, month, **ingest_options))
    raw = zones.read_zone(spark, lake.raw, S.RAW_TRIPS, month)
    report.quality = quality.quality_report(raw)
    report.cleaning = quality.cleaning_counts(raw)
    report.staged_rows = transform_month(spark, lake, run_ts, month)
    staged = zones.read_zone(spark, lake.stage, S.STAGED_TRIPS, month)
    report.summary = quality.data_summary(staged)
    report.distribution = quality.category_distribution(staged)
    report.deleted = count_month(spark, lake, month)
    changed = load_star(spark, lake, run_ts, month, replacing=True)
    load_rollups(spark, lake, days=changed)
    if refresh:
        load_rollups(spark, lake, month, refresh=True)
    facts = zones.read_table(spark, lake.table("fact_rides"), S.FACT_RIDES, first_load=True)
    tables.delete_unreferenced_month(spark, lake.table("dim_time"), S.TIME_MERGE, month, facts, "dt")
    report.orphans = check_references(spark, lake, month)
    require_references(report.orphans)
    if statistics:
        refresh_statistics(spark, lake)
    return report
