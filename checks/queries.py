"""One registered query per operator, each over the whole ``events`` table."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S
from tripmart.fixtures import TRIPS_SQL
from tripmart.functions import bands, periods
from tripmart.operators import cleaning, merge, quality, trends
from tripmart.plans import monthly, reports, rollups, sketches, star, station_totals
from tripmart.sinks import tables, versions, zone_writer
from tripmart.sources import sql, zones

RUN_TS = datetime(2025, 7, 1)
AS_OF = date(2025, 6, 30)
MONTH = "202404"
QUARTER = 2
SPLIT = date(2025, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs -----------------------------------------------------------------


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = zones.with_compiled_steps(spark).read.parquet(f"{sf_dir}/events.parquet")
    return zones.with_load_date(sql.run_sql(spark, TRIPS_SQL, events=events))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.stage_trips(raw_trips(spark, sf_dir), RUN_TS)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_rides(staged(spark, sf_dir), RUN_TS)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_stations(staged(spark, sf_dir))


def _days_with_even_number(facts: DataFrame) -> DataFrame:
    return facts.filter(F.dayofmonth("dt") % 2 == 0)


def _old_facts(facts: DataFrame) -> DataFrame:
    number = F.expr("CAST(substr(ride_id, 2) AS BIGINT)")
    return facts.filter(number % 5 == 0).withColumns(
        {
            "total_distance": F.lit(0).cast(S.MEASURE),
            "data_source": F.lit("old"),
            "created_at": periods.run_stamp(datetime(2020, 1, 1)),
        }
    )


# --- queries that need more than one call -----------------------------------


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of this run; a session without a shared folder, as in tests, is given a local one."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tripmart-"))
    return zones.scratch_path(spark, f"{name}-{uuid4().hex}")


def computed_once(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The frame written to a folder of its own, for what several jobs read; without, each computes it anew."""
    new_folder(spark, "once")  # sees to a shared folder
    return versions.stage(spark, df)


def _raw_zone_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "raw-zone")
    zone_writer.write_batch(raw_trips(spark, sf_dir), path, MONTH)
    return zones.read_zone(spark, path, S.RAW_TRIPS)


def _raw_zone_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches that share dates and have rows without one; the first is landed again, cut down."""
    path, raw = new_folder(spark, "raw-zone"), raw_trips(spark, sf_dir)
    even = F.coalesce(F.expr("CAST(substr(ride_id, 2) AS BIGINT) % 2 = 0"), F.lit(False))
    zone_writer.write_batch(raw.filter(even), path, "202404")
    zone_writer.write_batch(raw.filter(~even), path, "202405")
    zone_writer.write_batch(raw.filter(even & (F.col("member_casual") == "member")), path, "202404")
    return zones.read_zone(spark, path, S.RAW_TRIPS, with_batch=True)


def _merged_twice(spark: SparkSession, name: str, target: DataFrame, source: DataFrame, spec) -> DataFrame:
    """A table after merging the target and, twice, the source, read back."""
    path = new_folder(spark, name)
    tables.merge_table(spark, target, path, spec)
    for _ in range(2):
        tables.merge_table(spark, source, path, spec)
    return zones.read_table(spark, path, spec.schema)


def _merge_table_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known rides, of which every third lay a day later before, and every seventh is not in the source."""
    now = computed_once(spark, facts(spark, sf_dir))
    number = F.expr("CAST(substr(ride_id, 2) AS BIGINT)")
    old = now.filter(number % 5 < 3).withColumns(
        {
            "dt": F.when(number % 3 == 0, F.date_add("dt", 1)).otherwise(F.col("dt")),
            "data_source": F.lit("old"),
            "created_at": periods.run_stamp(datetime(2020, 1, 1)),
        }
    )
    return _merged_twice(spark, "fact", old, now.filter(number % 7 != 0), S.FACT_MERGE)


def _merge_table_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = computed_once(spark, star.dim_time(staged(spark, sf_dir)))
    target = times.filter(F.col("day_of_month") <= 20).withColumn("season", F.lit("OLD"))
    return _merged_twice(spark, "time", target, times.filter(F.col("day_of_month") > 10), S.TIME_MERGE)


def _write_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "stage-zone")
    source = staged(spark, sf_dir)
    zone_writer.write_batch(source, path, MONTH)
    return zone_writer.verify_zone(source, zones.read_zone(spark, path, S.STAGED_TRIPS))


def _param_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql.run_sql(
        spark,
        """
        SELECT member_casual, count(*) AS rides, sum(total_distance) AS km
        FROM {facts}
        WHERE hour_of_day BETWEEN :first AND :last
        GROUP BY member_casual
        """,
        {"first": 7, "last": 9},
        facts=facts(spark, sf_dir),
    )


def _trip_columns(*names: str) -> Query:
    return lambda spark, sf_dir: staged(spark, sf_dir).select("ride_id", *names)


def _over_facts(report: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: report(facts(spark, sf_dir), **options)


def _kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report goes over the rides for routes and again for percentiles, so what it reads of them is computed once."""
    rides = facts(spark, sf_dir).select("member_casual", "start_station_id", "end_station_id", "total_distance", "ride_duration_minutes")
    return reports.member_distance_kpi(computed_once(spark, rides))


def _over_kpi(report: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: report(_kpi(spark, sf_dir), **options)


def _pivot_of_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of the pivot's columns are looked up in the report, which is computed once for both jobs."""
    return reports.kpi_pivot(computed_once(spark, _kpi(spark, sf_dir)))


def _over_months(report: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: report(
        reports.monthly_comparison(facts(spark, sf_dir)), "period"
    )


def _with_stations(report: Callable[..., DataFrame], **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        trips = staged(spark, sf_dir)
        return report(star.fact_rides(trips, RUN_TS), star.dim_stations(trips), **options)

    return query


def _custom_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).select(
        "ride_id",
        bands.range_band(F.col("total_distance"), S.DASHBOARD_DISTANCE_BANDS).alias(
            "distance_band"
        ),
        bands.range_band(F.col("ride_duration_minutes"), S.DASHBOARD_DURATION_BANDS).alias(
            "duration_band"
        ),
        bands.hour_band(F.col("hour_of_day"), S.DASHBOARD_DAY_PARTS).alias("day_part"),
    )


def _distance_of_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = cleaning.with_measures(raw_trips(spark, sf_dir))
    km = F.round(F.col("trip_distance_km").cast("decimal(18,6)"), 3)
    return measured.select("ride_id", "started_at", km.alias("trip_distance_km"))


def _duration_of_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = cleaning.with_measures(raw_trips(spark, sf_dir))
    minutes = F.col("trip_duration_minutes").cast(S.MEASURE).alias("trip_duration_minutes")
    return measured.select("ride_id", "started_at_ts", "ended_at_ts", minutes)


def _filter_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(spark, sf_dir)
    return cleaning.filter_required(raw).select(*S.REQUIRED_FIELDS)


def _filter_plausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.valid_trips(raw_trips(spark, sf_dir)).select(
        "ride_id", F.col("trip_duration_minutes").cast(S.MEASURE).alias("trip_duration_minutes")
    )


def _standardized(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        typed = cleaning.with_standard_types(raw_trips(spark, sf_dir))
        return typed.select("ride_id", "started_at", name, f"{name}_clean")

    return query


def _merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.removed_by_key(raw_trips(spark, sf_dir), "ride_id")


def _upsert_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = facts(spark, sf_dir)
    return merge.upsert(_old_facts(source), source, S.FACT_MERGE)


def _upsert_dim_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = staged(spark, sf_dir)
    target = star.dim_stations(trips.filter(F.col("dt") < F.lit(SPLIT)))
    source = star.dim_stations(trips.filter(F.col("dt") >= F.lit(SPLIT)))
    return merge.upsert(target, source, S.STATION_MERGE)


def _upsert_dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = star.dim_time(staged(spark, sf_dir))
    target = times.filter(F.col("day_of_month") <= 20).withColumn("season", F.lit("OLD"))
    return merge.upsert(target, times.filter(F.col("day_of_month") > 10), S.TIME_MERGE)


def _insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = star.dim_time(staged(spark, sf_dir))
    target = times.filter(F.col("day_of_month") % 2 == 0).withColumn("season", F.lit("OLD"))
    return merge.insert_if_absent(target, times, ["time_key"])


def _mart(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str]]:
    rides = facts(spark, sf_dir)
    return {
        "agg_user_behavior": (rollups.user_behavior(rides), "date_key"),
        "agg_daily_metrics": (rollups.daily_metrics(rides), "date_key"),
        "fact_rides": (rides, "dt"),
        "dim_time": (star.dim_time(rides), "time_key"),
    }


def _counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
    union = None
    for table, rows in tables.items():
        counted = rows.agg(F.count(F.lit(1)).alias(name)).select(
            F.lit(table).alias("table_name"), name
        )
        union = counted if union is None else union.unionByName(counted)
    return union


def _month_delete_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    doomed = {
        table: merge.month_rows(rows, date_col, MONTH)
        for table, (rows, date_col) in _mart(spark, sf_dir).items()
    }
    return _counts(doomed, "deleted")


def _month_delete_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = {
        table: merge.without_month(rows, date_col, MONTH)
        for table, (rows, date_col) in _mart(spark, sf_dir).items()
    }
    return _counts(left, "remaining")


def _guarded_dim_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = facts(spark, sf_dir)
    casual = rides.filter(F.col("member_casual") == S.CASUAL)
    return merge.guarded_delete(star.dim_time(rides), "time_key", MONTH, casual, "dt")


def _orphan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = staged(spark, sf_dir)
    rides = star.fact_rides(trips, RUN_TS)
    earlier = trips.filter(F.col("dt") < F.lit(date(2024, 3, 1)))
    known = star.dim_stations(earlier.filter(F.col("start_hour") < 12))
    return star.orphan_facts(rides, star.dim_time(earlier), known)


def _agg_daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = facts(spark, sf_dir)
    existing = _days_with_even_number(rides).select(F.col("dt").alias("date_key")).distinct()
    return rollups.new_daily_metrics(rides, existing)


def _agg_user_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing pairs: members on even days, and dates with an unknown rider type."""
    rides = facts(spark, sf_dir)
    even = _days_with_even_number(rides).filter(F.col("member_casual") == S.MEMBER)
    fifth = rides.filter(F.dayofmonth("dt") == 5)
    pairs = even.select("dt", "member_casual").unionByName(
        fifth.select("dt", F.lit(None).cast("string").alias("member_casual"))
    )
    existing = pairs.distinct().withColumnsRenamed(
        {"dt": "date_key", "member_casual": "member_type"}
    )
    return rollups.new_user_behavior(rides, existing)


def _lake(spark: SparkSession, name: str) -> monthly.Lake:
    return monthly.Lake(new_folder(spark, name))


def _valid_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.with_load_date(cleaning.valid_trips(raw_trips(spark, sf_dir)).select(*S.TRIP_COLUMNS.fieldNames()))


def _with_batches(trips: DataFrame) -> DataFrame:
    """Trips in three batches: two by their number, and every seventh in the third as well, where it began a day later."""
    number = F.expr("CAST(substr(ride_id, 2) AS BIGINT)")
    first = trips.withColumn("batch", F.when(number % 2 == 0, "202404").otherwise("202406"))
    later = {x: F.date_format(F.to_timestamp(x) + F.expr("INTERVAL '1' DAY"), "yyyy-MM-dd HH:mm:ss") for x in ("started_at", "ended_at")}
    return first.unionByName(zones.with_load_date(trips.filter(number % 7 == 0).withColumns(later)).withColumn("batch", F.lit("202405")))


def _station_totals_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station totals after three batches that share rides, the last loaded first and one of them again, cut down before."""
    folder, trips = new_folder(spark, "totals"), _with_batches(computed_once(spark, _valid_raw(spark, sf_dir)))
    cut = trips.filter((F.col("batch") == "202405") & (F.col("member_casual") == "member"))
    for batch, rows in (("202406", trips), ("202405", cut), ("202404", trips), ("202405", trips)):
        staged_rows = cleaning.stage_trips(rows.filter(F.col("batch") == batch).drop("batch"), RUN_TS)
        parts = station_totals.update_batch(spark, staged_rows, batch, f"{folder}/parts", f"{folder}/rides")
    return station_totals.stations(parts)


def _rollups_by_change(name: str) -> Query:
    """A rollup after two loads that share dates, of which the second moves rides of the first to other dates."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake, trips = _lake(spark, "rollups"), _with_batches(computed_once(spark, _valid_raw(spark, sf_dir)))
        for batch in ("202404", "202405"):
            staged_rows = cleaning.stage_trips(trips.filter(F.col("batch") == batch).drop("batch"), RUN_TS)
            facts_of = star.fact_rides(staged_rows, RUN_TS)
            changed = tables.merge_table(spark, facts_of, lake.table("fact_rides"), S.FACT_MERGE)
            monthly.load_rollups(spark, lake, days=changed)
        return zones.read_table(spark, lake.table(name), dict(x[:2] for x in monthly.SUMMED)[name])

    return query


def _sketch_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs of 2024 from sketches by date: the exact columns, and whether the others are as near as is said."""
    first, last = date(2024, 1, 1), date(2024, 12, 31)
    rides = facts(spark, sf_dir)
    found = sketches.range_kpi(sketches.daily_sketches(rides), first, last).withColumnRenamed("member_casual", "rider")
    within = rides.filter(F.col("dt").between(F.lit(first), F.lit(last)) & (F.col("total_distance") > 0) & (F.col("ride_duration_minutes") > 0))
    # ranks of the estimates among all distances, each taken before and after its equals
    parts = {"p25_distance_km": 0.25, "median_distance_km": 0.5, "p75_distance_km": 0.75}
    km = F.round(F.col("total_distance").cast("double"), 3)
    ranked = within.join(found, F.col("member_casual") == F.col("rider")).groupBy("member_casual").agg(
        *(F.avg((km < F.col(x)).cast("int")).alias(f"{x}_below") for x in parts), *(F.avg((km <= F.col(x)).cast("int")).alias(f"{x}_upto") for x in parts),
        F.countDistinct("start_station_id").alias("starts"), F.countDistinct("end_station_id").alias("ends"),
    )
    near = F.lit(True)
    for x, part in parts.items():
        near = near & (F.col(f"{x}_below") <= part + sketches.RANK_ERROR) & (F.col(f"{x}_upto") >= part - sketches.RANK_ERROR)
    for x, exact_count in (("unique_start_stations", "starts"), ("unique_end_stations", "ends")):
        near = near & (F.abs(F.col(x) - F.col(exact_count)) <= 2 * sketches.DISTINCT_ERROR * F.col(exact_count))
    joined = found.join(ranked, F.col("rider") == F.col("member_casual"))
    return joined.select("member_casual", "total_rides", "avg_distance_km", "total_distance_km", "avg_duration_minutes", near.alias("as_near_as_said"))


QUERIES: dict[str, Query] = {
    # sources
    "raw_trips": raw_trips,
    "raw_zone_scan": _raw_zone_scan,
    "raw_zone_reload": _raw_zone_reload,
    "month_slice": lambda spark, sf_dir: zones.month_slice(raw_trips(spark, sf_dir), MONTH),
    "param_sql": _param_sql,
    # sinks and maintenance
    "write_verification": _write_verification,
    "merge_dedup": _merge_dedup,
    "merge_table_fact": _merge_table_fact,
    "merge_table_time": _merge_table_time,
    "station_totals_by_batch": _station_totals_by_batch,
    "daily_rollup_by_change": _rollups_by_change("agg_daily_metrics"),
    "behavior_rollup_by_change": _rollups_by_change("agg_user_behavior"),
    "sketch_kpi": _sketch_kpi,
    "upsert_fact": _upsert_fact,
    "upsert_dim_stations": _upsert_dim_stations,
    "upsert_dim_time": _upsert_dim_time,
    "insert_if_absent": _insert_if_absent,
    "month_delete_counts": _month_delete_counts,
    "month_delete_remaining": _month_delete_remaining,
    "guarded_dim_delete": _guarded_dim_delete,
    "orphan_facts": _orphan_facts,
    "fact_sample": _over_facts(star.fact_sample),
    # filters and columns
    "filter_required": _filter_required,
    "filter_plausible": _filter_plausible,
    "invalid_coordinates": lambda spark, sf_dir: quality.invalid_coordinates(
        raw_trips(spark, sf_dir)
    ).select("ride_id", "started_at", "end_lat", "end_lng"),
    "trip_duration": _duration_of_raw,
    "trip_distance": _distance_of_raw,
    "calendar_columns": _trip_columns(
        "start_date", "dt", "start_hour", "start_day_of_week", "start_month", "start_year"
    ),
    "standardize_rideable": _standardized("rideable_type"),
    "standardize_member": _standardized("member_casual"),
    "duration_bands": _trip_columns("trip_duration_category"),
    "distance_bands": _trip_columns("trip_distance_category"),
    "calendar_bands": _trip_columns("time_of_day", "day_type", "season"),
    "custom_bands": _custom_bands,
    # quality
    "quality_report": lambda spark, sf_dir: quality.quality_report(raw_trips(spark, sf_dir)),
    "cleaning_counts": lambda spark, sf_dir: quality.cleaning_counts(raw_trips(spark, sf_dir)),
    "data_summary": lambda spark, sf_dir: quality.data_summary(staged(spark, sf_dir)),
    "category_distribution": lambda spark, sf_dir: quality.category_distribution(
        staged(spark, sf_dir)
    ),
    # star schema and rollups
    "fact_rides": facts,
    "dim_time": lambda spark, sf_dir: star.dim_time(staged(spark, sf_dir)),
    "dim_stations": stations,
    "agg_daily_metrics": _over_facts(rollups.daily_metrics),
    "agg_user_behavior": _over_facts(rollups.user_behavior),
    "agg_daily_incremental": _agg_daily_incremental,
    "agg_user_incremental": _agg_user_incremental,
    # reports
    "member_distance_kpi": _kpi,
    "daily_trends": _over_facts(reports.daily_trends, as_of=AS_OF),
    "station_popularity": _with_stations(reports.station_popularity),
    "hourly_distribution": _over_facts(reports.hourly_distribution),
    "distance_category_analysis": _over_facts(reports.distance_category_analysis),
    "time_of_day_analysis": _over_facts(reports.time_of_day_analysis),
    "weekly_patterns": _over_facts(reports.weekly_patterns),
    "top_routes": _with_stations(reports.top_routes),
    "database_stats": _over_facts(reports.database_stats),
    "quarter_analysis": _over_facts(reports.quarter_analysis, quarter=QUARTER),
    "quarter_by_member": _over_facts(reports.quarter_by_member, quarter=QUARTER),
    "quarter_monthly_trend": _over_facts(reports.quarter_monthly_trend, quarter=QUARTER),
    "daily_comparison": _over_facts(reports.daily_comparison, as_of=AS_OF),
    "monthly_comparison": _over_facts(reports.monthly_comparison),
    "quarterly_comparison": _over_facts(reports.quarterly_comparison),
    "yearly_comparison": _over_facts(reports.yearly_comparison),
    "member_vs_casual": _over_kpi(reports.member_vs_casual),
    "member_insights": _over_kpi(reports.member_insights),
    "kpi_pivot": _pivot_of_kpi,
    "distance_category_pivot": _over_facts(reports.distance_category_pivot),
    # trends
    "period_change": _over_months(trends.period_change),
    "growth_rates": _over_months(trends.growth_rates),
    "growth_trend": _over_months(trends.growth_trend),
    "trend_line": _over_months(trends.trend_line),
}


def plain(df: DataFrame) -> DataFrame:
    """Types that both engines hand over alike: bigint, double, text, boolean."""
    kinds = {
        T.DecimalType: "double",
        T.IntegerType: "bigint",
        T.DateType: "string",
        T.TimestampType: "string",
    }
    return df.select(
        *(
            F.col(f.name).cast(kinds[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in kinds
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def registered() -> dict[str, Query]:
    def over_plain(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(spark, sf_dir))

    return {name: over_plain(query) for name, query in QUERIES.items()}
