"""DuckDB SQL stating each registered query's rule on its own.

Measures are integers here (millionths of a kilometre or minute), so sums are
exact and every rounding is one integer division, half up.
"""

from __future__ import annotations

from tripmart.fixtures import TRIPS_CTES, TRIPS_QUERY

RUN_TS = "2025-07-01 00:00:00"
AS_OF = "DATE '2025-06-30'"
IN_MONTH = "BETWEEN DATE '2024-04-01' AND DATE '2024-04-30'"


def _rounded(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator in millionths, rounded half up, as a double."""
    unit = 10 ** (6 - digits)
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    half_up = f"(2 * {n} + {d} * {unit}) // (2 * {d} * {unit})"
    return f"CASE WHEN {denominator} > 0 THEN CAST({half_up} AS DOUBLE) / {10**digits}.0 END"


def _total(column: str, digits: int) -> str:
    return f"CASE WHEN COUNT({column}) > 0 THEN {_rounded(f'SUM({column})', '1', digits)} END"


def _mean(column: str, digits: int, where: str = "") -> str:
    only = f" FILTER (WHERE {where})" if where else ""
    return _rounded(f"SUM({column}){only}", f"COUNT({column}){only}", digits)


def _percent(part: str, whole: str, digits: int) -> str:
    """100 * part / whole rounded half away from zero; null unless whole > 0."""
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    size = f"(2 * abs({p}) * {100 * 10**digits} + {w}) // (2 * {w})"
    return f"CASE WHEN {whole} > 0 THEN sign({part}) * CAST({size} AS DOUBLE) / {10**digits}.0 END"


CTES = f"""
{TRIPS_CTES.format(events="events")},
raw AS (
  SELECT *, CAST(TRY_CAST(started_at AS TIMESTAMP) AS DATE) AS dt FROM ({TRIPS_QUERY})),
timed AS (
  SELECT *,
         TRY_CAST(started_at AS TIMESTAMP) AS ts0,
         TRY_CAST(ended_at AS TIMESTAMP) AS ts1,
         date_diff('second', TRY_CAST(started_at AS TIMESTAMP), TRY_CAST(ended_at AS TIMESTAMP)) AS secs,
         sin(radians(start_lat)) * sin(radians(end_lat))
           + cos(radians(start_lat)) * cos(radians(end_lat))
           * cos(radians(end_lng) - radians(start_lng)) AS cosine
  FROM raw),
measured AS (
  SELECT *, CASE WHEN isnan(start_lat + start_lng + end_lat + end_lng) THEN NULL
                 WHEN start_lat = end_lat AND start_lng = end_lng THEN 0
                 ELSE 6371 * acos(CASE WHEN cosine > 1 THEN 1 WHEN cosine < -1 THEN -1
                                       ELSE cosine END) END AS km
  FROM timed),
complete AS (
  SELECT * FROM measured
  WHERE ride_id IS NOT NULL AND started_at IS NOT NULL
    AND ended_at IS NOT NULL AND rideable_type IS NOT NULL),
valid AS (
  -- of the copies of a ride the first in the order of all fields, plausible ones before others
  SELECT * EXCLUDE (fit, place) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY ride_id ORDER BY fit DESC, rideable_type NULLS FIRST, started_at NULLS FIRST,
          ended_at NULLS FIRST, start_station_name NULLS FIRST, start_station_id NULLS FIRST,
          end_station_name NULLS FIRST, end_station_id NULLS FIRST, start_lat NULLS FIRST, start_lng NULLS FIRST,
          end_lat NULLS FIRST, end_lng NULLS FIRST, member_casual NULLS FIRST) AS place
    FROM (SELECT *, coalesce(secs > 60 AND secs < 86400 AND km < 100, FALSE) AS fit FROM complete))
  WHERE fit AND place = 1),
staged AS (
  SELECT *,
         CAST(hour(ts0) AS BIGINT) AS h, CAST(dayofweek(ts0) + 1 AS BIGINT) AS dow,
         CAST(month(ts0) AS BIGINT) AS mon, CAST(year(ts0) AS BIGINT) AS yr,
         CASE WHEN secs <= 300 THEN 'very_short' WHEN secs <= 900 THEN 'short'
              WHEN secs <= 1800 THEN 'medium' WHEN secs <= 3600 THEN 'long'
              ELSE 'very_long' END AS duration_category,
         CASE WHEN km <= 1 THEN 'very_short' WHEN km <= 3 THEN 'short'
              WHEN km <= 5 THEN 'medium' WHEN km <= 10 THEN 'long'
              ELSE 'very_long' END AS distance_category,
         CASE WHEN hour(ts0) >= 6 AND hour(ts0) < 12 THEN 'morning'
              WHEN hour(ts0) >= 12 AND hour(ts0) < 18 THEN 'afternoon'
              WHEN hour(ts0) >= 18 AND hour(ts0) < 22 THEN 'evening'
              ELSE 'night' END AS time_of_day,
         CASE WHEN dayofweek(ts0) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type,
         CASE WHEN month(ts0) IN (3, 4, 5) THEN 'spring' WHEN month(ts0) IN (6, 7, 8) THEN 'summer'
              WHEN month(ts0) IN (9, 10, 11) THEN 'fall' ELSE 'winter' END AS season,
         CASE rideable_type WHEN 'electric_bike' THEN rideable_type WHEN 'classic_bike' THEN rideable_type
              WHEN 'docked_bike' THEN rideable_type ELSE 'unknown' END AS rideable_type_clean,
         CASE member_casual WHEN 'member' THEN 'member' WHEN 'casual' THEN 'casual'
              ELSE 'unknown' END AS member_casual_clean,
         (secs * 2000000 + 60) // 120 AS min_u,
         (secs * 2000000 + 3600) // 7200 AS hour_u,
         CAST(ROUND(km * 1000000) AS BIGINT) AS km_u
  FROM valid),
fact AS (
  SELECT *, upper(member_casual) AS rider FROM staged),
positive AS (
  SELECT * FROM fact WHERE km_u > 0 AND min_u > 0),
ends AS (
  SELECT start_station_id AS id, start_station_name AS name, start_lat AS lat, start_lng AS lng,
         1 AS departed, min_u, dt FROM staged
  UNION ALL
  SELECT end_station_id, end_station_name, end_lat, end_lng, 0, min_u, dt FROM staged),
months AS (
  SELECT date_trunc('month', dt) AS m, COUNT(*) AS rides FROM fact GROUP BY 1),
steps AS (
  SELECT m, rides, lag(rides) OVER (ORDER BY m) AS before,
         row_number() OVER (ORDER BY m) - 1 AS x, COUNT(*) OVER () AS n FROM months),
monthly AS (
  SELECT strftime(date_trunc('month', dt), '%Y-%m-%d') AS period, strftime(dt, '%Y-%m') AS period_label,
         COUNT(*) AS total_rides, {_total("km_u", 2)} AS total_distance
  FROM fact GROUP BY 1, 2),
ordered AS (
  SELECT rider, km_u, row_number() OVER (PARTITION BY rider ORDER BY km_u) - 1 AS i,
         COUNT(*) OVER (PARTITION BY rider) - 1 AS last FROM positive),
quarters AS (
  -- four times the interpolated value at position last * k / 4
  SELECT rider, k,
         SUM(CASE WHEN i = (last * k) // 4 THEN km_u * (4 - (last * k) % 4)
                  WHEN i = (last * k) // 4 + 1 THEN km_u * ((last * k) % 4) ELSE 0 END) AS four_u
  FROM ordered, (VALUES (1), (2), (3)) AS ks(k) GROUP BY rider, k),
kpi AS (
  SELECT rider AS member_casual, COUNT(*) AS total_rides,
         {_mean("km_u", 3)} AS avg_distance_km,
         {_total("km_u", 3)} AS total_distance_km,
         {_mean("min_u", 2)} AS avg_duration_minutes,
         COUNT(DISTINCT start_station_id) AS unique_start_stations,
         COUNT(DISTINCT end_station_id) AS unique_end_stations,
         (SELECT {_rounded("max(four_u)", "4", 3)} FROM quarters q WHERE q.rider = p.rider AND k = 1) AS p25_distance_km,
         (SELECT {_rounded("max(four_u)", "4", 3)} FROM quarters q WHERE q.rider = p.rider AND k = 2) AS median_distance_km,
         (SELECT {_rounded("max(four_u)", "4", 3)} FROM quarters q WHERE q.rider = p.rider AND k = 3) AS p75_distance_km
  FROM positive p GROUP BY rider),
pair AS (
  SELECT m.member_casual AS rider, {", ".join(
    f"m.{c} AS m_{c}, c.{c} AS c_{c}"
    for c in ("avg_distance_km", "total_distance_km", "median_distance_km",
              "avg_duration_minutes", "unique_start_stations"))}
  FROM kpi m JOIN kpi c ON m.member_casual = 'MEMBER' AND c.member_casual = 'CASUAL')
"""


def _mode(column: str, keys: str, source: str = "fact") -> str:
    return f"""(
      SELECT {keys}, {column} AS top FROM (
        SELECT {keys}, {column}, row_number() OVER (
                 PARTITION BY {keys} ORDER BY COUNT(*) DESC, {column}) AS place
        FROM {source} GROUP BY {keys}, {column}) WHERE place = 1)"""


FACT_COLUMNS = f"""
  ride_id, CAST(ts0 AS VARCHAR) AS started_at, CAST(ts1 AS VARCHAR) AS ended_at,
  start_station_id, end_station_id, rider AS member_casual, rideable_type,
  min_u / 1000000.0 AS ride_duration_minutes, hour_u / 1000000.0 AS ride_duration_hours,
  {{distance}} AS total_distance,
  ((km_u * 7200 + secs) // (2 * secs)) / 1000000.0 AS avg_speed_kmh,
  distance_category, duration_category, time_of_day,
  h AS hour_of_day, dow AS day_of_week, mon AS month, yr AS year, CAST(dt AS VARCHAR) AS dt,
  {{created}} AS created_at, '{RUN_TS}' AS updated_at,
  {{origin}} AS data_source, '2025-07-01_000000' AS batch_id,
  TRUE AS is_valid, '2025-07-01' AS processing_date
"""


def _dim_time(season: str = "upper(season)", source: str = "staged") -> str:
    return f"""
    SELECT DISTINCT CAST(dt AS VARCHAR) AS time_key, CAST(year(dt) AS BIGINT) AS year,
           CAST(month(dt) AS BIGINT) AS month, CAST(day(dt) AS BIGINT) AS day_of_month,
           CAST(isodow(dt) % 7 + 1 AS BIGINT) AS day_of_week, CAST(week(dt) AS BIGINT) AS week_of_year,
           CAST(quarter(dt) AS BIGINT) AS quarter, isodow(dt) >= 6 AS is_weekend,
           {season} AS season
    FROM {source}"""


def _dim_stations(where: str = "TRUE") -> str:
    return f"""
    SELECT s.id AS station_id, s.name AS station_name, s.lat AS latitude, s.lng AS longitude,
           COALESCE(d.n, 0) AS total_departures, COALESCE(a.n, 0) AS total_arrivals,
           d.minutes AS avg_departure_duration, a.minutes AS avg_arrival_duration
    FROM (SELECT id, name, lat, lng,
                 row_number() OVER (PARTITION BY id ORDER BY name, lat, lng) AS place
          FROM (SELECT DISTINCT id, name, lat, lng FROM ends WHERE id IS NOT NULL AND {where})) s
    LEFT JOIN (SELECT id, COUNT(*) AS n, {_mean("min_u", 6)} AS minutes FROM ends
               WHERE departed = 1 AND {where} GROUP BY id) d ON d.id = s.id
    LEFT JOIN (SELECT id, COUNT(*) AS n, {_mean("min_u", 6)} AS minutes FROM ends
               WHERE departed = 0 AND {where} GROUP BY id) a ON a.id = s.id
    WHERE s.place = 1"""


def _daily(source: str = "fact") -> str:
    return f"""
    SELECT CAST(f.dt AS VARCHAR) AS date_key, f.total_rides, f.total_distance, f.avg_distance,
           f.avg_duration_minutes, f.member_rides, f.casual_rides, f.member_avg_distance,
           f.casual_avg_distance, p.top AS peak_hour, f.total_stations_used
    FROM (SELECT dt, COUNT(*) AS total_rides, {_total("km_u", 3)} AS total_distance,
                 {_mean("km_u", 3)} AS avg_distance, {_mean("min_u", 2)} AS avg_duration_minutes,
                 COUNT(*) FILTER (WHERE rider = 'MEMBER') AS member_rides,
                 COUNT(*) FILTER (WHERE rider = 'CASUAL') AS casual_rides,
                 {_mean("km_u", 3, "rider = 'MEMBER'")} AS member_avg_distance,
                 {_mean("km_u", 3, "rider = 'CASUAL'")} AS casual_avg_distance,
                 COUNT(DISTINCT start_station_id) AS total_stations_used
          FROM {source} GROUP BY dt) f
    JOIN {_mode("h", "dt", source)} p ON p.dt = f.dt"""


def _behavior(source: str = "fact") -> str:
    same = "{0}.dt = f.dt AND {0}.rider = f.rider"
    return f"""
    SELECT CAST(f.dt AS VARCHAR) AS date_key, f.rider AS member_type, f.total_rides, f.avg_distance,
           f.avg_duration_minutes, f.total_distance, t.top AS preferred_time_of_day,
           k.top AS preferred_distance_category, m.top AS preferred_duration_category,
           f.unique_stations_used
    FROM (SELECT dt, rider, COUNT(*) AS total_rides, {_mean("km_u", 6)} AS avg_distance,
                 {_mean("min_u", 6)} AS avg_duration_minutes, {_total("km_u", 6)} AS total_distance,
                 COUNT(DISTINCT start_station_id) AS unique_stations_used
          FROM {source} GROUP BY dt, rider) f
    JOIN {_mode("time_of_day", "dt, rider", source)} t ON {same.format("t")}
    JOIN {_mode("distance_category", "dt, rider", source)} k ON {same.format("k")}
    JOIN {_mode("duration_category", "dt, rider", source)} m ON {same.format("m")}"""


def _month_counts(where: str, name: str) -> str:
    tables = (
        ("agg_user_behavior", "(SELECT DISTINCT dt, rider FROM fact)"),
        ("agg_daily_metrics", "(SELECT DISTINCT dt FROM fact)"),
        ("fact_rides", "fact"),
        ("dim_time", "(SELECT DISTINCT dt FROM fact)"),
    )
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, COUNT(*) AS {name} FROM {rows} WHERE {where}"
        for table, rows in tables
    )


def _by_rider(column: str, alias: str, extra: str = "") -> str:
    return f"""
    SELECT {column} AS {alias}, rider AS member_casual, COUNT(*) AS ride_count,
           {_mean("km_u", 6)} AS avg_distance, {_mean("min_u", 6)} AS avg_duration{extra}
    FROM positive GROUP BY 1, 2"""


def _totals(digits: int = 2) -> str:
    return f"COUNT(*) AS total_rides, {_total('km_u', digits)} AS total_distance"


RAW_COLUMNS = """ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id,
  end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual,
  CAST(dt AS VARCHAR) AS dt"""

EARLIER = "dt < DATE '2024-03-01'"
MORNING_IDS = f"""(
  SELECT start_station_id AS id FROM staged WHERE {EARLIER} AND h < 12
  UNION SELECT end_station_id FROM staged WHERE {EARLIER} AND h < 12)"""

#: Rides of the even batch, and every seventh ride a day later, where the second batch moved it.
MOVED = """(
  SELECT * REPLACE (CASE WHEN number % 7 = 0 THEN dt + 1 ELSE dt END AS dt)
  FROM (SELECT *, CAST(substr(ride_id, 2) AS BIGINT) AS number FROM fact)
  WHERE number % 2 = 0 OR number % 7 = 0)"""

BODIES = {
    "raw_trips": f"SELECT {RAW_COLUMNS} FROM raw",
    "raw_zone_scan": f"SELECT {RAW_COLUMNS} FROM raw",
    "raw_zone_reload": f"""
        SELECT {RAW_COLUMNS}, CASE WHEN even THEN '202404' ELSE '202405' END AS batch
        FROM (SELECT *, coalesce(CAST(substr(ride_id, 2) AS BIGINT) % 2 = 0, FALSE) AS even FROM raw)
        WHERE NOT even OR member_casual = 'member'""",
    "month_slice": f"SELECT {RAW_COLUMNS} FROM raw WHERE strftime(dt, '%Y%m') = '202404'",
    "param_sql": f"""
        SELECT rider AS member_casual, COUNT(*) AS rides, {_total("km_u", 6)} AS km
        FROM fact WHERE h IN (7, 8, 9) GROUP BY 1""",
    "write_verification": """
        SELECT COUNT(DISTINCT dt) AS partitions, COUNT(*) AS expected_rows,
               COUNT(*) AS actual_rows, TRUE AS ok FROM staged""",
    "merge_dedup": """
        SELECT COUNT(*) AS rows_before,
               COUNT(DISTINCT ride_id) + MAX(CASE WHEN ride_id IS NULL THEN 1 ELSE 0 END) AS rows_after,
               COUNT(*) - COUNT(DISTINCT ride_id)
                 - MAX(CASE WHEN ride_id IS NULL THEN 1 ELSE 0 END) AS removed FROM raw""",
    "upsert_fact": "SELECT "
    + FACT_COLUMNS.format(
        distance="km_u / 1000000.0",
        created=f"CASE WHEN CAST(substr(ride_id, 2) AS BIGINT) % 5 = 0 "
        f"THEN '2020-01-01 00:00:00' ELSE '{RUN_TS}' END",
        origin="CASE WHEN CAST(substr(ride_id, 2) AS BIGINT) % 5 = 0 THEN 'old' ELSE 'trip_archive' END",
    )
    + " FROM fact",
    "merge_table_fact": "SELECT "
    + FACT_COLUMNS.format(
        distance="km_u / 1000000.0",
        created=f"CASE WHEN number % 5 < 3 THEN '2020-01-01 00:00:00' ELSE '{RUN_TS}' END",
        origin="CASE WHEN number % 5 < 3 THEN 'old' ELSE 'trip_archive' END",
    )
    + """ FROM (
        SELECT * REPLACE (CASE WHEN number % 7 = 0 AND number % 3 = 0 THEN dt + 1 ELSE dt END AS dt)
        FROM (SELECT *, CAST(substr(ride_id, 2) AS BIGINT) AS number FROM fact)
        WHERE number % 5 < 3 OR number % 7 <> 0)""",
    "merge_table_time": _dim_time("CASE WHEN day(dt) <= 10 THEN 'OLD' ELSE upper(season) END"),
    "station_totals_by_batch": _dim_stations(),
    "daily_rollup_by_change": _daily(MOVED),
    "behavior_rollup_by_change": _behavior(MOVED),
    "sketch_kpi": f"""
        SELECT rider AS member_casual, COUNT(*) AS total_rides, {_mean("km_u", 3)} AS avg_distance_km,
               {_total("km_u", 3)} AS total_distance_km, {_mean("min_u", 2)} AS avg_duration_minutes, TRUE AS as_near_as_said
        FROM positive WHERE year(dt) = 2024 GROUP BY rider""",
    "upsert_dim_stations": f"""
        WITH old AS ({_dim_stations("dt < DATE '2025-01-01'")}),
             new AS ({_dim_stations("dt >= DATE '2025-01-01'")})
        SELECT * FROM new
        UNION ALL SELECT * FROM old WHERE station_id NOT IN (SELECT station_id FROM new)""",
    "upsert_dim_time": _dim_time(
        "CASE WHEN day(dt) <= 10 THEN 'OLD' ELSE upper(season) END"
    ),
    "insert_if_absent": _dim_time(
        "CASE WHEN day(dt) % 2 = 0 THEN 'OLD' ELSE upper(season) END"
    ),
    "month_delete_counts": _month_counts(f"dt {IN_MONTH}", "deleted"),
    "month_delete_remaining": _month_counts(f"dt NOT {IN_MONTH}", "remaining"),
    "guarded_dim_delete": f"""
        SELECT * FROM ({_dim_time()}) WHERE NOT (CAST(time_key AS DATE) {IN_MONTH}
          AND CAST(time_key AS DATE) NOT IN (SELECT dt FROM fact WHERE rider = 'CASUAL'))""",
    "orphan_facts": f"""
        SELECT 'dt' AS reference, COUNT(DISTINCT dt) AS missing_keys, COUNT(*) AS orphan_rows
        FROM fact WHERE NOT ({EARLIER}) HAVING COUNT(*) > 0
        UNION ALL
        SELECT 'start_station_id', COUNT(DISTINCT start_station_id), COUNT(*) FROM fact
        WHERE start_station_id IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM {MORNING_IDS} k WHERE k.id = start_station_id) HAVING COUNT(*) > 0
        UNION ALL
        SELECT 'end_station_id', COUNT(DISTINCT end_station_id), COUNT(*) FROM fact
        WHERE end_station_id IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM {MORNING_IDS} k WHERE k.id = end_station_id) HAVING COUNT(*) > 0""",
    "fact_sample": """
        SELECT ride_id, rider AS member_casual, km_u / 1000000.0 AS total_distance,
               CAST(dt AS VARCHAR) AS dt FROM fact ORDER BY ride_id LIMIT 5""",
    "filter_required": "SELECT ride_id, started_at, ended_at, rideable_type FROM complete",
    "filter_plausible": "SELECT ride_id, min_u / 1000000.0 AS trip_duration_minutes FROM staged",
    "invalid_coordinates": """
        SELECT ride_id, started_at, end_lat, end_lng FROM raw
        WHERE start_lat NOT BETWEEN 41.0 AND 42.5 OR end_lat NOT BETWEEN 41.0 AND 42.5
           OR start_lng NOT BETWEEN -88.5 AND -87.0 OR end_lng NOT BETWEEN -88.5 AND -87.0""",
    "trip_duration": """
        SELECT ride_id, CAST(ts0 AS VARCHAR) AS started_at_ts, CAST(ts1 AS VARCHAR) AS ended_at_ts,
               ((secs * 2000000 + 60) // 120) / 1000000.0 AS trip_duration_minutes FROM timed""",
    "trip_distance": """
        SELECT ride_id, started_at, CAST(ROUND(CAST(km AS DECIMAL(18, 6)), 3) AS DOUBLE) AS trip_distance_km
        FROM measured""",
    "calendar_columns": """
        SELECT ride_id, CAST(dt AS VARCHAR) AS start_date, CAST(dt AS VARCHAR) AS dt, h AS start_hour,
               dow AS start_day_of_week, mon AS start_month, yr AS start_year FROM staged""",
    "standardize_rideable": """
        SELECT ride_id, started_at, rideable_type,
               CASE WHEN rideable_type LIKE '%\\_bike' ESCAPE '\\' THEN rideable_type
                    ELSE 'unknown' END AS rideable_type_clean FROM raw""",
    "standardize_member": """
        SELECT ride_id, started_at, member_casual,
               CASE WHEN member_casual = 'guest' THEN 'unknown' ELSE member_casual END
                 AS member_casual_clean FROM raw""",
    "duration_bands": "SELECT ride_id, duration_category AS trip_duration_category FROM staged",
    "distance_bands": "SELECT ride_id, distance_category AS trip_distance_category FROM staged",
    "calendar_bands": "SELECT ride_id, time_of_day, day_type, season FROM staged",
    "custom_bands": """
        SELECT ride_id,
               CASE WHEN km_u < 1000000 THEN 'SHORT' WHEN km_u < 5000000 THEN 'MEDIUM'
                    WHEN km_u < 15000000 THEN 'LONG' ELSE 'VERY_LONG' END AS distance_band,
               CASE WHEN secs < 900 THEN 'QUICK' WHEN secs < 3600 THEN 'NORMAL'
                    WHEN secs < 10800 THEN 'EXTENDED' ELSE 'VERY_EXTENDED' END AS duration_band,
               CASE WHEN h < 6 OR h = 23 THEN 'NIGHT' WHEN h < 12 THEN 'MORNING'
                    WHEN h < 18 THEN 'AFTERNOON' ELSE 'EVENING' END AS day_part FROM fact""",
    "quality_report": """
        SELECT COUNT(*) AS total_records, COUNT(*) - COUNT(ride_id) AS null_ride_id,
               COUNT(*) - COUNT(started_at) AS null_started_at,
               COUNT(*) - COUNT(ended_at) AS null_ended_at,
               COUNT(*) - COUNT(rideable_type) AS null_rideable_type,
               COUNT(started_at) - COUNT(ts0) AS unparsable_started_at,
               CAST(MIN(ts0) AS VARCHAR) AS min_started_at, CAST(MAX(ts0) AS VARCHAR) AS max_started_at,
               COUNT(*) FILTER (WHERE start_lat < 41 OR start_lat > 42.5 OR end_lat < 41 OR end_lat > 42.5
                 OR start_lng < -88.5 OR start_lng > -87 OR end_lng < -88.5 OR end_lng > -87) AS invalid_coordinates,
               COUNT(*) - COUNT(DISTINCT ride_id)
                 - MAX(CASE WHEN ride_id IS NULL THEN 1 ELSE 0 END) AS duplicate_ride_ids
        FROM timed""",
    "cleaning_counts": """
        SELECT total_records, after_dedup, after_required, after_plausible,
               total_records - after_dedup AS removed_duplicates,
               after_dedup - after_required AS removed_incomplete,
               after_required - after_plausible AS removed_implausible
        FROM (SELECT (SELECT COUNT(*) FROM raw) AS total_records,
                     (SELECT COUNT(*) FROM (SELECT DISTINCT ride_id FROM raw)) AS after_dedup,
                     (SELECT COUNT(DISTINCT ride_id) FROM complete) AS after_required,
                     (SELECT COUNT(*) FROM valid) AS after_plausible)""",
    "data_summary": f"""
        SELECT COUNT(*) AS total_records, COUNT(DISTINCT ride_id) AS unique_rides,
               CAST(MIN(dt) AS VARCHAR) AS earliest_date, CAST(MAX(dt) AS VARCHAR) AS latest_date,
               {_mean("min_u", 2)} AS avg_duration_minutes, {_mean("km_u", 2)} AS avg_distance_km
        FROM staged""",
    "category_distribution": "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS category, {column} AS value, COUNT(*) AS rides,
                   row_number() OVER (ORDER BY COUNT(*) DESC, {column}) AS place
            FROM staged GROUP BY {column}"""
        for name, column in (
            ("rideable_type_clean", "rideable_type_clean"),
            ("member_casual_clean", "member_casual_clean"),
            ("trip_duration_category", "duration_category"),
            ("time_of_day", "time_of_day"),
            ("day_type", "day_type"),
            ("season", "season"),
        )
    )
    + ") WHERE place <= 10",
    "fact_rides": "SELECT "
    + FACT_COLUMNS.format(
        distance="km_u / 1000000.0", created=f"'{RUN_TS}'", origin="'trip_archive'"
    )
    + " FROM fact",
    "dim_time": _dim_time(),
    "dim_stations": _dim_stations(),
    "agg_daily_metrics": _daily(),
    "agg_user_behavior": _behavior(),
    "agg_daily_incremental": f"SELECT * FROM ({_daily()}) WHERE day(CAST(date_key AS DATE)) % 2 = 1",
    "agg_user_incremental": f"""
        SELECT * FROM ({_behavior()})
        WHERE NOT (day(CAST(date_key AS DATE)) % 2 = 0 AND member_type = 'MEMBER')
          AND day(CAST(date_key AS DATE)) <> 5""",
    "member_distance_kpi": "SELECT * FROM kpi",
    "daily_trends": f"""
        SELECT CAST(dt AS VARCHAR) AS dt, rider AS member_casual, COUNT(*) AS daily_rides,
               {_mean("km_u", 3)} AS avg_daily_distance, {_total("km_u", 3)} AS total_daily_distance,
               {_mean("min_u", 2)} AS avg_daily_duration
        FROM fact WHERE dt >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1, 2""",
    "station_popularity": f"""
        SELECT s.station_name, s.station_id, COUNT(*) AS total_rides, COUNT(DISTINCT dt) AS active_days,
               {_mean("km_u", 6)} AS avg_distance, {_mean("min_u", 6)} AS avg_duration,
               COUNT(*) FILTER (WHERE rider = 'MEMBER') AS member_rides,
               COUNT(*) FILTER (WHERE rider = 'CASUAL') AS casual_rides
        FROM fact JOIN ({_dim_stations()}) s ON s.station_id = start_station_id
        GROUP BY 1, 2 ORDER BY total_rides DESC, station_name, station_id LIMIT 20""",
    "hourly_distribution": _by_rider("h", "hour_of_day"),
    "distance_category_analysis": _by_rider(
        "distance_category", "distance_category", f", {_total('km_u', 6)} AS total_distance"
    ),
    "time_of_day_analysis": _by_rider("time_of_day", "time_of_day"),
    "weekly_patterns": _by_rider("dow", "day_of_week", ", any_value(dayname(dt)) AS day_name"),
    "top_routes": f"""
        SELECT a.station_name AS start_station_name, b.station_name AS end_station_name,
               COUNT(*) AS ride_count, {_mean("km_u", 6)} AS avg_distance,
               {_mean("min_u", 6)} AS avg_duration,
               SUM(CASE WHEN rider = 'MEMBER' THEN 1 ELSE 0 END)::BIGINT AS member_rides,
               SUM(CASE WHEN rider = 'CASUAL' THEN 1 ELSE 0 END)::BIGINT AS casual_rides,
               a.station_name || ' → ' || b.station_name AS route
        FROM fact JOIN ({_dim_stations()}) a ON a.station_id = start_station_id
                  JOIN ({_dim_stations()}) b ON b.station_id = end_station_id
        WHERE a.station_name <> b.station_name AND km_u > 0
        GROUP BY 1, 2 ORDER BY ride_count DESC, 1, 2 LIMIT 10""",
    "database_stats": """
        SELECT 'Total Rides' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM fact
        UNION ALL
        SELECT 'Total Distance (km)', CAST(CAST((SUM(km_u) + 5000) // 10000 AS BIGINT) // 100 AS VARCHAR)
               || '.' || lpad(CAST(CAST((SUM(km_u) + 5000) // 10000 AS BIGINT) % 100 AS VARCHAR), 2, '0') FROM fact
        UNION ALL
        SELECT 'Unique Stations', CAST(COUNT(DISTINCT start_station_id) AS VARCHAR) FROM fact
        UNION ALL
        SELECT 'Date Range', CONCAT(CAST(MIN(dt) AS VARCHAR), ' to ', CAST(MAX(dt) AS VARCHAR)) FROM fact""",
    "quarter_analysis": f"""
        SELECT {_totals()}, {_mean("km_u", 2)} AS avg_distance, {_mean("min_u", 2)} AS avg_duration
        FROM fact WHERE mon IN (4, 5, 6)""",
    "quarter_by_member": f"""
        SELECT rider AS member_casual, {_totals()}, {_mean("km_u", 2)} AS avg_distance
        FROM fact WHERE mon IN (4, 5, 6) GROUP BY 1""",
    "quarter_monthly_trend": f"""
        SELECT mon AS month, CASE mon WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' END AS month_name,
               {_totals()} FROM fact WHERE mon IN (4, 5, 6) GROUP BY 1, 2""",
    "daily_comparison": f"""
        SELECT CAST(dt AS VARCHAR) AS period, strftime(dt, '%Y-%m-%d') AS period_label, {_totals()}
        FROM fact WHERE dt >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1, 2""",
    "monthly_comparison": "SELECT * FROM monthly",
    "quarterly_comparison": f"""
        SELECT yr AS year, CAST(quarter(dt) AS BIGINT) AS quarter,
               CAST(yr AS VARCHAR) || '-Q' || CAST(quarter(dt) AS VARCHAR) AS period_label, {_totals()}
        FROM fact GROUP BY 1, 2, 3""",
    "yearly_comparison": f"""
        SELECT yr AS year, CAST(yr AS VARCHAR) AS period_label, {_totals()} FROM fact GROUP BY 1, 2""",
    "member_vs_casual": f"""
        SELECT m_avg_distance_km AS member_avg_distance_km,
               ROUND(m_avg_distance_km - c_avg_distance_km, 3) AS avg_distance_delta,
               m_total_distance_km AS member_total_distance_km,
               {_percent("CAST(ROUND((m_total_distance_km - c_total_distance_km) * 1000) AS BIGINT)",
                         "CAST(ROUND(c_total_distance_km * 1000) AS BIGINT)", 4)} AS total_distance_delta_pct,
               m_median_distance_km AS member_median_distance_km,
               ROUND(m_median_distance_km - c_median_distance_km, 3) AS median_distance_delta,
               m_avg_duration_minutes AS member_avg_duration_minutes,
               ROUND(m_avg_duration_minutes - c_avg_duration_minutes, 2) AS avg_duration_delta
        FROM pair""",
    "member_insights": """
        WITH topics AS (
          SELECT 'distance' AS topic, m_avg_distance_km AS m, c_avg_distance_km AS c, 'km' AS unit,
                 printf('%.3f', m_avg_distance_km) AS mt, printf('%.3f', c_avg_distance_km) AS ct FROM pair
          UNION ALL
          SELECT 'duration', m_avg_duration_minutes, c_avg_duration_minutes, 'min',
                 printf('%.1f', ROUND(CAST(m_avg_duration_minutes AS DECIMAL(18, 2)), 1)::DOUBLE),
                 printf('%.1f', ROUND(CAST(c_avg_duration_minutes AS DECIMAL(18, 2)), 1)::DOUBLE) FROM pair
          UNION ALL
          SELECT 'stations', m_unique_start_stations, c_unique_start_stations, 'stations',
                 CAST(m_unique_start_stations AS VARCHAR), CAST(c_unique_start_stations AS VARCHAR) FROM pair)
        SELECT topic, CASE WHEN m > c THEN 'MEMBER' ELSE 'CASUAL' END AS leading,
               CAST(m AS DOUBLE) AS member_value, CAST(c AS DOUBLE) AS casual_value,
               topic || ': ' || CASE WHEN m > c THEN 'MEMBER leads with ' || mt || ' to ' || ct
                                     ELSE 'CASUAL leads with ' || ct || ' to ' || mt END || ' ' || unit AS insight
        FROM topics""",
    "kpi_pivot": """
        SELECT * EXCLUDE (member_casual),
               CASE WHEN member_casual = 'CASUAL' THEN total_rides ELSE 0 END AS "CASUAL",
               CASE WHEN member_casual = 'GUEST' THEN total_rides ELSE 0 END AS "GUEST",
               CASE WHEN member_casual = 'MEMBER' THEN total_rides ELSE 0 END AS "MEMBER" FROM kpi""",
    "distance_category_pivot": """
        SELECT distance_category, COUNT(*) FILTER (WHERE rider = 'CASUAL') AS "CASUAL",
               COUNT(*) FILTER (WHERE rider = 'GUEST') AS "GUEST",
               COUNT(*) FILTER (WHERE rider = 'MEMBER') AS "MEMBER" FROM positive GROUP BY 1""",
    "period_change": f"""
        SELECT rides AS current_period, before AS previous_period, rides - before AS change,
               COALESCE({_percent("(rides - before)", "before", 6)}, 0) AS change_pct
        FROM steps WHERE x = n - 1 AND n > 1""",
    "growth_rates": f"""
        SELECT monthly.*, {_percent("(rides - before)", "before", 6)} AS growth_pct
        FROM monthly JOIN steps ON strftime(m, '%Y-%m') = period_label""",
    "growth_trend": """
        SELECT CASE WHEN periods < 2 THEN 'Insufficient Data' WHEN mean IS NULL THEN 'No Growth Data'
                    WHEN mean > 5 THEN 'Growing' WHEN mean > 0 THEN 'Stable Growth'
                    WHEN mean > -5 THEN 'Slight Decline' ELSE 'Declining' END AS direction,
               ROUND(COALESCE(mean, 0), 4) AS avg_growth, periods
        FROM (SELECT COUNT(*) AS periods,
                     AVG((rides - before) * 100.0 / before) FILTER (WHERE before > 0) AS mean FROM steps)""",
    "trend_line": """
        SELECT monthly.*, ROUND(line.a + line.b * x, 4) AS trend
        FROM monthly JOIN steps ON strftime(m, '%Y-%m') = period_label
        JOIN (SELECT regr_intercept(rides, x) AS a, regr_slope(rides, x) AS b FROM steps) line ON TRUE
        WHERE n > 3""",
}

ORACLES = {name: f"WITH {CTES} SELECT * FROM ({body})" for name, body in BODIES.items()}
