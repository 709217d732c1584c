"""Bike trips derived from an ``events`` table, in SQL that Spark and DuckDB both run."""

TRIPS_CTES = """
base AS (
  SELECT event_id, user_id, event_type, value,
         date_trunc('second', ts) + INTERVAL '1' DAY * CAST((event_id * 37) % 730 AS INT) AS t0,
         CAST(floor(value * 30) AS INT) + CASE WHEN event_id % 401 = 0 THEN 90000 ELSE 0 END AS secs,
         CAST(user_id % 40 AS INT) AS s, CAST((event_id * 7) % 40 AS INT) AS e
  FROM {events}),
trips AS (
  SELECT CASE WHEN event_id % 211 = 0 THEN NULL ELSE concat('R', CAST(event_id AS STRING)) END AS ride_id,
         CASE event_type WHEN 'view' THEN 'electric_bike' WHEN 'click' THEN 'classic_bike'
                         WHEN 'purchase' THEN 'docked_bike' WHEN 'error' THEN 'scooter' ELSE NULL END AS rideable_type,
         CASE WHEN event_id % 293 = 0 THEN 'not a time' WHEN event_id % 283 = 0 THEN concat(CAST(t0 AS STRING), '.250')
              ELSE CAST(t0 AS STRING) END AS started_at,
         CASE WHEN event_id % 173 = 0 THEN NULL
              ELSE CAST(t0 + INTERVAL '1' SECOND * secs AS STRING) END AS ended_at,
         CASE WHEN event_id % 13 = 0 OR event_id % 29 = 0 THEN NULL
              WHEN event_id % 31 = 0 THEN concat('Old Station ', CAST(s AS STRING))
              ELSE concat('Station ', CAST(s AS STRING)) END AS start_station_name,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('ST', CAST(s AS STRING)) END AS start_station_id,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat('Station ', CAST(e AS STRING)) END AS end_station_name,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat('ST', CAST(e AS STRING)) END AS end_station_id,
         CAST(41.60 AS DOUBLE) + s * CAST(0.013 AS DOUBLE) AS start_lat,
         CAST(-87.90 AS DOUBLE) + (s % 7) * CAST(0.05 AS DOUBLE) AS start_lng,
         CASE WHEN event_id % 301 = 0 THEN CAST(0.0 AS DOUBLE) WHEN event_id % 307 = 0 THEN NULL
              WHEN event_id % 311 = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE CAST(41.60 AS DOUBLE) + e * CAST(0.013 AS DOUBLE) END AS end_lat,
         CASE WHEN event_id % 301 = 0 THEN CAST(0.0 AS DOUBLE) WHEN event_id % 307 = 0 THEN NULL
              ELSE CAST(-87.90 AS DOUBLE) + (e % 7) * CAST(0.05 AS DOUBLE) END AS end_lng,
         CASE WHEN user_id % 11 = 0 THEN 'guest' WHEN user_id % 3 = 0 THEN 'casual' ELSE 'member' END AS member_casual
  FROM base)
"""

TRIPS_QUERY = """
SELECT * FROM trips
UNION ALL
SELECT t.* FROM trips t WHERE t.ride_id LIKE '%77'
UNION ALL
SELECT ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id, end_station_name,
       end_station_id, start_lat, start_lng, CAST(0.0 AS DOUBLE) AS end_lat, CAST(0.0 AS DOUBLE) AS end_lng, member_casual
FROM trips WHERE ride_id LIKE '%55'
UNION ALL
SELECT ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id, end_station_name,
       end_station_id, start_lat, start_lng, end_lat, end_lng, 'casual' AS member_casual
FROM trips WHERE ride_id LIKE '%33'
"""

TRIPS_SQL = f"WITH {TRIPS_CTES} {TRIPS_QUERY}"
