"""Table schemas and the fixed values the rules depend on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MEASURE = T.DecimalType(18, 6)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TRIP_COLUMNS = _struct(
    ride_id=T.StringType(),
    rideable_type=T.StringType(),
    started_at=T.StringType(),
    ended_at=T.StringType(),
    start_station_name=T.StringType(),
    start_station_id=T.StringType(),
    end_station_name=T.StringType(),
    end_station_id=T.StringType(),
    start_lat=T.DoubleType(),
    start_lng=T.DoubleType(),
    end_lat=T.DoubleType(),
    end_lng=T.DoubleType(),
    member_casual=T.StringType(),
)

RAW_TRIPS = T.StructType(TRIP_COLUMNS.fields + [T.StructField("dt", T.DateType())])

STAGED_TRIPS = T.StructType(
    TRIP_COLUMNS.fields
    + _struct(
        started_at_ts=T.TimestampType(),
        ended_at_ts=T.TimestampType(),
        trip_duration_minutes=T.DoubleType(),
        start_date=T.DateType(),
        start_hour=T.IntegerType(),
        start_day_of_week=T.IntegerType(),
        start_month=T.IntegerType(),
        start_year=T.IntegerType(),
        trip_distance_km=T.DoubleType(),
        rideable_type_clean=T.StringType(),
        member_casual_clean=T.StringType(),
        processed_at=T.TimestampType(),
        processing_date=T.DateType(),
        trip_duration_category=T.StringType(),
        trip_distance_category=T.StringType(),
        time_of_day=T.StringType(),
        day_type=T.StringType(),
        season=T.StringType(),
        dt=T.DateType(),
    ).fields
)

DIM_TIME = _struct(
    time_key=T.DateType(),
    year=T.IntegerType(),
    month=T.IntegerType(),
    day_of_month=T.IntegerType(),
    day_of_week=T.IntegerType(),
    week_of_year=T.IntegerType(),
    quarter=T.IntegerType(),
    is_weekend=T.BooleanType(),
    season=T.StringType(),
)

DIM_STATIONS = _struct(
    station_id=T.StringType(),
    station_name=T.StringType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    total_departures=T.LongType(),
    total_arrivals=T.LongType(),
    avg_departure_duration=MEASURE,
    avg_arrival_duration=MEASURE,
)

FACT_RIDES = _struct(
    ride_id=T.StringType(),
    started_at=T.TimestampType(),
    ended_at=T.TimestampType(),
    start_station_id=T.StringType(),
    end_station_id=T.StringType(),
    member_casual=T.StringType(),
    rideable_type=T.StringType(),
    ride_duration_minutes=MEASURE,
    ride_duration_hours=MEASURE,
    total_distance=MEASURE,
    avg_speed_kmh=MEASURE,
    distance_category=T.StringType(),
    duration_category=T.StringType(),
    time_of_day=T.StringType(),
    hour_of_day=T.IntegerType(),
    day_of_week=T.IntegerType(),
    month=T.IntegerType(),
    year=T.IntegerType(),
    dt=T.DateType(),
    created_at=T.TimestampType(),
    updated_at=T.TimestampType(),
    data_source=T.StringType(),
    batch_id=T.StringType(),
    is_valid=T.BooleanType(),
    processing_date=T.DateType(),
)

AGG_DAILY_METRICS = _struct(
    date_key=T.DateType(),
    total_rides=T.LongType(),
    total_distance=T.DecimalType(38, 3),
    avg_distance=T.DecimalType(18, 3),
    avg_duration_minutes=T.DecimalType(18, 2),
    member_rides=T.LongType(),
    casual_rides=T.LongType(),
    member_avg_distance=T.DecimalType(18, 3),
    casual_avg_distance=T.DecimalType(18, 3),
    peak_hour=T.IntegerType(),
    total_stations_used=T.LongType(),
)

AGG_USER_BEHAVIOR = _struct(
    date_key=T.DateType(),
    member_type=T.StringType(),
    total_rides=T.LongType(),
    avg_distance=MEASURE,
    avg_duration_minutes=MEASURE,
    total_distance=T.DecimalType(38, 6),
    preferred_time_of_day=T.StringType(),
    preferred_distance_category=T.StringType(),
    preferred_duration_category=T.StringType(),
    unique_stations_used=T.LongType(),
)


# --- fixed values -----------------------------------------------------------

REQUIRED_FIELDS = ("ride_id", "started_at", "ended_at", "rideable_type")
RIDEABLE_TYPES = ("electric_bike", "classic_bike", "docked_bike")
RIDER_TYPES = ("member", "casual")
MEMBER, CASUAL = "MEMBER", "CASUAL"

# yyyy-MM-dd HH:mm:ss, with or without a fraction.
TIMESTAMP_PATTERN = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,3})?$"
EARTH_RADIUS_KM = 6371

# Service area, degrees.
LATITUDE_RANGE = (41.0, 42.5)
LONGITUDE_RANGE = (-88.5, -87.0)

# A plausible trip lies strictly between these bounds.
MIN_MINUTES, MAX_MINUTES, MAX_KM = 1, 1440, 100

# Upper bounds, inclusive; what exceeds the last one is LAST_BAND.
DURATION_BANDS = ((5, "very_short"), (15, "short"), (30, "medium"), (60, "long"))
DISTANCE_BANDS = ((1, "very_short"), (3, "short"), (5, "medium"), (10, "long"))
LAST_BAND = "very_long"
BAND_ORDER = ("very_short", "short", "medium", "long", "very_long")

# First and last hour, inclusive; the hours left over are night.
DAY_PARTS = (("morning", 6, 11), ("afternoon", 12, 17), ("evening", 18, 21))
DAY_PART_ORDER = ("morning", "afternoon", "evening", "night")

WEEKEND_DAYS = (1, 7)  # 1 = Sunday
SEASON_MONTHS = (("winter", (12, 1, 2)), ("spring", (3, 4, 5)), ("summer", (6, 7, 8)))
LAST_SEASON = "fall"

# Second band set: half-open ranges, and hour windows that may wrap midnight.
DASHBOARD_DISTANCE_BANDS = (
    ("SHORT", 0, 1),
    ("MEDIUM", 1, 5),
    ("LONG", 5, 15),
    ("VERY_LONG", 15, None),
)
DASHBOARD_DURATION_BANDS = (
    ("QUICK", 0, 15),
    ("NORMAL", 15, 60),
    ("EXTENDED", 60, 180),
    ("VERY_EXTENDED", 180, None),
)
DASHBOARD_DAY_PARTS = (
    ("MORNING", 6, 11),
    ("AFTERNOON", 12, 17),
    ("EVENING", 18, 22),
    ("NIGHT", 23, 5),
)

SUMMARY_CATEGORIES = (
    "rideable_type_clean",
    "member_casual_clean",
    "trip_duration_category",
    "time_of_day",
    "day_type",
    "season",
)


# --- tables that loads keep beside the mart ----------------------------------

CONTENTS = (("n_rows", T.LongType()), ("row_sum", T.DecimalType(38, 0)), ("row_xor", T.LongType()))

#: Which run's folder holds a date of a table, and what is in it.
DAY_FOLDERS = T.StructType(
    [T.StructField("day", T.DateType()), T.StructField("run", T.StringType())]
    + [T.StructField(name, kind) for name, kind in CONTENTS]
)

#: Sums of a batch's rides by the place they began or ended at. The row without station says which load of the batch counts.
STATION_PARTS = T.StructType(
    [T.StructField(x, T.StringType()) for x in ("batch", "load", "station_id", "station_name")]
    + [T.StructField(x, T.DoubleType()) for x in ("latitude", "longitude")]
    + [
        T.StructField(f"{side}_{name}", kind)
        for side in ("out", "in")
        for name, kind in (("rides", T.LongType()), ("timed", T.LongType()), ("minutes", T.DecimalType(28, 6)))
    ]
)

AGG_SKETCHES = T.StructType(
    [T.StructField("date_key", T.DateType()), T.StructField("member_type", T.StringType())]
    + [T.StructField(x, T.LongType()) for x in ("total_rides", "timed_rides")]
    + [T.StructField(x, T.DecimalType(28, 6)) for x in ("total_distance", "total_minutes")]
    + [T.StructField(x, T.BinaryType()) for x in ("distances", "start_stations", "end_stations", "routes")]
)


# --- merge rules ------------------------------------------------------------


@dataclass(frozen=True)
class MergeSpec:
    """How a mart table takes new rows: its key and the columns an update keeps."""

    table: str
    schema: T.StructType
    key: str
    preserved: tuple[str, ...] = ()
    partition: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def updated(self) -> list[str]:
        return [c for c in self.columns if c != self.key and c not in self.preserved]


TIME_MERGE = MergeSpec("dim_time", DIM_TIME, "time_key")
STATION_MERGE = MergeSpec("dim_stations", DIM_STATIONS, "station_id")
FACT_MERGE = MergeSpec(
    "fact_rides", FACT_RIDES, "ride_id", ("created_at", "data_source"), "dt"
)
