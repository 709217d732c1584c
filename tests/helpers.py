from __future__ import annotations

from datetime import datetime

from tripmart import schemas as S

RUN_TS = datetime(2025, 7, 1)


def trip_row(ride_id="R1", **changes):
    """One raw trip, complete and plausible unless changed."""
    row = {
        "ride_id": ride_id,
        "rideable_type": "classic_bike",
        "started_at": "2024-04-10 08:00:00",
        "ended_at": "2024-04-10 08:20:00",
        "start_station_name": "A street",
        "start_station_id": "A",
        "end_station_name": "B street",
        "end_station_id": "B",
        "start_lat": 41.8,
        "start_lng": -87.6,
        "end_lat": 41.82,
        "end_lng": -87.62,
        "member_casual": "member",
    }
    row.update(changes)
    return tuple(row[c] for c in S.TRIP_COLUMNS.fieldNames())


def raw_frame(spark, rows):
    from tripmart.sources.zones import with_load_date

    return with_load_date(spark.createDataFrame(rows, S.TRIP_COLUMNS))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
