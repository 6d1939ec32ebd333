"""Hand-written bronze trips."""

from ridestrata.schemas import TRIPS

GOOD = {
    "ride_id": "R1",
    "rideable_type": "classic_bike",
    "started_at": "2024-01-10 08:00:00",
    "ended_at": "2024-01-10 08:20:00",
    "start_station_name": "A",
    "start_station_id": 1.0,
    "end_station_name": "B",
    "end_station_id": 2.0,
    "start_lat": 38.9,
    "start_lng": -77.0,
    "end_lat": 38.91,
    "end_lng": -77.01,
    "member_casual": "member",
}


def bronze(spark, *rows):
    """One trip per dict of columns that differ from a good trip; rows without a
    ride_id are numbered."""
    values = []
    for number, changes in enumerate(rows):
        trip = {**GOOD, "ride_id": f"R{number}", **changes}
        values.append(tuple(trip[name] for name in TRIPS.names))
    return spark.createDataFrame(values, TRIPS)


def cells(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def ids(df, column="ride_id"):
    return sorted(str(row[0]) for row in df.select(column).collect())
