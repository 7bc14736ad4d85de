"""Small hand-made tables in the declared schemas."""

from datetime import datetime

from velometry.schemas import STATIONS, TAXI, TRIPS

PLACES = {"A": (40.70, -74.00), "B": (40.71, -74.00), "C": (40.72, -74.00), "D": (40.69, -74.00)}


def _time(text):
    return datetime.fromisoformat(text) if text else None


def trips(spark, *rides, places=PLACES):
    """Rides are (start time, stop time, start name, end name)."""
    rows = [
        (
            _time(start),
            _time(stop),
            None,
            a,
            *places.get(a, (None, None)),
            None,
            b,
            *places.get(b, (None, None)),
        )
        for start, stop, a, b in rides
    ]
    return spark.createDataFrame(rows, TRIPS)


def stations(spark, *rows):
    """Rows are (id, name, lat, lon, capacity, available)."""
    full = [(i, n, la, lo, None, cap, av, 0) for i, n, la, lo, cap, av in rows]
    return spark.createDataFrame(full, STATIONS)


def taxi(spark, *rides):
    """Rides are dicts; columns not named get harmless values."""
    base = dict.fromkeys(TAXI.fieldNames(), 1)
    base.update(
        pickup_datetime="2016-03-01 10:00:00",
        dropoff_datetime="2016-03-01 10:10:00",
        pickup_latitude=40.75,
        pickup_longitude=-74.0,
        dropoff_latitude=40.76,
        dropoff_longitude=-74.0,
        trip_distance=1.0,
        travel_time=600.0,
    )
    rows = []
    for ride in rides:
        row = base | ride
        values = []
        for field in TAXI.fields:
            value = row[field.name]
            kind = field.dataType.typeName()
            if value is not None and kind == "double":
                value = float(value)
            if kind == "timestamp_ntz":
                value = _time(value)
            values.append(value)
        rows.append(tuple(values))
    return spark.createDataFrame(rows, TAXI)


def hours(spark, *rows):
    """Rows are (name, date, hour, movement, lat, lon), as in a shortage table."""
    schema = (
        "name string, date string, hour int, hourly_bike_movement bigint, "
        "latitude double, longitude double"
    )
    df = spark.createDataFrame(list(rows), schema)
    return df.withColumn("date", df["date"].cast("date"))


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
