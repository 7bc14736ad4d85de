"""Declared schemas.  Times are zone-free wall-clock times of the city."""

from pyspark.sql import types as T

_D, _I, _L, _S, _TS = (
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.StringType(),
    T.TimestampNTZType(),
)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRIPS = _table(
    starttime=_TS,
    stoptime=_TS,
    start_station_id=_L,
    start_station_name=_S,
    start_station_latitude=_D,
    start_station_longitude=_D,
    end_station_id=_L,
    end_station_name=_S,
    end_station_latitude=_D,
    end_station_longitude=_D,
)

STATIONS = _table(
    id=_L,
    name=_S,
    latitude=_D,
    longitude=_D,
    rid=_L,
    capacity=_I,
    num_bikes_available=_I,
    num_bikes_disabled=_I,
)

TAXI = _table(
    pickup_datetime=_TS,
    dropoff_datetime=_TS,
    pickup_latitude=_D,
    pickup_longitude=_D,
    dropoff_latitude=_D,
    dropoff_longitude=_D,
    trip_distance=_D,
    travel_time=_D,
    passenger_count=_I,
    rate_code=_I,
    payment_type=_I,
    fare_amount=_D,
    extra=_D,
    mta_tax=_D,
    tip_amount=_D,
    total_amount=_D,
    tolls_amount=_D,
    imp_surcharge=_D,
)

# Columns that a source may lack: they are computed on read, or never used
# by an operator.
DERIVABLE = {"travel_time", "end_station_id", "rid", "num_bikes_disabled"}
