"""The station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = (
    "id",
    "name",
    "latitude",
    "longitude",
    "capacity",
    "num_bikes_available",
    "num_bikes_disabled",
)


def start_counts(trips: DataFrame) -> DataFrame:
    """Trip starts per station id, name and coordinates."""
    keys = (
        "start_station_id",
        "start_station_name",
        "start_station_longitude",
        "start_station_latitude",
    )
    return trips.groupBy(*keys).agg(F.count("start_station_name").alias("starts"))


def active_stations(stations: DataFrame, trips: DataFrame) -> DataFrame:
    """Stations at whose name some trip starts, each once.

    The names are made distinct before they meet the stations, so the join
    sees a few thousand rows however many trips there are.
    """
    names = trips.select(F.col("start_station_name").alias("name")).distinct()
    return stations.select(*COLUMNS).join(names, "name", "left_semi").select(*COLUMNS)


def locations(stations: DataFrame) -> DataFrame:
    """One place per station name; of several, that of the smallest id."""
    place = F.min_by(F.struct("latitude", "longitude"), "id").alias("place")
    return stations.groupBy("name").agg(place).select("name", "place.latitude", "place.longitude")
