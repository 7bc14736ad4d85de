"""Short taxi trips in slow traffic: rides a bike could replace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velometry.functions.geo import MILES_PER_KM, great_circle_km
from velometry.functions.quantile import quantile
from velometry.functions.sketch import quantile_from, sketches
from velometry.functions.timeparts import in_year

_PAIR = (
    "start_station_name",
    "end_station_name",
    "start_station_latitude",
    "start_station_longitude",
    "end_station_latitude",
    "end_station_longitude",
)


def od_pairs(trips: DataFrame, year: int | None = None, round_km: bool = True) -> DataFrame:
    """Origin-destination pairs with their number of trips and distance ``dist``.

    ``year`` is that of the start.  Distances are whole kilometres unless
    ``round_km`` is off; the column's metadata say so, for the median.
    """
    if year is not None:
        trips = trips.filter(in_year("starttime", year))
    km = great_circle_km(
        "start_station_latitude",
        "start_station_longitude",
        "end_station_latitude",
        "end_station_longitude",
        method="cosine",
    )
    return (
        trips.groupBy(*_PAIR)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("dist", F.round(km) if round_km else km)
        .withMetadata("dist", {"whole_km": round_km})
    )


def median_trip_miles(
    od: DataFrame,
    weighted: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """Median distance over the pairs, in miles: one row, column ``miles``.

    Each pair counts once; with ``weighted`` it counts once per trip.
    ``accuracy`` takes a sketch instead of the exact value.
    """
    weight = F.col("count") if weighted else None
    whole = od.schema["dist"].metadata.get("whole_km", False)
    median = quantile(od, "dist", 0.5, weight, whole, accuracy)
    return median.select((F.col("quantile") * MILES_PER_KM).alias("miles"))


def _scalar(value: DataFrame | float) -> Column:
    # A one-row frame becomes a scalar subquery: it is part of the plan, runs
    # once, and its value reaches the scan as a filter.
    return value.scalar() if isinstance(value, DataFrame) else F.lit(float(value))


def short_trips(taxi: DataFrame, limit_miles: DataFrame | float) -> DataFrame:
    """Trips below ``limit_miles`` (a number or a one-row frame) with all coordinates."""
    return taxi.filter(F.col("trip_distance") < _scalar(limit_miles)).dropna(
        subset=[
            "pickup_latitude",
            "pickup_longitude",
            "dropoff_latitude",
            "dropoff_longitude",
        ]
    )


def with_velocity(taxi: DataFrame) -> DataFrame:
    """Add miles per second; null for trips that took no time."""
    return taxi.withColumn("velocity", F.try_divide("trip_distance", "travel_time"))


def velocity_sketches(short: DataFrame) -> DataFrame:
    """``sketches`` of velocity by ``year`` of pickup, to be stored and added to."""
    year = F.year("pickup_datetime").alias("year")
    return sketches(with_velocity(short), "velocity", [year])


def slow_trips(
    short: DataFrame,
    q: float = 0.2,
    accuracy: int | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Trips at or below the quantile ``q`` of velocity, with their velocity.

    The exact quantile reads the trips twice; ``accuracy`` takes a sketch, which
    reads them once.  ``stored`` are ``velocity_sketches`` that the quantile is taken
    from instead; they may cover more years than ``short``.
    """
    moving = with_velocity(short)
    if stored is not None:
        limit = quantile_from(stored, q)
    else:
        limit = quantile(moving, "velocity", q, accuracy=accuracy)
    return moving.filter(F.col("velocity") <= limit.scalar())
