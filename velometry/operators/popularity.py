"""Which stations are used most, per month and time of day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velometry.functions.timeparts import FRAMES, frames_of, in_frame, in_year

PLACE = ("name", "latitude", "longitude")


def _counts(
    trips: DataFrame, keys: dict[str, Column], per_direction: bool = True
) -> DataFrame:
    """Trip ends per ``keys``, direction and station.

    Each trip is read once and yields two rows inside the scan stage, which
    the map-side count folds before anything is shuffled.
    """
    ends = trips.select(
        *(column.alias(name) for name, column in keys.items()),
        F.stack(
            F.lit(2),
            F.lit("start"),
            F.col("start_station_name"),
            F.col("start_station_latitude"),
            F.col("start_station_longitude"),
            F.lit("end"),
            F.col("end_station_name"),
            F.col("end_station_latitude"),
            F.col("end_station_longitude"),
        ).alias("direction", *PLACE),
    )
    side = ["direction"] if per_direction else []
    return ends.groupBy(*keys, *side, *PLACE).agg(F.count(F.lit(1)).alias("count"))


def station_activity(
    trips: DataFrame,
    year: int | None = None,
    frame: str | None = None,
    per_direction: bool = True,
) -> DataFrame:
    """Trip starts and trip ends per year, month and station.

    Month and year are those of the return, the hour of a ``frame`` is that of
    the start.  Starts and ends of a station are separate rows; with
    ``per_direction=False`` they are added up.
    """
    if year is not None:
        trips = trips.filter(in_year("stoptime", year))
    if frame is not None:
        trips = trips.filter(in_frame(F.hour("starttime"), frame))
    keys = {"year": F.year("stoptime"), "month": F.month("stoptime")}
    return _counts(trips, keys, per_direction).drop("direction")


def _ranked(counts: DataFrame, k: int, *within: str) -> DataFrame:
    # A rank bound lets Spark keep only k places per group before the shuffle.
    order = Window.partitionBy(*within).orderBy(F.col("count").desc())
    return counts.withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= k)


def monthly_peak(activity: DataFrame) -> DataFrame:
    """The busiest station rows of each month; ties are all kept."""
    return _ranked(activity, 1, "year", "month").drop("rank")


def top_stations(
    trips: DataFrame,
    year: int | None = None,
    frame: str | Sequence[str] = tuple(FRAMES),
    k: int = 10,
    per_direction: bool = True,
) -> DataFrame:
    """Stations of rank ``k`` or better per month and time frame; ties are kept.

    Several frames, and all years when ``year`` is None, come from one scan.
    """
    if year is not None:
        trips = trips.filter(in_year("stoptime", year))
    hour = F.hour("starttime")
    if isinstance(frame, str):
        trips = trips.filter(in_frame(hour, frame)).withColumn("frame", F.lit(frame))
    else:
        trips = trips.withColumn("frame", F.explode(frames_of(hour)))
        if set(frame) != set(FRAMES):
            trips = trips.filter(F.col("frame").isin(*frame))
    keys = {"year": F.year("stoptime"), "frame": F.col("frame"), "month": F.month("stoptime")}
    counts = _counts(trips, keys, per_direction).drop("direction")
    return _ranked(counts, k, "year", "frame", "month")


def hourly_activity(trips: DataFrame, year: int | None = None) -> DataFrame:
    """Trip starts and ends per year, month, start hour, direction and station.

    Small enough to store: the two functions below answer from it what
    ``station_activity`` and ``top_stations`` answer from the trips.
    """
    if year is not None:
        trips = trips.filter(in_year("stoptime", year))
    keys = {
        "year": F.year("stoptime"),
        "month": F.month("stoptime"),
        "hour": F.hour("starttime"),
    }
    return _counts(trips, keys)


def merge_hourly(*parts: DataFrame) -> DataFrame:
    """``hourly_activity`` of all trips out of those of parts of them, in any number."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    keys = ("year", "month", "hour", "direction", *PLACE)
    return whole.groupBy(*keys).agg(F.sum("count").alias("count"))


def activity_from_hourly(hourly: DataFrame) -> DataFrame:
    """``station_activity`` out of ``hourly_activity``."""
    keys = ("year", "month", "direction", *PLACE)
    return hourly.groupBy(*keys).agg(F.sum("count").alias("count")).drop("direction")


def top_from_hourly(hourly: DataFrame, k: int = 10) -> DataFrame:
    """``top_stations`` out of ``hourly_activity``."""
    framed = hourly.withColumn("frame", F.explode(frames_of("hour")))
    keys = ("year", "frame", "month", "direction", *PLACE)
    counts = framed.groupBy(*keys).agg(F.sum("count").alias("count")).drop("direction")
    return _ranked(counts, k, "year", "frame", "month")
