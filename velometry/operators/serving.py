"""Lookups on the result tables, as the views of the three questions need them.

Each takes a result table, best read from Parquet partitioned by the column it
filters on, and returns a small DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velometry.functions.timeparts import MONTHS, month_name
from velometry.operators.placement import LABELS
from velometry.operators.stations import locations


def _day(date: str):
    return F.col("date") == F.lit(date).cast("date")


# --- popularity ---------------------------------------------------------------


def peak_trend(peak: DataFrame, year: int | None = None) -> DataFrame:
    """Peak count by month, of one year or of all, in order."""
    if year is not None:
        peak = peak.filter(F.col("year") == year)
    named = peak.select(
        "year", "month", month_name("month").alias("month_name"), "name", "latitude", "longitude", "count"
    )
    return named.orderBy("year", "month", "name")


def top_stations_for(top: DataFrame, year: int, month: int | str, frame: str) -> DataFrame:
    """The ranked stations of one month and frame; the month as number or name."""
    if isinstance(month, str):
        month = MONTHS.index(month) + 1
    return top.filter(
        (F.col("year") == year) & (F.col("frame") == frame.lower()) & (F.col("month") == month)
    )


def count_range(peak: DataFrame) -> DataFrame:
    """Axis range for the counts: from the least to the greatest, zero included."""
    return peak.agg(
        F.least(F.lit(0), F.min("count")).alias("low"),
        F.greatest(F.lit(0), F.max("count")).alias("high"),
    )


# --- balance ------------------------------------------------------------------


def stations_on(hours: DataFrame, date: str) -> DataFrame:
    """Names in a shortage or overload table on a date, in order."""
    return hours.filter(_day(date)).select("name").distinct().orderBy("name")


def first_station_on(hours: DataFrame, date: str) -> DataFrame:
    """The default choice among ``stations_on``."""
    return hours.filter(_day(date)).agg(F.min("name").alias("name")).filter("name is not null")


def station_location(stations: DataFrame, name: str) -> DataFrame:
    """Name and place of a station; of several, that of the smallest id."""
    return locations(stations.filter(F.col("name") == name))


def all_stations(stations: DataFrame) -> DataFrame:
    """Name and place of every station."""
    return stations.select("name", "longitude", "latitude")


def hourly_stock_for(stock: DataFrame, date: str, name: str) -> DataFrame:
    """Stock by hour of one station on one date; empty if it was not short."""
    return stock.filter(_day(date) & (F.col("name") == name)).orderBy("hour")


def map_points(shortage: DataFrame, overload: DataFrame, stations: DataFrame, date: str) -> DataFrame:
    """Short and overloaded stations of a date with their place and kind."""
    kinds = [
        hours.filter(_day(date)).select("name").distinct().withColumn("kind", F.lit(kind))
        for kind, hours in (("short", shortage), ("overload", overload))
    ]
    return (
        kinds[0]
        .unionByName(kinds[1])
        .join(locations(stations), "name")
        .select("name", "kind", "latitude", "longitude")
    )


# --- supply and placement -----------------------------------------------------


def nearby_supply_for(
    nearby: DataFrame, date: str, hour: int, name: str, n: int = 5
) -> DataFrame:
    """The first ``n`` supply stations for one date, hour and short station."""
    chosen = nearby.filter(
        _day(date) & (F.col("hour") == hour) & (F.col("start_station_name") == name)
    )
    return chosen.withColumn("nearby_stations", F.slice("nearby_stations", 1, n))


def new_stations(recommended: DataFrame, k: int | str) -> DataFrame:
    """Recommended places for one size, given as number or published label."""
    size = LABELS[k] if isinstance(k, str) else k
    return recommended.filter(F.col("k") == size).select("longitude", "latitude")
