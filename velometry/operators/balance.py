"""Bikes arriving and leaving: net flow, shortage, overload, running stock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velometry.functions.timeparts import in_days

HOURLY = ("name", "date", "hour", "hourly_bike_movement", "latitude", "longitude")


def hourly_movements(trips: DataFrame, days: tuple[str, str] | None = None) -> DataFrame:
    """Departures and arrivals per station, date and hour, from one scan.

    A trip yields its two ends as two rows, and one count takes both: there is
    no second scan and no join of two large groupings.  Ends without a name or
    a time are left out.  ``days`` limits both ends to a range of dates.
    """
    if days is not None:
        trips = trips.filter(in_days("starttime", *days) | in_days("stoptime", *days))
    ends = trips.select(
        F.stack(
            F.lit(2),
            F.col("start_station_name"),
            F.col("starttime"),
            F.lit(1),
            F.lit(0),
            F.col("end_station_name"),
            F.col("stoptime"),
            F.lit(0),
            F.lit(1),
        ).alias("name", "at", "departed", "arrived")
    )
    if days is not None:
        ends = ends.filter(in_days("at", *days))
    keys = {"date": F.col("at").cast("date"), "hour": F.hour("at")}
    # The keys are null-checked here, so that a later join on them adds no
    # check of its own and every use of this count is the same shuffle.
    return (
        ends.withColumns(keys)
        .filter(F.col("name").isNotNull() & F.col("date").isNotNull() & F.col("hour").isNotNull())
        .groupBy("name", *keys)
        .agg(F.sum("departed").alias("departures"), F.sum("arrived").alias("arrivals"))
    )


def hourly_departures(trips: DataFrame) -> DataFrame:
    """Trip starts per station, date and hour."""
    return _one_sided(trips, "start_station_name", "starttime", "departures")


def hourly_arrivals(trips: DataFrame) -> DataFrame:
    """Trip ends per station, date and hour."""
    return _one_sided(trips, "end_station_name", "stoptime", "arrivals")


def _one_sided(trips: DataFrame, name: str, at: str, count: str) -> DataFrame:
    return trips.filter(F.col(name).isNotNull()).groupBy(
        F.col(name).alias("name"), F.col(at).cast("date").alias("date"), F.hour(at).alias("hour")
    ).agg(F.count(F.lit(1)).alias(count))


def hourly_net_flow(
    trips: DataFrame, how: str = "inner", days: tuple[str, str] | None = None
) -> DataFrame:
    """Arrivals minus departures per station, date and hour, without zeros.

    ``inner`` keeps hours that saw both an arrival and a departure; ``full``
    keeps those with only one of them too.
    """
    if how not in ("inner", "full"):
        raise ValueError(f"how must be inner or full, not {how}")
    moves = hourly_movements(trips, days)
    if how == "inner":
        moves = moves.filter((F.col("departures") > 0) & (F.col("arrivals") > 0))
    net = F.col("arrivals") - F.col("departures")
    return moves.select("name", "date", "hour", net.alias("hourly_bike_movement")).filter(
        F.col("hourly_bike_movement") != 0
    )


def daily_net_flow(hourly: DataFrame) -> DataFrame:
    """Sum of the hourly net flow per station and date."""
    return hourly.groupBy("name", "date").agg(F.sum("hourly_bike_movement").alias("bike_movement"))


def _filled(capacity: str) -> Column:
    """Share of ``capacity`` filled after the day; null if it is zero.

    The stock is one snapshot per station, used for every day.
    """
    return F.try_divide(F.col("num_bikes_available") + F.col("bike_movement"), F.col(capacity))


def _short(days: DataFrame, stations: DataFrame, threshold: float) -> DataFrame:
    return (
        days.filter(F.col("bike_movement") < 0)
        .join(stations, "name")
        .withColumn("filled_rate", _filled("num_bikes_available"))
        .filter(F.col("filled_rate") <= threshold)
    )


def _over(days: DataFrame, stations: DataFrame, threshold: float) -> DataFrame:
    return (
        days.filter(F.col("bike_movement") > 0)
        .join(stations, "name")
        .withColumn("filled_rate", _filled("capacity"))
        .filter(F.col("filled_rate") >= threshold)
    )


_DAY = ("name", "date", "bike_movement", "filled_rate", "latitude", "longitude")


def shortage_days(hourly: DataFrame, stations: DataFrame, threshold: float = 0.001) -> DataFrame:
    """Station-days that lose (nearly) all bikes available."""
    return _short(daily_net_flow(hourly), stations, threshold).select(*_DAY)


def overload_days(hourly: DataFrame, stations: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Station-days that fill the station's capacity."""
    return _over(daily_net_flow(hourly), stations, threshold).select(*_DAY)


def _with_day(hourly: DataFrame) -> DataFrame:
    # The day's sum next to its hours: one shuffle, and no join back.
    day = Window.partitionBy("name", "date")
    return hourly.withColumn("bike_movement", F.sum("hourly_bike_movement").over(day))


def shortage_hours(hourly: DataFrame, stations: DataFrame, threshold: float = 0.001) -> DataFrame:
    """Every hour with movement on the days of ``shortage_days``."""
    return _short(_with_day(hourly), stations, threshold).select(*HOURLY)


def overload_hours(hourly: DataFrame, stations: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Every hour with movement on the days of ``overload_days``."""
    return _over(_with_day(hourly), stations, threshold).select(*HOURLY)


def hourly_stock(
    shortage: DataFrame, stations: DataFrame, hours: int = 24, threshold: float = 0.001
) -> DataFrame:
    """Stock of each short station for every hour of the day.

    The stock opens at the bikes available and follows the net flow; an hour
    is short when at most ``threshold`` of the opening stock is left.  Charts
    of hours 0 to 22 ask for ``hours=23``.

    An hour with movement stands for itself and the quiet hours up to the next
    one, the first also for those before it, so the gaps need no join.
    """
    by_hour = Window.partitionBy("name", "date").orderBy("hour")
    # Of several rows for one hour, which only a station listed twice gives,
    # the first counts.
    flow = F.when(F.col("previous") == F.col("hour"), 0).otherwise(F.col("hourly_bike_movement"))
    opening = stations.groupBy("name").agg(F.min_by("num_bikes_available", "id").alias("opening"))
    spans = (
        shortage.select("name", "date", "hour", "hourly_bike_movement")
        .withColumn("previous", F.lag("hour").over(by_hour))
        .withColumns(
            {
                "moved": F.sum(flow).over(by_hour.rowsBetween(Window.unboundedPreceding, 0)),
                "begin": F.when(F.col("previous").isNull(), 0).otherwise(F.col("hour")),
                "end": F.least(F.lead("hour", 1, hours).over(by_hour), F.lit(hours)) - 1,
            }
        )
        .filter(F.col("begin") <= F.col("end"))
    )
    stock = F.col("opening") + F.when(F.col("at") < F.col("hour"), 0).otherwise(F.col("moved"))
    return (
        spans.withColumn("at", F.explode(F.sequence("begin", "end")))
        .join(opening, "name")
        .select("name", "date", F.col("at").alias("hour"), stock.alias("stock"), "opening")
        .withColumn(
            "is_short",
            F.coalesce(F.try_divide("stock", "opening") <= threshold, F.lit(False)),
        )
        .drop("opening")
    )
