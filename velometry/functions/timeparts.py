"""Calendar parts, year ranges and the three time frames of a day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First and last hour of each frame.  Both ends count, so hours
# 7, 12 and 19 belong to two frames.
FRAMES = {"morning": (7, 12), "afternoon": (12, 19), "evening": (19, 7)}

# The month names offered for choice.
MONTHS = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)


def _at(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def in_year(column: str | Column, year: int) -> Column:
    """True within ``year``; a range on the raw column, so that scans can skip."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= _at(f"{year:04d}-01-01")) & (column < _at(f"{year + 1:04d}-01-01"))


def in_days(column: str | Column, first: str, last: str) -> Column:
    """True from the start of day ``first`` to the end of day ``last``."""
    column = F.col(column) if isinstance(column, str) else column
    after = date.fromisoformat(last) + timedelta(days=1)
    return (column >= _at(first)) & (column < _at(after.isoformat()))


def _hours(frame: str) -> list[int]:
    begin, end = FRAMES[frame]
    return [h for h in range(24) if (begin <= h <= end if begin <= end else h >= begin or h <= end)]


def in_frame(hour: str | Column, frame: str) -> Column:
    """True when ``hour`` lies in ``frame``."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    begin, end = FRAMES[frame]
    if begin <= end:
        return hour.between(begin, end)
    return (hour >= begin) | (hour <= end)


def frames_of(hour: str | Column) -> Column:
    """Array of the frames an hour belongs to (one constant, no branches)."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    by_hour = [[f for f in FRAMES if h in _hours(f)] for h in range(24)]
    table = F.array(*(F.array(*map(F.lit, frames)) for frames in by_hour))
    return F.element_at(table, hour + 1)


def seconds_between(begin: str | Column, end: str | Column) -> Column:
    """Whole seconds from one zone-free time to another, in every session zone."""
    begin = F.col(begin) if isinstance(begin, str) else begin
    end = F.col(end) if isinstance(end, str) else end
    return (end - begin).cast("interval second").cast("bigint")


def month_name(month: str | Column) -> Column:
    """January for 1, and so on."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")


def month_number(name: str | Column) -> Column:
    """1 for January, and so on; null for any other text."""
    name = F.col(name) if isinstance(name, str) else name
    position = F.array_position(F.array(*map(F.lit, MONTHS)), name)
    return F.nullif(position, F.lit(0)).cast("int")


def with_trip_parts(trips: DataFrame) -> DataFrame:
    """Add the date and hour of both ends, and month and year of the return."""
    return trips.withColumns(
        {
            "start_date": F.col("starttime").cast("date"),
            "start_hour": F.hour("starttime"),
            "end_date": F.col("stoptime").cast("date"),
            "end_hour": F.hour("stoptime"),
            "month": F.month("stoptime"),
            "year": F.year("stoptime"),
        }
    )
