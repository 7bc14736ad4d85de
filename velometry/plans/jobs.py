"""Whole jobs: read the input tables, write the result tables.

A result that several later steps use is written first and read back, so a
lost executor never sends a later step back to the raw trips.

``reading`` are the options of ``read_trips`` and ``read_taxi``: ``formats``, ``bad``, ``zone``
and ``max_refused``.  With ``bad="refuse"`` a typed copy of each input stays in ``sifted``, and
``refused_cells`` reads the rows that could not be read from there.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velometry.operators import balance, duration, placement, popularity, supply, taxi
from velometry.operators.stations import active_stations
from velometry.sources import (
    path_exists,
    read_stations,
    read_table,
    read_taxi,
    read_trips,
    replace_partitions,
    write_buckets,
    write_table,
)


def _stored(df: DataFrame, path: str, partition_by: str, owned: list | None = None) -> DataFrame:
    replace_partitions(df, path, [partition_by], owned)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _options(reading: dict, out: str, table: str) -> dict:
    if reading.get("bad") != "refuse":
        return reading
    return reading | {"refused_to": f"{out}/sifted/{table}"}


def _trips(
    spark: SparkSession, path: str | list[str], out: str, fmt: str, reading: dict
) -> DataFrame:
    return read_trips(spark, path, fmt, **_options(reading, out, "trips"))


def _docks(spark: SparkSession, path: str, out: str, fmt: str, reading: dict) -> DataFrame:
    options = _options(reading, out, "stations")
    known = {k: v for k, v in options.items() if k in ("bad", "refused_to", "max_refused")}
    return read_stations(spark, path, fmt, **known)


def popularity_tables(
    spark: SparkSession,
    trips: str,
    out: str,
    year: int | None = None,
    fmt: str = "parquet",
    **reading,
) -> None:
    """``monthly_peak`` by year and ``top_stations`` by year and frame.

    The trips are read once, for ``hourly_activity``.  A run for a year replaces all
    that the folder holds of that year and leaves other years; one without a year
    replaces everything.  A folder of ``add_trip_files`` is refused.
    """
    if path_exists(spark, f"{out}/activity_batches"):
        raise ValueError(f"{out} grows by files; add them or take another folder")
    hourly = popularity.hourly_activity(_trips(spark, trips, out, fmt, reading), year)
    _write_popularity(hourly, out, None if year is None else [year])


def _write_popularity(hourly: DataFrame, out: str, years: list | None) -> None:
    hourly = _stored(hourly, f"{out}/hourly_activity", "year", years)
    if years is not None:
        hourly = hourly.filter(_in_years(years))
    peak = popularity.monthly_peak(popularity.activity_from_hourly(hourly))
    replace_partitions(peak, f"{out}/monthly_peak", ["year"], years)
    top = popularity.top_from_hourly(hourly)
    replace_partitions(top, f"{out}/top_stations", ["year", "frame"], years)


def _in_years(years: list) -> Column:
    named = F.col("year").isin(*(y for y in years if y is not None))
    return F.coalesce(named, F.lit(False)) | (F.col("year").isNull() & F.lit(None in years))


def add_trip_files(
    spark: SparkSession, trips: str, out: str, fmt: str = "parquet", **reading
) -> list[str]:
    """Count the files under ``trips`` that ``out`` has not counted yet; returns them.

    Only those files are read.  Their counts are one batch of ``activity_batches``, and the
    tables of ``popularity_tables`` are made again from all batches, for the years that the
    batch has.  ``counted_files`` records the files last of all: after a run that failed the
    next one counts its files again and leaves the unrecorded batch out.  A file is known
    by its path, so new contents under an old path are not seen.
    """
    recorded, path = f"{out}/counted_files", f"{out}/activity_batches"
    whole_runs = path_exists(spark, f"{out}/hourly_activity") and not path_exists(spark, path)
    if whole_runs:
        raise ValueError(f"{out} was filled by whole runs; add files to another folder")
    known, batches = set(), []
    if path_exists(spark, recorded):
        rows = spark.read.schema("file string, batch string").parquet(recorded).collect()
        known, batches = {r.file for r in rows}, sorted({r.batch for r in rows})
    new = sorted(set(read_table(spark, trips, fmt).inputFiles()) - known)
    if not new:
        return []
    batch = "b" + hashlib.sha256("\n".join(new).encode()).hexdigest()[:16]
    # A listing has escaped addresses; a scan takes patterns of plain ones.
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in new]
    counts = popularity.hourly_activity(_trips(spark, paths, out, fmt, reading))
    columns = counts.columns
    counts = counts.withColumn("batch", F.lit(batch))
    replace_partitions(counts, path, ["batch", "year"], [batch])
    stored = spark.read.schema(counts.schema).parquet(path)
    touched = stored.filter(F.col("batch") == batch).select("year").distinct().collect()
    years = [r.year for r in touched]
    if years:
        valid = stored.filter(F.col("batch").isin(*batches, batch) & _in_years(years))
        _write_popularity(popularity.merge_hourly(valid.select(*columns)), out, years)
    files = spark.createDataFrame([(f, batch) for f in new], "file string, batch string")
    write_table(files, recorded, mode="append", single_file=True)
    return new


def station_tables(
    spark: SparkSession, trips: str, stations: str, out: str, fmt: str = "parquet", **reading
) -> None:
    """``active_stations``."""
    docks = _docks(spark, stations, out, fmt, reading)
    active = active_stations(docks, _trips(spark, trips, out, fmt, reading))
    write_table(active, f"{out}/active_stations")


def balance_tables(
    spark: SparkSession,
    trips: str,
    stations: str,
    out: str,
    fmt: str = "parquet",
    buckets: int | None = None,
    **reading,
) -> None:
    """``hourly_net_flow``, ``shortage_hours``, ``overload_hours``, ``hourly_stock``
    and ``nearby_supply``, each by date.

    With ``buckets`` the flow is also stored by station, in that many buckets
    (``flow_by_station``), and the days and joins on stations read it without a shuffle.
    """
    docks = _docks(spark, stations, out, fmt, reading)
    flow = balance.hourly_net_flow(_trips(spark, trips, out, fmt, reading))
    if buckets is not None:
        flow = write_buckets(flow, f"{out}/flow_by_station", ["name"], buckets)
        replace_partitions(flow, f"{out}/hourly_net_flow", ["date"])
    else:
        flow = _stored(flow, f"{out}/hourly_net_flow", "date")
    short = _stored(balance.shortage_hours(flow, docks), f"{out}/shortage_hours", "date")
    over = _stored(balance.overload_hours(flow, docks), f"{out}/overload_hours", "date")
    replace_partitions(balance.hourly_stock(short, docks), f"{out}/hourly_stock", ["date"])
    replace_partitions(supply.nearby_supply(short, over), f"{out}/nearby_supply", ["date"])


def slow_taxi_table(
    spark: SparkSession,
    trips: str,
    taxi_trips: str,
    out: str,
    year: int,
    fmt: str = "parquet",
    first: int | None = None,
    **reading,
) -> None:
    """``slow_taxi``: slow taxi trips no longer than the median bike trip of ``year``.

    ``first`` takes only that many taxi trips, the earliest.
    """
    pairs = taxi.od_pairs(_trips(spark, trips, out, fmt, reading), year)
    rides = read_taxi(spark, taxi_trips, fmt, first, **_options(reading, out, "taxi"))
    short = taxi.short_trips(rides, taxi.median_trip_miles(pairs))
    write_table(taxi.slow_trips(short), f"{out}/slow_taxi")


def placement_tables(spark: SparkSession, out: str) -> None:
    """``new_stations`` and ``taxi_clusters`` from ``slow_taxi``."""
    trips = placement.clean(spark.read.parquet(f"{out}/slow_taxi"))
    write_table(placement.recommend_stations(trips), f"{out}/new_stations", partition_by=["k"])
    clusters = placement.assign_dropoffs(placement.assign_pickups(trips, cut=False))
    write_table(clusters, f"{out}/taxi_clusters")


def duration_model(spark: SparkSession, out: str) -> dict[str, float]:
    """Fit on ``slow_taxi``, store ``duration_model``, return the validation errors.

    ``full`` is that of the stored model, with the published features, of which
    three contain the label; ``no_leak`` is that of the rest.
    """
    train, validation = duration.split(
        duration.features(spark.read.parquet(f"{out}/slow_taxi"))
    )
    model = duration.fit(train)
    model.write().overwrite().save(f"{out}/duration_model")
    honest = duration.fit(train, duration.FEATURES_NO_LEAK)
    return {
        "full": duration.evaluate(model, validation)[1],
        "no_leak": duration.evaluate(honest, validation)[1],
    }
