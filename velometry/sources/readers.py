"""Typed scans of the three input tables.

Columns are matched by name, so an extra index column, another column order
or extra columns in the file do no harm, and only what a plan uses is read.
No schema is inferred: that would cost a pass over the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velometry.functions.numbering import numbered
from velometry.functions.quantile import nth_place
from velometry.functions.timeparts import seconds_between
from velometry.schemas import DERIVABLE, STATIONS, TAXI, TRIPS
from velometry.sources.writers import cut_lineage, write_table

# Names of the station feed that differ from ours.
STATION_RENAMES = {"station_id": "id", "region_id": "rid"}


_EPOCH = "1970-01-01 00:00:00"
# Stands for a missing time in counts: before every second that a time can hold.
_NO_TIME = -9e11


def _epoch() -> Column:
    return F.lit(_EPOCH).cast("timestamp_ntz")


def _wall_clock(instant: Column) -> Column:
    """The UTC clock at an instant, whatever the zone of the session."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return _epoch() + F.make_dt_interval(secs=seconds)


def _time(text: Column, formats: Sequence[str]) -> Column:
    """A zone-free time in the first of ``formats`` that fits, or else in ISO form."""
    session = SparkSession.active()
    if session.conf.get("spark.sql.timestampType") == "TIMESTAMP_NTZ":
        parsed = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    else:
        # Parsed as if in UTC and read off in UTC, no hour is skipped.
        parsed = [
            _wall_clock(F.try_to_timestamp(F.concat(text, F.lit(" UTC")), F.lit(f"{f} VV")))
            for f in formats
        ]
    return F.coalesce(*parsed, text.try_cast("timestamp_ntz"))


# Why a cell of a type cannot be read.
_NOT_A = {
    T.TimestampNTZType: "not a time",
    T.LongType: "not a whole number in range",
    T.IntegerType: "not a whole number in range",
    T.DoubleType: "not a number",
}


def _typed(
    name: str,
    have: T.DataType,
    want: T.DataType,
    formats: Sequence[str],
    zone: str | None,
) -> tuple[Column, Column | None]:
    """The typed column, and when its cell cannot be read (None: each one can)."""
    column = F.col(f"`{name}`")
    if have == want:
        return column, None
    if isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType):
        if zone is None:
            raise ValueError(f"{name} is an instant; name the city's zone to get its clock")
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), _wall_clock(column)), None
    if not isinstance(have, T.StringType):
        return column.cast(want), None
    if isinstance(want, T.TimestampNTZType):
        read = _time(column, formats)
    elif isinstance(want, T.IntegralType):
        # Text written from a frame with gaps prints 72 as "72.0".
        read = column.try_cast("decimal(24,4)").try_cast(want)
    else:
        read = column.try_cast(want)
    return read, column.isNotNull() & read.isNull()


def _columns(
    df: DataFrame, schema: T.StructType, formats: Sequence[str], zone: str | None
) -> dict[str, tuple[Column, Column | None]]:
    """``_typed`` of each column of ``schema``; those that no operator needs may be absent."""
    have = {f.name: f.dataType for f in df.schema.fields}
    absent = [f.name for f in schema.fields if f.name not in have and f.name not in DERIVABLE]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return {
        f.name: (
            _typed(f.name, have[f.name], f.dataType, formats, zone)
            if f.name in have
            else (F.lit(None).cast(f.dataType), None)
        )
        for f in schema.fields
    }


def conform(
    df: DataFrame,
    schema: T.StructType,
    renames: dict[str, str] | None = None,
    bad: str = "error",
    formats: Sequence[str] = (),
    zone: str | None = None,
) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``.

    A text cell that cannot be read is an error, or null with ``bad="null"``;
    ``sifted`` keeps such rows apart.  Text times are tried in ``formats`` (Spark's
    patterns, such as ``M/d/yyyy HH:mm:ss``) and then in ISO form.  Times that are
    instants are refused unless ``zone`` names the city's zone.  A missing column is
    an error, except for the few that no operator needs.
    """
    if bad not in ("error", "null"):
        raise ValueError("bad must be 'error' or 'null'")
    df = df.withColumnsRenamed(renames or {})
    found = []
    for name, (read, unread) in _columns(df, schema, formats, zone).items():
        if unread is not None and bad == "error":
            message = F.concat(F.lit(f"unreadable {name}: "), F.col(f"`{name}`"))
            error = F.raise_error(message).cast(schema[name].dataType)
            read = F.when(unread, error).otherwise(read)
        found.append(read.alias(name))
    return df.select(*found)


def sifted(
    df: DataFrame,
    schema: T.StructType,
    renames: dict[str, str] | None = None,
    formats: Sequence[str] = (),
    zone: str | None = None,
) -> DataFrame:
    """``conform`` with a further column, ``refusal``: null for a row that can be read.

    For one with cells that cannot it holds the ``file``, the whole row as JSON (``row``),
    and the ``column``, ``cell`` and ``reason`` of each such cell (``cells``).
    """
    raw = list(df.columns)
    df = df.withColumnsRenamed(renames or {})
    columns = _columns(df, schema, formats, zone)
    cells = [
        F.when(
            unread,
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"`{name}`").alias("cell"),
                F.lit(_NOT_A[type(schema[name].dataType)]).alias("reason"),
            ),
        )
        for name, (_, unread) in columns.items()
        if unread is not None
    ]
    none = F.lit(None).cast("array<struct<column: string, cell: string, reason: string>>")
    refused = F.array_compact(F.array(*cells)) if cells else none
    whole = F.struct(*(F.col(f"`{new}`").alias(old) for old, new in zip(raw, df.columns)))
    refusal = F.struct(
        F.nullif(F.input_file_name(), F.lit("")).alias("file"),
        F.to_json(whole).alias("row"),
        F.col("__cells").alias("cells"),
    )
    typed = [read.alias(name) for name, (read, _) in columns.items()]
    return df.withColumn("__cells", refused).select(
        *typed, F.when(F.size("__cells") > 0, refusal).alias("refusal")
    )


def sift(
    df: DataFrame,
    schema: T.StructType,
    path: str,
    max_refused: float,
    renames: dict[str, str] | None = None,
    formats: Sequence[str] = (),
    zone: str | None = None,
) -> DataFrame:
    """The rows of ``df`` that can be read, by one scan that stores both kinds in ``path``.

    Later steps read the typed copy there and not ``df``; ``refused_cells`` reads the rest.
    If more than the share ``max_refused`` of all rows is refused, that is an error, and
    the stored rows stay for inspection.  A CSV row with too few cells is one with nulls, as
    everywhere in Spark.
    """
    kept = F.col("refusal").isNull().alias("accepted")
    both = sifted(df, schema, renames, formats, zone)
    write_table(
        both.select("*", kept), path, partition_by=["accepted"], replace_all=True, rebalance=False
    )
    rows = _sifted_table(df.sparkSession, path, both.schema)
    refused = rows.filter("not accepted").count()
    total = refused + rows.filter("accepted").count()
    if refused > max_refused * total:
        raise ValueError(f"{refused} of {total} rows cannot be read; see {path}")
    return rows.filter("accepted").select(*schema.fieldNames())


def _sifted_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("accepted", T.BooleanType())])
    return spark.read.schema(whole).parquet(path)


_REFUSAL = (
    "refusal struct<file: string, row: string, "
    "cells: array<struct<column: string, cell: string, reason: string>>>"
)


def refused_cells(spark: SparkSession, path: str) -> DataFrame:
    """One row per cell that ``sift`` could not read: ``file, row, column, cell, reason``."""
    schema = T.StructType.fromDDL(_REFUSAL)
    return cells_of(_sifted_table(spark, path, schema).filter("not accepted"))


def cells_of(rows: DataFrame) -> DataFrame:
    """``refused_cells`` of rows with a ``refusal``."""
    cells = rows.filter("refusal is not null").select(
        "refusal.file", "refusal.row", F.explode("refusal.cells").alias("c")
    )
    return cells.select("file", "row", "c.column", "c.cell", "c.reason")


def _conformed(
    raw: DataFrame,
    schema: T.StructType,
    renames: dict[str, str] | None = None,
    bad: str = "error",
    formats: Sequence[str] = (),
    zone: str | None = None,
    refused_to: str | None = None,
    max_refused: float = 0.01,
) -> DataFrame:
    if bad != "refuse":
        return conform(raw, schema, renames, bad, formats, zone)
    if refused_to is None:
        raise ValueError("bad='refuse' needs a folder, refused_to")
    return sift(raw, schema, refused_to, max_refused, renames, formats, zone)


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Scan ``path`` in any format Spark reads.

    CSV files carry a header, which must agree with a ``schema`` if one is given.
    """
    if fmt == "csv":
        options = {"header": "true", "enforceSchema": "false", **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_trips(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    bad: str = "error",
    formats: Sequence[str] = (),
    zone: str | None = None,
    refused_to: str | None = None,
    max_refused: float = 0.01,
    **options: str,
) -> DataFrame:
    """Bike trips, one row per ride; ``bad``, ``formats`` and ``zone`` as in ``conform``.

    With ``bad="refuse"`` rows that cannot be read are set apart in ``refused_to``, as in
    ``sift``; this reads the table at once.
    """
    raw = read_table(spark, path, fmt, **options)
    return _conformed(raw, TRIPS, None, bad, formats, zone, refused_to, max_refused)


def read_stations(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    bad: str = "error",
    refused_to: str | None = None,
    max_refused: float = 0.01,
    **options: str,
) -> DataFrame:
    """Bike stations with their capacity and a snapshot of their stock."""
    raw = read_table(spark, path, fmt, **options)
    return _conformed(
        raw, STATIONS, STATION_RENAMES, bad, refused_to=refused_to, max_refused=max_refused
    )


def project_stations(raw: DataFrame, bad: str = "error") -> DataFrame:
    """The station feed under our column names."""
    return conform(raw, STATIONS, STATION_RENAMES, bad)


def with_travel_time(taxi: DataFrame) -> DataFrame:
    """Set ``travel_time`` to the seconds from pickup to dropoff."""
    seconds = seconds_between("pickup_datetime", "dropoff_datetime")
    return taxi.withColumn("travel_time", seconds.cast("double"))


def read_taxi(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    first: int | None = None,
    bad: str = "error",
    formats: Sequence[str] = (),
    zone: str | None = None,
    refused_to: str | None = None,
    max_refused: float = 0.01,
    **options: str,
) -> DataFrame:
    """Taxi trips.  ``first`` keeps that many of them, earliest pickups first."""
    raw = read_table(spark, path, fmt, **options)
    taxi = _conformed(raw, TAXI, None, bad, formats, zone, refused_to, max_refused)
    if "travel_time" not in raw.columns:
        taxi = with_travel_time(taxi)
    return taxi if first is None else first_trips(taxi, first)


def first_trips(taxi: DataFrame, n: int) -> DataFrame:
    """The ``n`` earliest trips in order; missing pickup times come first, and equal
    ones are ordered by the other columns.

    The second of the ``n``-th trip is found by counting.  All trips before it
    are among the first, and later ones are dropped where the column is read;
    only those of that very second are numbered, over as many tasks as they need.
    """
    when = F.col("pickup_datetime")
    since = (when - _epoch()).cast("interval second").cast("decimal(18,6)")
    second = F.coalesce(F.floor(since).cast("double"), F.lit(_NO_TIME))
    place = cut_lineage(nth_place(taxi, second, n))
    # Null if the n-th trip is one without a time.
    moment = _epoch() + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
    begin = place.select(F.when(F.col("value") > _NO_TIME, moment).alias("begin")).scalar()
    # No later row of that second is dropped, and no scan starts before it.
    last = taxi.filter((when >= begin) & (second == place.select("value").scalar()))
    last = last.union(taxi.filter(when.isNull() & begin.isNull()))
    order = ["pickup_datetime", *(c for c in taxi.columns if c != "pickup_datetime")]
    last = numbered(last, order, cut_lineage, name="__place").filter(
        F.col("__place") <= place.select("left").scalar()
    )
    first = taxi.filter(when < begin).union(taxi.filter(when.isNull() & begin.isNotNull()))
    return first.union(last.select(*taxi.columns)).orderBy(*order)
