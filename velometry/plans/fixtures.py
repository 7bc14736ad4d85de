"""The three input tables, derived row by row from the synthetic star schema.

Every derivation is a projection: no rows are dropped and nothing is joined,
so the tables are as large as the ones they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velometry.sources.readers import project_stations, read_table

_EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
_NATION = "n_nationkey int, n_name string, n_regionkey int"
_LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)

# Parameters of the named queries.
POPULAR_YEAR = 1996
BIKE_YEAR = 2024
DAY = "2024-01-19"
HOUR = 15
STATION = "NATION_16"


def _scan(spark: SparkSession, sf_dir: str, table: str, schema: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{table}.parquet", schema=schema)


def station_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a station feed, under the feed's own column names."""
    return _scan(spark, sf_dir, "nation", _NATION).selectExpr(
        "n_nationkey as station_id",
        "n_name as name",
        "(40700 + 12 * n_nationkey) / 1000d as latitude",
        "(-74000 + 7 * ((n_nationkey * 3) % 10)) / 1000d as longitude",
        "n_regionkey as region_id",
        "n_nationkey % 3 + n_nationkey % 4 as capacity",
        "n_nationkey % 3 as num_bikes_available",
        "n_nationkey % 2 as num_bikes_disabled",
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_stations(station_feed(spark, sf_dir))


def _with_ends(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    for side in ("start", "end"):
        key = F.col(f"{side}_station_id")
        df = df.withColumns(
            {
                f"{side}_station_name": F.concat(F.lit(prefix), key.cast("string")),
                f"{side}_station_latitude": F.expr(lat.format(f"{side}_station_id")),
                f"{side}_station_longitude": F.expr(lon.format(f"{side}_station_id")),
            }
        )
    return df


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bike trips between nations: one month, all hours.

    Starts are spread evenly and ends lean to low keys, so that some stations
    overflow while others run short.
    """
    rides = _scan(spark, sf_dir, "events", _EVENTS).selectExpr(
        "ts as starttime",
        "ts + make_dt_interval(0, 0, cast(value as int), 0) as stoptime",
        "user_id % 23 as start_station_id",
        "least(event_id % 23, (event_id * 7 + 3) % 25) as end_station_id",
    )
    return _with_ends(
        rides,
        "(40700 + 12 * {0}) / 1000d",
        "(-74000 + 7 * (({0} * 3) % 10)) / 1000d",
        "NATION_",
    )


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with an hour of the day, which their dates lack."""
    hour = "(l_orderkey * 7 + l_linenumber * 5) % 24"
    return _scan(spark, sf_dir, "lineitem", _LINEITEM).withColumn(
        "at", F.expr(f"l_shipdate + make_dt_interval(0, cast({hour} as int), 0, 0)")
    )


def trips_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as bike trips over several years; suppliers are the stations."""
    rides = _line_items(spark, sf_dir).selectExpr(
        "at as starttime",
        "at + make_dt_interval(0, 0, cast(l_quantity as int), 0) as stoptime",
        "l_suppkey as start_station_id",
        "l_partkey div 20 as end_station_id",
    )
    return _with_ends(
        rides, "(407000 + 6 * {0}) / 10000d", "(-740000 + 3 * {0}) / 10000d", "ST"
    )


def taxi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as taxi trips; about one in seven lacks a pickup latitude."""
    rides = _line_items(spark, sf_dir).withColumn(
        "travel_time", F.expr("cast(60 + (l_partkey * 13 + l_orderkey * 7) % 3600 as double)")
    )
    return rides.selectExpr(
        "at as pickup_datetime",
        "at + make_dt_interval(0, 0, 0, cast(travel_time as int)) as dropoff_datetime",
        "case when l_linenumber = 7 then null else "
        "(40660 + (l_orderkey * 31 + l_linenumber) % 180) / 1000d end "
        "as pickup_latitude",
        "(-74110 + (l_partkey * 17) % 200) / 1000d as pickup_longitude",
        "(40660 + (l_suppkey * 53 + l_linenumber) % 180) / 1000d as dropoff_latitude",
        "(-74110 + (l_orderkey * 19) % 200) / 1000d as dropoff_longitude",
        "l_quantity / 5d as trip_distance",
        "travel_time",
        "l_linenumber as passenger_count",
        "cast(1 + l_orderkey % 3 as int) as rate_code",
        "cast(1 + l_partkey % 2 as int) as payment_type",
        "l_extendedprice / 1000d as fare_amount",
        "l_discount as extra",
        "0.5d + 0.1d * (l_suppkey % 2) as mta_tax",
        "l_tax as tip_amount",
        "l_extendedprice / 1000d + l_tax + l_discount as total_amount",
        "cast(l_suppkey % 3 as double) as tolls_amount",
        "0.3d * (l_partkey % 2) as imp_surcharge",
    )


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations of one day: a third of them at hour 9, the rest at 10."""
    customers = read_table(spark, f"{sf_dir}/customer.parquet")
    return customers.selectExpr(
        "cast(c_custkey as bigint) as id",
        "concat('C', c_custkey) as name",
        f"cast('{DAY}' as date) as date",
        "case when c_custkey % 3 = 0 then 9 else 10 end as hour",
        "1L as hourly_bike_movement",
        "(40700000 + (c_custkey * 7919) % 20011) / 1000000d as latitude",
        "(-74000000 + (c_custkey * 4729) % 30011) / 1000000d as longitude",
    )


def dense_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crowded hours of short stations, some 2 km across."""
    return _days(spark, sf_dir).filter("id % 2 = 0").drop("id")


def dense_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overloaded stations of the same hours."""
    return _days(spark, sf_dir).filter("id % 2 = 1").drop("id")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as taxi trips between four small zones far from each other."""
    return _line_items(spark, sf_dir).selectExpr(
        "l_orderkey % 4 as zone",
        "(407000 + 300 * (l_orderkey % 4) + l_partkey % 7) / 10000d as pickup_latitude",
        "(-740000 + 300 * ((l_orderkey * 3) % 4) + l_suppkey % 5) / 10000d as pickup_longitude",
        "(407000 + 300 * (l_partkey % 4) + l_orderkey % 7) / 10000d as dropoff_latitude",
        "(-740000 + 300 * ((l_partkey * 3) % 4) + l_linenumber % 5) / 10000d as dropoff_longitude",
    )


def text_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trips`` to the second, as text: day first in one time, ISO in the other."""
    rides = trips(spark, sf_dir)
    second = {c: F.substring(F.col(c).cast("string"), 1, 19) for c in ("starttime", "stoptime")}
    day_first = F.regexp_replace(second["starttime"], "^([0-9]+)-([0-9]+)-([0-9]+)", "$3/$2/$1")
    return rides.withColumns(
        {
            "starttime": day_first,
            "stoptime": second["stoptime"],
            "start_station_id": F.concat(F.col("start_station_id").cast("string"), F.lit(".0")),
            "start_station_latitude": F.col("start_station_latitude").cast("string"),
        }
    )


def faulty_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text_trips`` with cells that cannot be read: a word for a time, a note behind a
    number, a decimal comma; some rows have several."""
    return text_trips(spark, sf_dir).withColumns(
        {
            "starttime": F.expr("if(starttime like '%:13', 'noon', starttime)"),
            "start_station_id": F.expr(
                "if(start_station_id = '7.0', '7.0 (closed)', start_station_id)"
            ),
            "start_station_latitude": F.expr(
                "if(stoptime like '%3:_5', replace(start_station_latitude, '.', ','), "
                "start_station_latitude)"
            ),
        }
    )
