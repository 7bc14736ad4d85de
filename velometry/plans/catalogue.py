"""Named queries: every operator on the synthetic tables.

Each takes a session and a data directory and returns a lazy DataFrame.  For
comparison with another engine, computed doubles are rounded to six places and
lists are joined to text; the operators themselves do neither.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velometry.functions.numbering import by_number
from velometry.functions.sketch import rank_error
from velometry.functions.timeparts import MONTHS, in_year, month_name, month_number, with_trip_parts
from velometry.operators import (
    balance,
    duration,
    placement,
    popularity,
    serving,
    supply,
    taxi,
)
from velometry.operators import stations as station_ops
from velometry.plans import fixtures as fx
from velometry.schemas import TRIPS
from velometry.sources import readers, text

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

MAX_KM = 3.0
TOP_N = 5
FIRST_N = 1000
DENSE_KM = 0.2
DENSE_STATION = "C100"
PER_TASK = 32


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _joined(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.concat_ws("|", column))


# --- sources ------------------------------------------------------------------


@query
def station_projection(spark, sf):
    return fx.stations(spark, sf)


@query
def taxi_first_n(spark, sf):
    columns = ("pickup_datetime", "dropoff_datetime", "trip_distance", "travel_time")
    return readers.first_trips(fx.taxi(spark, sf).select(*columns), FIRST_N)


@query
def taxi_travel_time(spark, sf):
    timed = readers.with_travel_time(fx.taxi(spark, sf).drop("travel_time"))
    return timed.select("pickup_datetime", "dropoff_datetime", "travel_time")


@query
def trip_time_parts(spark, sf):
    parts = with_trip_parts(fx.trips(spark, sf))
    return parts.select(
        "starttime", "stoptime", "start_date", "start_hour", "end_date", "end_hour", "month", "year"
    )


@query
def text_times(spark, sf):
    read = readers.conform(fx.text_trips(spark, sf), TRIPS, formats=["dd/MM/yyyy HH:mm:ss"])
    return read.select("starttime", "stoptime", "start_station_id", "start_station_latitude")


def _sifted(spark, sf):
    return readers.sifted(fx.faulty_trips(spark, sf), TRIPS, formats=["dd/MM/yyyy HH:mm:ss"])


@query
def refused_cells(spark, sf):
    cells = readers.cells_of(_sifted(spark, sf))
    raw = F.from_json("row", "stoptime string, end_station_name string")
    return cells.select("column", "cell", "reason", raw.alias("r")).select(
        "column", "cell", "reason", "r.*"
    )


@query
def accepted_trips(spark, sf):
    rows = _sifted(spark, sf).filter("refusal is null")
    return rows.select("starttime", "stoptime", "start_station_id", "start_station_latitude")


@query
def trips_in_year(spark, sf):
    chosen = fx.trips_long(spark, sf).filter(in_year("stoptime", fx.POPULAR_YEAR))
    return chosen.select("starttime", "stoptime", "start_station_name", "end_station_name")


# --- popularity ---------------------------------------------------------------


@query
def station_activity(spark, sf):
    return popularity.station_activity(fx.trips_long(spark, sf), fx.POPULAR_YEAR)


@query
def station_activity_combined(spark, sf):
    return popularity.station_activity(
        fx.trips_long(spark, sf), fx.POPULAR_YEAR, per_direction=False
    )


@query
def hourly_activity_merged(spark, sf):
    rides = fx.trips_long(spark, sf)
    late = F.month("starttime") % 3 == 0
    early = popularity.hourly_activity(rides.filter(~late))
    whole = popularity.merge_hourly(early, popularity.hourly_activity(rides.filter(late)))
    return whole.drop("direction")


def _peak(spark, sf, year=None):
    return popularity.monthly_peak(popularity.station_activity(fx.trips_long(spark, sf), year))


@query
def monthly_peak(spark, sf):
    return _peak(spark, sf, fx.POPULAR_YEAR)


def _top(spark, sf, frame):
    return popularity.top_stations(fx.trips_long(spark, sf), fx.POPULAR_YEAR, frame)


@query
def top_morning(spark, sf):
    return _top(spark, sf, "morning")


@query
def top_afternoon(spark, sf):
    return _top(spark, sf, "afternoon")


@query
def top_evening(spark, sf):
    return _top(spark, sf, "evening")


@query
def top_all_frames(spark, sf):
    return popularity.top_stations(fx.trips_long(spark, sf))


@query
def hourly_activity(spark, sf):
    return popularity.hourly_activity(fx.trips_long(spark, sf), fx.POPULAR_YEAR)


@query
def top_from_hourly(spark, sf):
    hourly = popularity.hourly_activity(fx.trips_long(spark, sf), fx.POPULAR_YEAR)
    return popularity.top_from_hourly(hourly)


@query
def peak_trend(spark, sf):
    return serving.peak_trend(_peak(spark, sf))


@query
def peak_trend_year(spark, sf):
    # The year reaches the scan.
    return serving.peak_trend(_peak(spark, sf, fx.POPULAR_YEAR), fx.POPULAR_YEAR)


@query
def top_for_month(spark, sf):
    top = popularity.top_stations(fx.trips_long(spark, sf), fx.POPULAR_YEAR, "evening")
    return serving.top_stations_for(top, fx.POPULAR_YEAR, "March", "Evening")


@query
def count_range(spark, sf):
    return serving.count_range(_peak(spark, sf))


@query
def month_names(spark, sf):
    months = fx.trips_long(spark, sf).select(F.month("stoptime").alias("month")).distinct()
    named = months.withColumn("month_name", month_name("month"))
    return named.withColumn("month_number", month_number("month_name"))


# --- stations -----------------------------------------------------------------


@query
def station_start_counts(spark, sf):
    return station_ops.start_counts(fx.trips(spark, sf))


def _active(spark, sf):
    return station_ops.active_stations(fx.stations(spark, sf), fx.trips(spark, sf))


@query
def active_stations(spark, sf):
    return _active(spark, sf)


@query
def station_location(spark, sf):
    return serving.station_location(_active(spark, sf), fx.STATION)


@query
def all_stations(spark, sf):
    return serving.all_stations(_active(spark, sf))


# --- balance ------------------------------------------------------------------


@query
def hourly_departures(spark, sf):
    return balance.hourly_departures(fx.trips(spark, sf))


@query
def hourly_arrivals(spark, sf):
    return balance.hourly_arrivals(fx.trips(spark, sf))


def _hourly(spark, sf, days=None):
    return balance.hourly_net_flow(fx.trips(spark, sf), days=days)


@query
def hourly_net_flow(spark, sf):
    return _hourly(spark, sf)


@query
def hourly_net_flow_full(spark, sf):
    return balance.hourly_net_flow(fx.trips(spark, sf), how="full")


@query
def daily_net_flow(spark, sf):
    return balance.daily_net_flow(_hourly(spark, sf))


@query
def daily_deficit(spark, sf):
    return balance.daily_net_flow(_hourly(spark, sf)).filter(F.col("bike_movement") < 0)


@query
def daily_surplus(spark, sf):
    return balance.daily_net_flow(_hourly(spark, sf)).filter(F.col("bike_movement") > 0)


@query
def shortage_days(spark, sf):
    days = balance.shortage_days(_hourly(spark, sf), fx.stations(spark, sf))
    return _rounded(days, "filled_rate")


@query
def overload_days(spark, sf):
    days = balance.overload_days(_hourly(spark, sf), fx.stations(spark, sf))
    return _rounded(days, "filled_rate")


# A station with net flow has a departure, so it is an active one: the plain
# station table gives the same rows here without another pass over the trips.


def _short(spark, sf, days=None):
    return balance.shortage_hours(_hourly(spark, sf, days), fx.stations(spark, sf))


def _over(spark, sf, days=None):
    return balance.overload_hours(_hourly(spark, sf, days), fx.stations(spark, sf))


_ON_DAY = (fx.DAY, fx.DAY)


@query
def shortage_hours(spark, sf):
    return _short(spark, sf)


@query
def overload_hours(spark, sf):
    return _over(spark, sf)


@query
def hourly_stock(spark, sf):
    return balance.hourly_stock(_short(spark, sf), fx.stations(spark, sf))


@query
def hourly_stock_to_22(spark, sf):
    return balance.hourly_stock(_short(spark, sf), fx.stations(spark, sf), hours=23)


@query
def hourly_stock_for_station(spark, sf):
    stock = balance.hourly_stock(_short(spark, sf, _ON_DAY), fx.stations(spark, sf))
    return serving.hourly_stock_for(stock, fx.DAY, fx.STATION)


@query
def shortage_stations_on(spark, sf):
    return serving.stations_on(_short(spark, sf, _ON_DAY), fx.DAY)


@query
def overload_stations_on(spark, sf):
    return serving.stations_on(_over(spark, sf, _ON_DAY), fx.DAY)


@query
def first_station_on(spark, sf):
    return serving.first_station_on(_short(spark, sf, _ON_DAY), fx.DAY)


@query
def map_points(spark, sf):
    return serving.map_points(
        _short(spark, sf, _ON_DAY), _over(spark, sf, _ON_DAY), fx.stations(spark, sf), fx.DAY
    )


# --- supply -------------------------------------------------------------------


@query
def supply_pairs(spark, sf):
    return _rounded(supply.supply_pairs(_short(spark, sf), _over(spark, sf)), "km")


@query
def supply_within_km(spark, sf):
    return _rounded(supply.supply_pairs(_short(spark, sf), _over(spark, sf), MAX_KM), "km")


def _nearby(spark, sf, n=None, days=None):
    return supply.nearby_supply(_short(spark, sf, days), _over(spark, sf, days), n)


@query
def nearby_supply(spark, sf):
    return _joined(_nearby(spark, sf), "nearby_stations")


@query
def nearby_top5(spark, sf):
    return _joined(_nearby(spark, sf, TOP_N), "nearby_stations")


@query
def nearby_supply_for(spark, sf):
    chosen = supply.nearby_supply_at(
        _short(spark, sf, _ON_DAY), _over(spark, sf, _ON_DAY), fx.DAY, fx.HOUR, fx.STATION, TOP_N
    )
    return _joined(chosen, "nearby_stations")


# Crowded hours: lists are longer than five, cells hold five, hours are split.


@query
def dense_within_km(spark, sf):
    pairs = supply.supply_pairs(fx.dense_short(spark, sf), fx.dense_over(spark, sf), DENSE_KM)
    return _rounded(pairs, "km")


@query
def dense_supply_pairs(spark, sf):
    # Plain numbers only, stations too: they are summed up without sorting the pairs.
    short, names = by_number(fx.dense_short(spark, sf), "name")
    pairs = supply.supply_pairs(short, fx.dense_over(spark, sf), per_task=PER_TASK)
    nearest = F.round(F.min("km"), 6).alias("nearest_km")
    summed = pairs.groupBy("start_station_name").agg(
        F.count(F.lit(1)).alias("pairs"), F.round(F.sum("km"), 6).alias("km"), nearest
    )
    named = names.select("number", F.col("value").alias("name"))
    return summed.join(named, F.col("start_station_name") == F.col("number")).select(
        F.col("name").alias("start_station_name"), "pairs", "km", "nearest_km"
    )


@query
def dense_nearby_supply(spark, sf):
    lists = supply.nearby_supply(
        fx.dense_short(spark, sf), fx.dense_over(spark, sf), per_task=PER_TASK
    )
    return _joined(lists, "nearby_stations")


@query
def dense_nearby_top5(spark, sf):
    lists = supply.nearby_supply(fx.dense_short(spark, sf), fx.dense_over(spark, sf), TOP_N)
    return _joined(lists, "nearby_stations")


@query
def dense_nearby_for(spark, sf):
    chosen = supply.nearby_supply_at(
        fx.dense_short(spark, sf), fx.dense_over(spark, sf), fx.DAY, 10, DENSE_STATION, TOP_N
    )
    return _joined(chosen, "nearby_stations")


@query
def supply_segments(spark, sf):
    return supply.supply_segments(_nearby(spark, sf, TOP_N), fx.stations(spark, sf))


@query
def parse_name_list(spark, sf):
    quoted = F.concat_ws("', '", "nearby_stations")
    printed = _nearby(spark, sf).withColumn(
        "printed", F.concat(F.lit("['"), quoted, F.lit("']"))
    )
    parsed = printed.withColumn("nearby_stations", text.parse_name_list("printed"))
    return _joined(parsed.drop("printed"), "nearby_stations")


@query
def parse_centres(spark, sf):
    places = _short(spark, sf).select("date", "name", "latitude", "longitude").distinct()
    pair = F.concat(
        F.lit("["),
        F.col("latitude").cast("string"),
        F.lit(", "),
        F.col("longitude").cast("string"),
        F.lit("]"),
    )
    pairs = F.sort_array(F.collect_list(F.struct("name", pair.alias("pair"))))["pair"]
    lists = places.groupBy("date").agg(
        F.concat(F.lit("[["), F.concat_ws(", ", pairs), F.lit("]]")).alias("printed")
    )
    return text.parse_centres(lists, "printed", "date")


# --- taxi ---------------------------------------------------------------------


def _od(spark, sf, round_km=True):
    return taxi.od_pairs(fx.trips(spark, sf), fx.BIKE_YEAR, round_km)


@query
def od_pairs(spark, sf):
    return _od(spark, sf)


@query
def od_distance(spark, sf):
    return _rounded(_od(spark, sf, round_km=False), "dist")


@query
def median_trip_miles(spark, sf):
    return _rounded(taxi.median_trip_miles(_od(spark, sf)), "miles")


@query
def median_trip_miles_weighted(spark, sf):
    od = _od(spark, sf, round_km=False)
    return _rounded(taxi.median_trip_miles(od, weighted=True), "miles")


def _short_taxi(spark, sf):
    return taxi.short_trips(fx.taxi(spark, sf), taxi.median_trip_miles(_od(spark, sf)))


def _slow_taxi(spark, sf):
    return taxi.slow_trips(_short_taxi(spark, sf))


_TAXI = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
    "trip_distance",
    "travel_time",
)


@query
def short_taxi(spark, sf):
    return _short_taxi(spark, sf).select(*_TAXI)


@query
def slow_taxi(spark, sf):
    return _rounded(_slow_taxi(spark, sf).select(*_TAXI, "velocity"), "velocity")


@query
def slow_velocity(spark, sf):
    moving = taxi.with_velocity(_short_taxi(spark, sf))
    limit = taxi.quantile(moving, "velocity", 0.2)
    return limit.select(F.round("quantile", 9).alias("velocity"))


@query
def velocity_sketches(spark, sf):
    # A year's sketch cannot be compared, but what it promises can: its quantile's rank.
    stored = taxi.velocity_sketches(_short_taxi(spark, sf))
    found = stored.select(
        "year", "n", F.kll_sketch_get_quantile_double("sketch", F.lit(0.2)).alias("limit")
    )
    moving = taxi.with_velocity(_short_taxi(spark, sf)).filter("velocity is not null")
    ranked = moving.withColumn("year", F.year("pickup_datetime")).join(found, "year")
    v, slack = F.col("velocity"), 2 * rank_error()
    return ranked.groupBy("year", "n").agg(
        (
            (F.count_if(v < F.col("limit")) <= (0.2 + slack) * F.col("n"))
            & (F.count_if(v <= F.col("limit")) >= (0.2 - slack) * F.col("n"))
        ).alias("within")
    )


# --- placement ----------------------------------------------------------------


@query
def taxi_in_bbox(spark, sf):
    return placement.in_city(fx.taxi(spark, sf)).select(*_TAXI)


def _clean(spark, sf):
    return placement.clean(_slow_taxi(spark, sf))


@query
def taxi_clean(spark, sf):
    return _rounded(_clean(spark, sf).select(*_TAXI, "velocity"), "velocity")


@query
def recommend_10(spark, sf):
    return placement.recommend_stations(_clean(spark, sf), [10])


@query
def recommend_50(spark, sf):
    return placement.recommend_stations(_clean(spark, sf), [50])


@query
def recommend_100(spark, sf):
    return placement.recommend_stations(_clean(spark, sf), [100])


@query
def new_stations_for_k(spark, sf):
    return serving.new_stations(placement.recommend_stations(_clean(spark, sf)), "ten")


def _with_pickups(spark, sf):
    columns = (*placement.PICKUP, *placement.DROPOFF, "trip_distance", "velocity")
    return placement.assign_pickups(_clean(spark, sf).select(*columns))


@query
def pickup_clusters(spark, sf):
    return _with_pickups(spark, sf)


@query
def dropoff_clusters(spark, sf):
    return placement.assign_dropoffs(_with_pickups(spark, sf))


@query
def cluster_sample(spark, sf):
    sample = placement.cluster_sample(_with_pickups(spark, sf), "pickup_latitude")
    return _rounded(sample.drop("pickup_cluster"), "velocity")


@query
def taxi_sample(spark, sf):
    """A third of all trips, of which those without a place have zeros for it."""
    rides = fx.taxi(spark, sf).select("trip_distance", *placement.PICKUP, "passenger_count")
    rides = rides.fillna(0.0, list(placement.PICKUP))
    return placement.cluster_sample(rides, "pickup_latitude", 1 / 3, seed=5)


@query
def cluster_totals(spark, sf):
    """Labels differ from run to run; that every trip has one of each does not."""
    both = placement.assign_dropoffs(_with_pickups(spark, sf))
    labelled = F.col("pickup_cluster").between(0, 9) & F.col("dropoff_cluster").between(0, 9)
    return both.agg(F.count(F.lit(1)).alias("trips"), F.count_if(labelled).alias("labelled"))


# Zones far apart, as many as clusters: there SQL averages tell the centres.


@query
def recommend_zones(spark, sf):
    found = placement.recommend_stations(fx.zones(spark, sf), [4])
    return _rounded(found.drop("cluster_id"), "latitude", "longitude")


@query
def recommend_zones_steady(spark, sf):
    found = placement.recommend_stations(fx.zones(spark, sf), [4], steady=True)
    return _rounded(found, "latitude", "longitude")


@query
def new_stations_zones(spark, sf):
    found = placement.recommend_stations(fx.zones(spark, sf), [4])
    return _rounded(serving.new_stations(found, 4), "latitude", "longitude")


def _named(assigned, cluster, lat, lon):
    """Clusters under their least point instead of their number, which is arbitrary."""
    least = assigned.groupBy(cluster).agg(F.min(F.struct(lat, lon)).alias("least"))
    named = assigned.join(least, cluster)
    return named.groupBy(
        F.col(lat).alias("latitude"),
        F.col(lon).alias("longitude"),
        F.col(f"least.{lat}").alias("zone_latitude"),
        F.col(f"least.{lon}").alias("zone_longitude"),
    ).agg(F.count(F.lit(1)).alias("trips"))


@query
def pickup_zones(spark, sf):
    both = placement.assign_pickups(fx.zones(spark, sf), 4)
    return _named(both, "pickup_cluster", *placement.PICKUP)


@query
def dropoff_zones(spark, sf):
    both = placement.assign_dropoffs(placement.assign_pickups(fx.zones(spark, sf), 4), 4)
    return _named(both, "dropoff_cluster", *placement.DROPOFF)


# --- duration -----------------------------------------------------------------


@query
def duration_features(spark, sf):
    data = duration.features(_slow_taxi(spark, sf))
    return _rounded(data, "label", "total_amount", "velocity", "speed_mph")


def _split(spark, sf):
    return duration.split(duration.features(_slow_taxi(spark, sf)))


@query
def duration_split(spark, sf):
    train, validation = _split(spark, sf)
    sides = train.withColumn("side", F.lit("train")).unionByName(
        validation.withColumn("side", F.lit("validation"))
    )
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("trips"))


@query
def duration_split_rows(spark, sf):
    train, validation = _split(spark, sf)
    sides = train.withColumn("side", F.lit("train")).unionByName(
        validation.withColumn("side", F.lit("validation"))
    )
    return _rounded(sides.select("side", "label", "trip_distance", "total_amount"), "label", "total_amount")


@query
def duration_split_total(spark, sf):
    """Sides differ with the seed; together they are all rows, each once."""
    train, validation = _split(spark, sf)
    minutes = F.round(F.sum("label"), 3).alias("minutes")
    return train.unionByName(validation).agg(F.count(F.lit(1)).alias("trips"), minutes)


def _predictions(spark, sf, features=duration.FEATURES_FULL):
    train, validation = _split(spark, sf)
    return duration.predict(duration.fit(train, features), validation)


@query
def duration_predictions(spark, sf):
    return _predictions(spark, sf).select("label", "prediction")


@query
def duration_rmse(spark, sf):
    square = F.avg(F.pow(F.col("prediction") - F.col("label"), 2))
    lists = {"full": duration.FEATURES_FULL, "no_leak": duration.FEATURES_NO_LEAK}
    train, validation = _split(spark, sf)
    errors = [
        duration.predict(duration.fit(train, columns), validation).agg(
            F.lit(name).alias("features"), F.sqrt(square).alias("rmse")
        )
        for name, columns in lists.items()
    ]
    return errors[0].unionByName(errors[1])


# One feature without a penalty is the straight line that SQL fits, too.


def _line(spark, sf):
    data = duration.features(taxi.with_velocity(fx.taxi(spark, sf)))
    held = F.col("passenger_count") % 4 == 0
    train, validation = data.filter(~held), data.filter(held)
    return duration.fit(train, ["trip_distance"], max_iter=100, penalty=0.0), validation


@query
def duration_line(spark, sf):
    predicted = duration.predict(*_line(spark, sf))
    return _rounded(predicted.select("trip_distance", "label", "prediction"), "label", "prediction")


@query
def duration_line_rmse(spark, sf):
    error = duration.evaluate(*_line(spark, sf))[1]
    return fx.stations(spark, sf).agg(F.lit(round(error, 6)).alias("rmse"))


@query
def duration_penalised(spark, sf):
    """The published iterations, penalty and mix, on one feature, where SQL has a formula."""
    train, _ = _split(spark, sf)
    model = duration.fit(train, ["travel_time"]).stages[-1]
    own = [round(float(model.coefficients[0]), 2), round(model.intercept, 2)]
    steady, base = duration.elastic_net(train, ["travel_time"])
    rows = [("fit", *own), ("limit", round(steady[0], 2), round(base, 2))]
    return spark.createDataFrame(rows, "way string, coefficient double, intercept double")


@query
def duration_scaled(spark, sf):
    model, validation = _line(spark, sf)
    for stage in model.stages[:2]:
        validation = stage.transform(validation)
    scaled = F.round(vector_to_array("features")[0], 6).alias("scaled")
    return validation.select("trip_distance", scaled)


def parameters() -> dict[str, object]:
    """The values the queries use, for the SQL they are compared with."""
    return {
        "popular_year": fx.POPULAR_YEAR,
        "bike_year": fx.BIKE_YEAR,
        "day": fx.DAY,
        "hour": fx.HOUR,
        "station": fx.STATION,
        "first_n": FIRST_N,
        "top_n": TOP_N,
        "max_km": MAX_KM,
        "dense_km": DENSE_KM,
        "dense_station": DENSE_STATION,
        "months": MONTHS,
    }
