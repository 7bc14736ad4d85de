"""What the plans must and must not hold."""

from pathlib import Path

import pytest
from frames import stations, taxi, trips
from pyspark.sql import functions as F

import __spark_entry__
from velometry.operators import balance, popularity, supply
from velometry.operators import taxi as taxi_ops
from velometry.plans import oracle
from velometry.sources import read_taxi, read_trips, readers, write_table

SF_DIR = "/root/testdata/sf0.001"

# The plans of these start at kept rows, after model fits or numbering.
FITTED = {
    "cluster_totals", "duration_split_total", "recommend_zones", "new_stations_zones",
    "recommend_zones_steady", "cluster_sample", "taxi_sample", "duration_split",
    "duration_split_rows", "duration_penalised",
    "pickup_zones", "dropoff_zones", "duration_line", "duration_line_rmse", "duration_scaled",
}
LAZY = sorted(set(oracle.all_sql()) - FITTED)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    ride = ("2016-05-02 09:00:00", "2016-05-02 09:10:00", "A", "B")
    back = (*ride[:2], "B", "A")
    write_table(trips(spark, ride, ride, ride, back), f"{root}/trips")
    write_table(taxi(spark, {}, {"trip_distance": 3}), f"{root}/taxi")
    return root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_reaches_the_scan_and_columns_are_pruned(spark, tables):
    rides = read_trips(spark, f"{tables}/trips")
    text = plan(popularity.station_activity(rides, 2016))
    assert "GreaterThanOrEqual(stoptime,2016-01-01T00:00)" in text
    assert "LessThan(stoptime,2017-01-01T00:00)" in text
    assert "station_id" not in text.split("ReadSchema")[1].splitlines()[0]
    assert "GreaterThanOrEqual(starttime,2016-01-01T00:00)" in plan(taxi_ops.od_pairs(rides, 2016))


def test_days_reach_the_scan(spark, tables):
    rides = read_trips(spark, f"{tables}/trips")
    text = plan(balance.hourly_net_flow(rides, days=("2016-05-02", "2016-05-02")))
    assert "PushedFilters: [Or(And(" in text


def test_both_directions_and_all_frames_come_from_one_scan(spark, tables):
    rides = read_trips(spark, f"{tables}/trips")
    for df in (balance.hourly_net_flow(rides), popularity.top_stations(rides)):
        assert plan(df).count("FileScan") == 1


def test_rank_bound_is_applied_before_the_shuffle(spark, tables):
    text = plan(popularity.top_stations(read_trips(spark, f"{tables}/trips")))
    assert text.count("WindowGroupLimit") == 2


def test_short_and_overloaded_stations_share_the_raw_scan(spark, tables):
    flow = balance.hourly_net_flow(read_trips(spark, f"{tables}/trips"))
    docks = stations(spark, (1, "A", 40.7, -74.0, 1, 1), (2, "B", 40.7, -74.0, 1, 1))
    for build in (
        supply.supply_pairs,
        supply.nearby_supply,
        lambda s, o: supply.nearby_supply(s, o, n=5),
        lambda s, o: supply.supply_pairs(s, o, max_km=3),
    ):
        df = build(balance.shortage_hours(flow, docks), balance.overload_hours(flow, docks))
        assert len(df.collect()) == 1
        final = plan(df).split("Initial Plan")[0]
        assert final.count("FileScan") == 1


def test_data_derived_limit_is_a_subquery_of_the_scan(spark, tables):
    limit = taxi_ops.median_trip_miles(taxi_ops.od_pairs(read_trips(spark, f"{tables}/trips")))
    text = plan(taxi_ops.short_trips(read_taxi(spark, f"{tables}/taxi"), limit))
    assert "Subquery" in text and "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(__spark_entry__.queries()[name](spark, SF_DIR))
    for word in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_only_single_rows_are_broadcast_by_hint(spark):
    # With automatic broadcasts off, what is left comes from hints: the single
    # rows that pick a class of values.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in LAZY:
            query = __spark_entry__.queries()[name]
            for line in plan(query(spark, SF_DIR)).splitlines():
                if "BroadcastHashJoin" in line:
                    assert "[coarse" in line or "[fine" in line
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_hour_is_spread_over_tasks(spark):
    short = spark.range(400).select(
        F.lit("2016-05-02").cast("date").alias("date"),
        F.lit(9).alias("hour"),
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("name"),
        F.lit(40.7).alias("latitude"),
        F.lit(-74.0).alias("longitude"),
    )
    over = short.withColumn("name", F.concat(F.lit("N"), "name"))
    pairs = supply._pairs(short, over, None, "haversine", per_task=50)
    parts = pairs.groupBy("part").count().collect()
    assert len(parts) == 8 and max(p["count"] for p in parts) < 400 * 400 / 4
    assert sum(p["count"] for p in parts) == 400 * 400


def test_first_trips_cut_off_at_the_raw_column(spark, tables, monkeypatch):
    monkeypatch.setattr(readers, "cut_lineage", lambda df: df)  # the whole plan in one
    text = plan(read_taxi(spark, f"{tables}/taxi", first=1))
    assert "TakeOrderedAndProject" not in text
    assert "(pickup_datetime" in text.split("DataFilters: [")[1]
    assert text.count("pickup_datetime#") and " < Subquery" in text and " >= Subquery" in text


def test_hot_hour_of_whole_lists_is_spread_over_tasks(spark):
    short = spark.range(400).selectExpr(
        "date '2016-05-02' as date", "9 as hour", "concat('S', id) as name",
        "40.7d as latitude", "-74.0d as longitude",
    )
    starts = supply._places(short, "start")
    left, right = supply._in_parts(starts, supply._places(short, "near"), 50)
    assert left.select("part").distinct().count() == 8
    assert left.groupBy("part").count().agg(F.max("count")).first()[0] < 100
    assert right.count() == 8 * 400


def test_year_of_a_lookup_reaches_the_scan(spark, tables):
    rides = read_trips(spark, f"{tables}/trips")
    top = popularity.top_stations(rides, 2016, "evening")
    assert "GreaterThanOrEqual(stoptime,2016-01-01T00:00)" in plan(top)


def test_no_temporary_folder_in_the_library():
    for path in Path(__spark_entry__.__file__).parent.joinpath("velometry").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tempfile" not in path.read_text()
