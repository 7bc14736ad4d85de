from frames import hours, rows, stations

from velometry.operators import balance, placement, serving

DAY, NEXT = "2016-05-02", "2016-05-03"
DOCKS = [(2, "A", 40.7, -74.0, 5, 2), (1, "A", 40.8, -74.1, 5, 2), (3, "B", 40.9, -74.2, 5, 2)]


def _short(spark):
    return hours(
        spark,
        ("B", DAY, 8, -2, 40.9, -74.2),
        ("A", DAY, 8, -2, 40.8, -74.1),
        ("A", DAY, 9, -1, 40.8, -74.1),
        ("C", NEXT, 9, -1, 0.0, 0.0),
    )


def test_names_on_a_date(spark):
    assert [r.name for r in serving.stations_on(_short(spark), DAY).collect()] == ["A", "B"]
    assert serving.stations_on(_short(spark), "2016-01-01").collect() == []
    assert serving.first_station_on(_short(spark), DAY).collect() == [("A",)]
    assert serving.first_station_on(_short(spark), "2016-01-01").collect() == []


def test_location_of_a_name_listed_twice_is_that_of_the_smallest_id(spark):
    docks = stations(spark, *DOCKS)
    assert serving.station_location(docks, "A").collect() == [("A", 40.8, -74.1)]
    assert serving.station_location(docks, "none").collect() == []
    assert serving.all_stations(docks).count() == 3


def test_map_points_carry_their_kind(spark):
    over = hours(spark, ("B", DAY, 7, 3, 40.9, -74.2), ("A", NEXT, 7, 3, 40.8, -74.1))
    points = serving.map_points(_short(spark), over, stations(spark, *DOCKS), DAY)
    assert rows(points, "name", "kind", "latitude") == [
        ("A", "short", 40.8),
        ("B", "overload", 40.9),
        ("B", "short", 40.9),
    ]


def test_stock_of_one_station(spark):
    stock = balance.hourly_stock(_short(spark), stations(spark, *DOCKS))
    day = serving.hourly_stock_for(stock, DAY, "A").collect()
    assert [r.stock for r in day] == [2] * 8 + [0] + [-1] * 15
    assert serving.hourly_stock_for(stock, NEXT, "A").collect() == []


def test_first_names_of_a_list(spark):
    nearby = spark.createDataFrame(
        [(DAY, 8, "A", list("abcdefg")), (DAY, 9, "A", list("xy"))],
        "date string, hour int, start_station_name string, nearby_stations array<string>",
    )
    nearby = nearby.withColumn("date", nearby["date"].cast("date"))
    assert serving.nearby_supply_for(nearby, DAY, 8, "A").first().nearby_stations == list("abcde")
    assert serving.nearby_supply_for(nearby, DAY, 9, "A").first().nearby_stations == list("xy")
    assert serving.nearby_supply_for(nearby, DAY, 7, "A").collect() == []


def test_peaks(spark):
    peak = spark.createDataFrame(
        [(2015, 2, "A", 0.0, 0.0, 7), (2016, 3, "B", 0.0, 0.0, 9), (2016, 1, "A", 0.0, 0.0, 4)],
        "year int, month int, name string, latitude double, longitude double, count bigint",
    )
    assert [r.month_name for r in serving.peak_trend(peak, 2016).collect()] == ["January", "March"]
    assert [r["count"] for r in serving.peak_trend(peak).collect()] == [7, 4, 9]
    assert serving.count_range(peak).collect() == [(0, 9)]


def test_top_of_a_month_by_name_or_number(spark):
    top = spark.createDataFrame(
        [(2016, "morning", 3, "A"), (2016, "evening", 3, "B"), (2015, "morning", 3, "C")],
        "year int, frame string, month int, name string",
    )
    for month in (3, "March"):
        assert rows(serving.top_stations_for(top, 2016, month, "Morning"), "name") == [("A",)]


def test_new_stations_by_label_or_size(spark):
    centres = spark.createDataFrame(
        [(10, 0, 40.1, -73.9), (50, 0, 40.2, -73.8)],
        "k int, cluster_id int, latitude double, longitude double",
    )
    assert placement.LABELS["fif"] == 50
    for k in (50, "fif"):
        assert serving.new_stations(centres, k).collect() == [(-73.8, 40.2)]
