from datetime import datetime

import pytest
from frames import PLACES, rows, taxi, trips
from pyspark.sql import functions as F

from velometry.schemas import STATIONS, TRIPS
from velometry.sources import (
    cut_lineage,
    parse_centres,
    parse_name_list,
    read_stations,
    read_table,
    read_taxi,
    read_trips,
    refused_cells,
    write_table,
)
from velometry.sources.readers import first_trips

RIDE = ("2016-05-02 09:00:00", "2016-05-02 09:10:00", "A", "B")


def test_trips_survive_each_format(spark, tmp_path):
    rides = trips(spark, RIDE, (*RIDE[:3], None))
    for fmt in ("parquet", "csv", "orc"):
        path = str(tmp_path / fmt)
        write_table(rides, path, fmt)
        back = read_trips(spark, path, fmt)
        assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in TRIPS]
        assert sorted(back.collect(), key=str) == sorted(rides.collect(), key=str)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    # An index column in front, another order, renamed and extra columns.
    (tmp_path / "s.csv").write_text(
        ",name,station_id,region_id,longitude,latitude,capacity,num_bikes_available,extra\n"
        "0,A,72,70.0,-74.0,40.7,39,x,1\n"
    )
    path = str(tmp_path / "s.csv")
    with pytest.raises(Exception, match="unreadable num_bikes_available: x"):
        read_stations(spark, path, "csv").collect()
    found = read_stations(spark, path, "csv", bad="null")
    assert found.schema.fieldNames() == STATIONS.fieldNames()
    # The unreadable stock is null, and a column nobody needs may be missing.
    assert found.collect() == [(72, "A", 40.7, -74.0, 70, 39, None, None)]


def test_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "s.csv").write_text("station_id,name\n1,A\n")
    with pytest.raises(ValueError, match="latitude"):
        read_stations(spark, str(tmp_path / "s.csv"), "csv")


def test_times_with_a_zone_keep_their_wall_clock(spark, tmp_path):
    names = [f for f in TRIPS.fieldNames() if f not in ("starttime", "stoptime")]
    blank = "," * len(names)
    (tmp_path / "t.csv").write_text(
        f"starttime,stoptime,{','.join(names)}\n"
        f"2016-05-02 09:00:00+00:00,2016-05-02 09:10:00 UTC{blank}\n"
        f"2016-05-02 09:00:00.500,{blank}\n"
    )
    found = read_trips(spark, str(tmp_path / "t.csv"), "csv")
    assert sorted(found.select("starttime", "stoptime").collect()) == [
        (datetime(2016, 5, 2, 9), datetime(2016, 5, 2, 9, 10)),
        (datetime(2016, 5, 2, 9, 0, 0, 500000), None),
    ]


def _two_times(tmp_path, start, stop):
    names = [f for f in TRIPS.fieldNames() if f not in ("starttime", "stoptime")]
    blank = "," * len(names)
    (tmp_path / "t.csv").write_text(f"starttime,stoptime,{','.join(names)}\n{start},{stop}{blank}\n")
    return str(tmp_path / "t.csv")


def test_unreadable_times_are_an_error_unless_a_format_fits(spark, tmp_path):
    path = _two_times(tmp_path, "9/1/2014 00:00:25", "2014-09-01 00:10:00")
    with pytest.raises(Exception, match="unreadable starttime: 9/1/2014"):
        read_trips(spark, path, "csv").collect()
    with pytest.raises(Exception, match="unreadable starttime"):
        read_trips(spark, path, "csv", formats=["yyyy.MM.dd"]).collect()
    with pytest.raises(ValueError, match="bad must be"):
        read_trips(spark, path, "csv", bad="ignore")
    fits = ["yyyy.MM.dd", "M/d/yyyy HH:mm:ss"]
    found = read_trips(spark, path, "csv", formats=fits).select("starttime", "stoptime")
    assert found.collect() == [(datetime(2014, 9, 1, 0, 0, 25), datetime(2014, 9, 1, 0, 10))]
    blank = read_trips(spark, path, "csv", bad="null").select("starttime", "stoptime")
    assert blank.collect() == [(None, datetime(2014, 9, 1, 0, 10))]


def test_formats_do_not_skip_hours_of_the_session_zone(spark, tmp_path):
    path = _two_times(tmp_path, "13.03.2016 02:30:00", "13.03.2016 03:10:00")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = read_trips(spark, path, "csv", formats=["dd.MM.yyyy HH:mm:ss"]).first()
        assert (found.starttime, found.stoptime) == (
            datetime(2016, 3, 13, 2, 30),
            datetime(2016, 3, 13, 3, 10),
        )
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_instants_need_the_city_zone(spark, tmp_path, session):
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        path = str(tmp_path / "instants")
        rides = trips(spark, RIDE).withColumns(
            {c: F.expr("timestamp '2016-07-01 16:00:00 UTC'") for c in ("starttime", "stoptime")}
        )
        write_table(rides, path)
        with pytest.raises(ValueError, match="starttime is an instant"):
            read_trips(spark, path)
        assert read_trips(spark, path, zone="America/New_York").first().starttime == datetime(
            2016, 7, 1, 12
        )
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def test_taxi_travel_time_is_computed_when_missing(spark, tmp_path):
    path = str(tmp_path / "taxi")
    write_table(taxi(spark, {}, {"pickup_datetime": "2016-03-01 09:00:00"}).drop("travel_time"), path)
    found = read_taxi(spark, path)
    assert rows(found, "travel_time") == [(600.0,), (4200.0,)]
    assert rows(read_taxi(spark, path, first=1), "travel_time") == [(4200.0,)]
    assert first_trips(found, 5).count() == 2


def test_first_trips_keeps_missing_times_and_orders_ties(spark):
    rides = taxi(
        spark,
        *({"pickup_datetime": f"2016-03-13 02:{m:02d}:00", "fare_amount": m} for m in (30, 10, 20)),
        {"pickup_datetime": "2016-03-13 02:10:00", "fare_amount": 1},
        {"pickup_datetime": None, "fare_amount": 99},
    ).select("pickup_datetime", "fare_amount")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 is skipped there
    try:
        for n, fares in ((1, [99]), (2, [99, 1]), (3, [99, 1, 10]), (9, [99, 1, 10, 20, 30])):
            assert [r.fare_amount for r in first_trips(rides, n).collect()] == fares
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def test_first_trips_ties_within_the_last_second(spark):
    times = [f"2016-03-01 10:00:00.{i % 3}" for i in range(9)] + ["1969-12-31 23:59:59.5", "2016-03-01 10:00:01"]
    rides = taxi(spark, *({"pickup_datetime": t, "fare_amount": i} for i, t in enumerate(times)))
    rides = rides.select("pickup_datetime", "fare_amount")
    whole = [tuple(r) for r in rides.orderBy("pickup_datetime", "fare_amount").collect()]
    for n in (1, 2, 4, 5, 10, 11, 12):
        assert [tuple(r) for r in first_trips(rides, n).collect()] == whole[:n]
    assert first_trips(rides.limit(0), 3).count() == 0


def test_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "years")
    for year, n in ((2015, 3), (2016, 4), (2015, 2)):
        write_table(spark.range(n).selectExpr("id", f"{year} as year"), path, partition_by=["year"])
    assert rows(spark.read.parquet(path).groupBy("year").count()) == [(2015, 2), (2016, 4)]


def test_csv_header_must_agree_with_a_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    assert read_table(spark, str(tmp_path / "x.csv"), "csv", "b int, a int").collect() == [(1, 2)]
    with pytest.raises(Exception, match="header"):
        read_table(spark, str(tmp_path / "x.csv"), "csv", "a int, b int").collect()


def test_partitioned_table_is_pruned_on_read(spark, tmp_path):
    path = str(tmp_path / "by_name")
    write_table(trips(spark, RIDE, ("2016-05-03 09:00:00", None, "C", "D")), path,
                partition_by=["start_station_name"])
    back = read_table(spark, path).filter("start_station_name = 'C'")
    assert "PartitionFilters: [isnotnull(start_station_name" in back._jdf.queryExecution().toString()
    assert rows(back, "end_station_name") == [("D",)]


def test_single_file_and_arrays_in_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, ["A & B", "C's"])], "id int, names array<string>")
    df = df.repartition(4)
    write_table(df, str(tmp_path / "one"), "csv", single_file=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    text = read_table(spark, str(tmp_path / "one"), "csv")
    assert text.select(parse_name_list("names")).first()[0] == ["A & B", "C's"]


def test_printed_name_lists(spark):
    printed = """['A & B', "St. Mark's", 'C, D']"""
    df = spark.createDataFrame([(printed,), ("[]",), (None,)], "t string")
    found = [r[0] for r in df.select(parse_name_list("t")).collect()]
    assert found == [["A & B", "St. Mark's", "C, D"], [], None]


def test_printed_centres(spark):
    df = spark.createDataFrame([("ten", "[[[40.1, -73.9], [40.2, -73.8]]]")], "k string, t string")
    found = rows(parse_centres(df, "t", "k"))
    assert found == [("ten", 0, 40.1, -73.9), ("ten", 1, 40.2, -73.8)]


def test_rows_are_kept_without_a_checkpoint_folder(spark, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    kept = cut_lineage(trips(spark, RIDE))
    monkeypatch.undo()
    assert kept.is_cached and kept.count() == 1
    kept.unpersist()


def test_cut_lineage_reads_from_the_checkpoint_folder(spark):
    rides = trips(spark, RIDE, places=PLACES)
    cut = cut_lineage(rides)
    assert cut.collect() == rides.collect()
    assert "ExistingRDD" in cut._jdf.queryExecution().toString()
    folder = spark.sparkContext.getCheckpointDir()
    assert spark.conf.get("spark.checkpoint.dir") in folder


def _faulty(tmp_path):
    path = tmp_path / "in put"
    path.mkdir()
    names = TRIPS.fieldNames()
    lines = [
        "2016-05-02 09:00:00,2016-05-02 09:10:00,72.0,A,40.7,-74.0,3,B,40.8,-74.0",
        "noon,2016-05-02 09:10:00,x,A,40.7,-74.0,3,B,40.8,-74.0",
        "2016-05-02 09:00:00,,99999999999999999999,,,,,,,",
        ",,,,,,,,,",
    ]
    (path / "t.csv").write_text("\n".join([",".join(names), *lines]) + "\n")
    return str(path)


def test_refused_rows_are_set_apart_with_their_reasons(spark, tmp_path):
    apart = str(tmp_path / "apart")
    path = _faulty(tmp_path)
    for _ in range(2):  # a second run replaces the first
        good = read_trips(spark, path, "csv", bad="refuse", refused_to=apart, max_refused=0.5)
        assert good.schema == TRIPS
        assert sorted(good.select("start_station_id", "end_station_name").collect(), key=str) == [
            (72, "B"),
            (None, None),
        ]
    cells = refused_cells(spark, apart)
    assert rows(cells, "column", "cell", "reason") == [
        ("start_station_id", "99999999999999999999", "not a whole number in range"),
        ("start_station_id", "x", "not a whole number in range"),
        ("starttime", "noon", "not a time"),
    ]
    noon = cells.filter("cell = 'noon'").first()
    assert noon.file.endswith("t.csv")
    assert '"starttime":"noon"' in noon.row and '"end_station_name":"B"' in noon.row


def test_more_refused_rows_than_allowed_are_an_error(spark, tmp_path):
    apart = str(tmp_path / "apart")
    with pytest.raises(ValueError, match="2 of 4 rows"):
        read_trips(spark, _faulty(tmp_path), "csv", bad="refuse", refused_to=apart)
    assert refused_cells(spark, apart).count() == 3
    with pytest.raises(ValueError, match="refused_to"):
        read_trips(spark, str(tmp_path / "in put"), "csv", bad="refuse")


def test_sifting_keeps_typed_and_renamed_columns(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "name,station_id,latitude,longitude,capacity,num_bikes_available\nA,72,40.7,-74.0,39,x\n"
    )
    apart = str(tmp_path / "apart")
    found = read_stations(
        spark, str(tmp_path / "s.csv"), "csv", bad="refuse", refused_to=apart, max_refused=1
    )
    assert found.schema == STATIONS and found.count() == 0
    cell = refused_cells(spark, apart).first()
    assert (cell.column, cell.cell) == ("num_bikes_available", "x")
    assert '"station_id":"72"' in cell.row
    # A table that is typed already has nothing to refuse; an empty one is no error.
    write_table(trips(spark, RIDE).limit(0), str(tmp_path / "typed"))
    none = read_trips(spark, str(tmp_path / "typed"), bad="refuse", refused_to=apart, max_refused=0)
    assert none.count() == 0 and refused_cells(spark, apart).count() == 0
