import pytest
from pyspark.sql import functions as F

from velometry.__main__ import main
from velometry.operators import serving
from velometry.plans import fixtures as fx
from velometry.plans import jobs
from velometry.schemas import TRIPS
from velometry.sources import read_table, readers, refused_cells, replace_partitions, write_table

SF_DIR = "/root/testdata/sf0.01"


def test_jobs_from_input_files_to_result_tables(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_table(fx.trips(spark, SF_DIR), f"{root}/trips")
    write_table(fx.trips_long(spark, SF_DIR), f"{root}/trips_long")
    write_table(fx.station_feed(spark, SF_DIR), f"{root}/stations", "csv")
    write_table(fx.stations(spark, SF_DIR), f"{root}/docks")
    write_table(fx.taxi(spark, SF_DIR), f"{root}/taxi")

    jobs.popularity_tables(spark, f"{root}/trips_long", out)
    top = spark.read.parquet(f"{out}/top_stations")
    assert serving.top_stations_for(top, 1996, "March", "Evening").count() >= 10
    assert serving.peak_trend(spark.read.parquet(f"{out}/monthly_peak"), 1996).count() >= 12

    jobs.station_tables(spark, f"{root}/trips", f"{root}/docks", out)
    assert spark.read.parquet(f"{out}/active_stations").count() == 23

    jobs.balance_tables(spark, f"{root}/trips", f"{root}/docks", out)
    short = spark.read.parquet(f"{out}/shortage_hours")
    stock = spark.read.parquet(f"{out}/hourly_stock")
    days = short.select("date", "name").distinct()
    assert stock.count() == 24 * days.count() > 0
    nearby = spark.read.parquet(f"{out}/nearby_supply")
    chosen = serving.nearby_supply_for(nearby, fx.DAY, fx.HOUR, fx.STATION)
    assert chosen.count() == 1

    jobs.slow_taxi_table(spark, f"{root}/trips", f"{root}/taxi", out, fx.BIKE_YEAR)
    jobs.placement_tables(spark, out)
    centres = spark.read.parquet(f"{out}/new_stations")
    assert {k: serving.new_stations(centres, k).count() for k in ("ten", "fif", "hun")} == {
        "ten": 10,
        "fif": 50,
        "hun": 100,
    }
    assert spark.read.parquet(f"{out}/taxi_clusters").filter("dropoff_cluster is null").count() == 0
    errors = jobs.duration_model(spark, out)
    assert 0 < errors["full"] < 5 and errors["full"] < errors["no_leak"]

    jobs.slow_taxi_table(spark, f"{root}/trips", f"{root}/taxi", out, fx.BIKE_YEAR, first=5000)
    assert 0 < spark.read.parquet(f"{out}/slow_taxi").count() < 2000


def test_yearly_runs_stay_side_by_side(spark, tmp_path):
    root, out, whole = (str(tmp_path / x) for x in ("in", "out", "whole"))
    write_table(fx.trips_long(spark, SF_DIR), root)
    for year in (1995, 1996, 1995):
        jobs.popularity_tables(spark, root, out, year)
    jobs.popularity_tables(spark, root, whole)
    for table in ("monthly_peak", "top_stations", "hourly_activity"):
        both = spark.read.parquet(f"{out}/{table}")
        expected = spark.read.parquet(f"{whole}/{table}").filter("year in (1995, 1996)")
        columns = sorted(both.columns)
        assert sorted(both.select(columns).collect()) == sorted(expected.select(columns).collect())
    trend = serving.peak_trend(spark.read.parquet(f"{out}/monthly_peak"))
    assert {r.year for r in trend.collect()} == {1995, 1996}


@pytest.mark.parametrize("job", ["popularity", "stations", "balance", "slow-taxi"])
def test_jobs_ask_for_what_they_need(job, capsys):
    with pytest.raises(SystemExit):
        main([job, "--out", "x"])
    assert f"{job} needs --trips" in capsys.readouterr().err


def test_a_rerun_replaces_what_it_owns(spark, tmp_path):
    path = str(tmp_path / "table")
    table = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select("n", "year", "frame").collect())
    rows = lambda *own: spark.createDataFrame(own, "n int, year int, frame string")
    replace_partitions(rows((1, 2015, "a"), (2, 2016, "a"), (3, 2016, "b")), path, ["year", "frame"])
    replace_partitions(rows((4, 2016, "b")), path, ["year", "frame"], [2016])
    assert table() == [(1, 2015, "a"), (4, 2016, "b")]
    with pytest.raises(Exception, match="not owned"):
        replace_partitions(rows((5, 2016, "a"), (6, 2014, "a")), path, ["year", "frame"], [2016])
    assert table() == [(1, 2015, "a"), (4, 2016, "b")]
    replace_partitions(rows((7, 2016, "a")).limit(0), path, ["year", "frame"], [2016])
    assert table() == [(1, 2015, "a")]
    replace_partitions(rows((8, 2017, "c")), path, ["year", "frame"])
    assert table() == [(8, 2017, "c")]


def test_jobs_read_times_as_published_files_write_them(spark, tmp_path):
    rides = fx.trips(spark, SF_DIR).limit(200)
    text = {c: F.date_format(c, "M/d/yyyy HH:mm:ss") for c in ("starttime", "stoptime")}
    write_table(rides.withColumns(text), str(tmp_path / "in"), "csv")
    write_table(rides.withColumns({c: F.date_trunc("second", c).cast("timestamp_ntz") for c in text}), str(tmp_path / "typed"))
    options = {"formats": ["M/d/yyyy HH:mm:ss"], "bad": "error", "zone": None}
    jobs.popularity_tables(spark, str(tmp_path / "in"), str(tmp_path / "a"), None, "csv", **options)
    jobs.popularity_tables(spark, str(tmp_path / "typed"), str(tmp_path / "b"))
    found = [
        sorted(map(str, spark.read.parquet(f"{tmp_path}/{x}/top_stations").collect())) for x in "ab"
    ]
    assert found[0] == found[1] != []


POPULARITY = ("monthly_peak", "top_stations", "hourly_activity")


def _results(spark, out):
    tables = {t: spark.read.parquet(f"{out}/{t}") for t in POPULARITY}
    return {t: sorted(map(str, df.select(sorted(df.columns)).collect())) for t, df in tables.items()}


def test_late_files_are_added_to_the_counts_once(spark, tmp_path):
    root, out, whole = (str(tmp_path / x) for x in ("all trips [x]", "out", "whole"))
    rides = fx.trips_long(spark, SF_DIR)
    parts = [
        rides.filter("year(stoptime) < 1997"),
        rides.filter("year(stoptime) = 1996 or stoptime is null").limit(500),
        rides.filter("year(stoptime) >= 1997").withColumn(
            "stoptime", F.expr("if(start_station_id % 50 = 0, null, stoptime)")
        ),
    ]
    for i, part in enumerate(parts):
        write_table(part.coalesce(2), f"{root}/{i}")
    root = root.replace("[x]", "*")
    assert len(jobs.add_trip_files(spark, f"{root}/0", out)) > 0
    old = _results(spark, out)
    assert jobs.add_trip_files(spark, f"{root}/0", out) == []
    assert _results(spark, out) == old
    assert len(jobs.add_trip_files(spark, f"{root}/1", out)) > 0
    # Files of all folders: only those of the last are new.
    added = jobs.add_trip_files(spark, f"{root}/*", out)
    assert added and all("/2/" in f for f in added)
    jobs.popularity_tables(spark, f"{root}/*", whole)
    assert _results(spark, out) == _results(spark, whole)
    with pytest.raises(ValueError, match="grows by files"):
        jobs.popularity_tables(spark, f"{root}/0", out)
    with pytest.raises(ValueError, match="whole runs"):
        jobs.add_trip_files(spark, f"{root}/0", whole)


def test_a_failed_addition_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    root, out, whole = (str(tmp_path / x) for x in ("in", "out", "whole"))
    rides = fx.trips_long(spark, SF_DIR).filter("year(stoptime) in (1996, 1997)")
    for i in range(2):
        write_table(rides.filter(f"start_station_id % 2 = {i}").coalesce(1), f"{root}/{i}")
    with monkeypatch.context() as patch:
        def fail(*_):
            raise RuntimeError("lost")

        patch.setattr(jobs.popularity, "top_from_hourly", fail)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.add_trip_files(spark, f"{root}/0", out)
    # hourly_activity is there, its files are not recorded.
    added = jobs.add_trip_files(spark, f"{root}/*", out)
    assert len(added) == 2
    jobs.popularity_tables(spark, f"{root}/*", whole)
    assert _results(spark, out) == _results(spark, whole)


@pytest.fixture
def job_session(spark, monkeypatch):
    """The session with the settings of jobs, as far as results depend on them."""
    monkeypatch.setattr("velometry.__main__.build_session", lambda: spark)
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    yield spark
    spark.conf.unset("spark.sql.timestampType")


def test_a_job_sets_refused_rows_apart(job_session, tmp_path):
    spark = job_session
    write_table(fx.faulty_trips(spark, SF_DIR).limit(300), str(tmp_path / "in"), "csv")
    out = str(tmp_path / "out")
    args = ["popularity", "--trips", str(tmp_path / "in"), "--format", "csv", "--out", out]
    times = ["--time-format", "dd/MM/yyyy HH:mm:ss", "--bad", "refuse"]
    with pytest.raises(ValueError, match="of 300 rows cannot be read"):
        jobs.popularity_tables(
            spark, str(tmp_path / "in"), out, None, "csv",
            formats=["dd/MM/yyyy HH:mm:ss"], bad="refuse", max_refused=0.0,
        )
    main([*args, *times, "--max-refused", "0.9"])
    counted = spark.read.parquet(f"{out}/hourly_activity").agg(F.sum("count")).first()[0]
    refused = refused_cells(spark, f"{out}/sifted/trips").select("row").distinct().count()
    assert 0 < refused < 300 and counted == 2 * (300 - refused)
    # Both kinds of session read the same times.
    sifted = spark.read.parquet(f"{out}/sifted/trips").filter("accepted = 'true'")
    spark.conf.unset("spark.sql.timestampType")
    raw = read_table(spark, str(tmp_path / "in"), "csv")
    again = readers.conform(raw, TRIPS, bad="null", formats=["dd/MM/yyyy HH:mm:ss"])
    times = ["starttime", "stoptime"]
    assert sifted.select(times).exceptAll(again.select(times)).count() == 0
