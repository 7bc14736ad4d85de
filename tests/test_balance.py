from datetime import date

import pytest
from frames import hours, rows, stations, trips
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from velometry.operators import balance
from velometry.operators.stations import active_stations

DAY = "2016-05-02"


def _ride(a, b, out="09:00:00", back="09:30:00"):
    return (f"{DAY} {out}", f"{DAY} {back}", a, b)


def test_nameless_and_timeless_ends_do_not_count(spark):
    rides = trips(
        spark, _ride("A", None), _ride("B", "A"), (f"{DAY} 09:00:00", None, "A", "B")
    )
    moves = rows(balance.hourly_movements(rides), "name", "departures", "arrivals")
    assert moves == [("A", 2, 1), ("B", 1, 0)]


def test_one_sided_hours_only_with_full(spark):
    rides = trips(spark, _ride("A", "B"), _ride("A", "B"))
    assert rows(balance.hourly_net_flow(rides)) == []
    full = balance.hourly_net_flow(rides, how="full")
    assert rows(full, "name", "hourly_bike_movement") == [("A", -2), ("B", 2)]
    with pytest.raises(ValueError):
        balance.hourly_net_flow(rides, how="left")


def test_balanced_hours_are_left_out(spark):
    rides = trips(spark, _ride("A", "B"), _ride("B", "A"))
    assert rows(balance.hourly_net_flow(rides)) == []


def test_one_sided_counts(spark):
    rides = trips(spark, _ride("A", "B"), _ride("A", None))
    assert rows(balance.hourly_departures(rides), "name", "departures") == [("A", 2)]
    assert ("B", 1) in rows(balance.hourly_arrivals(rides), "name", "arrivals")


def test_days_limit_both_ends(spark):
    night = ("2016-05-01 23:50:00", "2016-05-02 00:10:00", "A", "B")
    back = ("2016-05-02 00:20:00", "2016-05-02 00:30:00", "B", "B")
    rides = trips(spark, night, back, back)
    whole = balance.hourly_movements(rides).filter(F.col("date") == F.lit(DAY).cast("date"))
    assert rows(balance.hourly_movements(rides, (DAY, DAY))) == rows(whole) != []


def _flow(spark, *moves):
    return hours(spark, *((n, DAY, h, m, None, None) for n, h, m in moves)).drop(
        "latitude", "longitude"
    )


def test_shortage_edge(spark):
    docks = stations(spark, (1, "A", 40.7, -74.0, 9, 4), (2, "B", 40.7, -74.0, 9, 4))
    flow = _flow(spark, ("A", 8, -5), ("A", 9, 1), ("B", 8, -3))
    assert rows(balance.shortage_hours(flow, docks), "name", "hour") == [("A", 8), ("A", 9)]
    assert rows(balance.shortage_days(flow, docks), "name", "filled_rate") == [("A", 0.0)]


def test_overload_edge(spark):
    docks = stations(spark, (1, "A", 40.7, -74.0, 5, 3), (2, "B", 40.7, -74.0, 6, 3))
    flow = _flow(spark, ("A", 8, 2), ("B", 8, 2))
    assert rows(balance.overload_hours(flow, docks), "name") == [("A",)]
    assert rows(balance.overload_days(flow, docks), "name", "filled_rate") == [("A", 1.0)]


def test_empty_stock_and_no_docks_are_dropped_without_error(spark):
    docks = stations(spark, (1, "A", 40.7, -74.0, 0, 0))
    assert rows(balance.shortage_hours(_flow(spark, ("A", 8, -5)), docks)) == []
    assert rows(balance.overload_hours(_flow(spark, ("A", 8, 5)), docks)) == []


def test_active_station_comes_once(spark):
    docks = stations(spark, (1, "A", 40.7, -74.0, 5, 3), (2, "Z", 40.7, -74.0, 6, 3))
    rides = trips(spark, _ride("A", "Z")).union(
        trips(spark, _ride("A", "Z"), places={"A": (40.8, -74.1), "Z": (0.0, 0.0)})
    )
    assert rows(active_stations(docks, rides), "name") == [("A",)]


def _stock(spark, moves, n=24, available=2, docks=None):
    docks = docks or stations(spark, (1, "A", 40.7, -74.0, 5, available))
    short = hours(spark, *(("A", DAY, h, m, 40.7, -74.0) for h, m in moves))
    return balance.hourly_stock(short, docks, hours=n).orderBy("hour").collect()


def test_running_stock(spark):
    stock = _stock(spark, [(3, -2), (5, 1)])
    assert [r.hour for r in stock] == list(range(24))
    assert [r.stock for r in stock] == [2, 2, 2, 0, 0] + [1] * 19
    assert [r.hour for r in stock if r.is_short] == [3, 4]


@pytest.mark.parametrize("moves", [[(0, -1)], [(23, -2)], [(22, -1), (23, -1)], [(0, -1), (1, -1)]])
@pytest.mark.parametrize("n", [23, 24])
def test_running_stock_at_the_ends_of_the_day(spark, moves, n):
    flows = dict(moves)
    expected = [2 + sum(m for h, m in flows.items() if h <= hour) for hour in range(n)]
    stock = _stock(spark, moves, n)
    assert [(r.hour, r.stock) for r in stock] == list(enumerate(expected))


def test_stock_counts_an_hour_once_for_a_station_listed_twice(spark):
    docks = stations(spark, (1, "A", 40.7, -74.0, 5, 2), (2, "A", 40.8, -74.0, 5, 9))
    stock = _stock(spark, [(3, -2), (3, -2), (5, 1), (5, 1)], docks=docks)
    assert [r.stock for r in stock] == [2, 2, 2, 0, 0] + [1] * 19


def test_stock_of_no_rows_is_empty(spark):
    assert _stock(spark, []) == []


_RIDES = st.lists(
    st.tuples(
        st.sampled_from("ABC"), st.sampled_from("ABC"), st.integers(0, 3), st.integers(0, 3)
    ),
    min_size=1,
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rides=_RIDES, data=st.data())
def test_flow_properties(spark, rides, data):
    made = [_ride(a, b, f"{h:02d}:05:00", f"{min(23, h + d):02d}:55:00") for a, b, h, d in rides]
    shuffled = data.draw(st.permutations(made))
    flow = balance.hourly_net_flow(trips(spark, *made))
    hourly = rows(flow, "name", "date", "hour", "hourly_bike_movement")
    assert hourly == rows(balance.hourly_net_flow(trips(spark, *shuffled)))
    # Brute force over the rides.
    counts = {}
    for start, stop, a, b in made:
        counts.setdefault((a, int(start[11:13])), [0, 0])[0] += 1
        counts.setdefault((b, int(stop[11:13])), [0, 0])[1] += 1
    day = date.fromisoformat(DAY)
    expected = [
        (n, day, h, i - o) for (n, h), (o, i) in counts.items() if o and i and o != i
    ]
    assert hourly == sorted(expected)
    daily = {}
    for n, _, _, m in expected:
        daily[n] = daily.get(n, 0) + m
    assert dict(rows(balance.daily_net_flow(flow), "name", "bike_movement")) == daily
    docks = stations(spark, *((i, n, 40.7, -74.0, 2, 1) for i, n in enumerate("ABC")))
    short = {r[0] for r in rows(balance.shortage_hours(flow, docks), "name")}
    over = {r[0] for r in rows(balance.overload_hours(flow, docks), "name")}
    assert short == {n for n, m in daily.items() if m <= -1}
    assert over == {n for n, m in daily.items() if m >= 1}
