"""The named queries once more as plain SQL, written independently of Spark.

Every statement stands alone: it starts with the common table expressions it
needs.
"""

from __future__ import annotations

import re

from velometry.plans.catalogue import parameters

# Common table expressions, each after those it uses.
_CTES = {
    "stations": """
        select cast(n_nationkey as bigint) as id, n_name as name,
               round(40.70::double + 0.012::double * n_nationkey, 6) as latitude,
               round(-74.00::double + 0.007::double * ((n_nationkey * 3) % 10), 6) as longitude,
               cast(n_regionkey as bigint) as rid,
               cast(n_nationkey % 3 + n_nationkey % 4 as int) as capacity,
               cast(n_nationkey % 3 as int) as num_bikes_available,
               cast(n_nationkey % 2 as int) as num_bikes_disabled
        from nation""",
    "trips": """
        select starttime, stoptime, sid, 'NATION_' || sid as s_name,
               round(40.70::double + 0.012::double * sid, 6) as s_lat,
               round(-74.00::double + 0.007::double * ((sid * 3) % 10), 6) as s_lon,
               'NATION_' || eid as e_name,
               round(40.70::double + 0.012::double * eid, 6) as e_lat,
               round(-74.00::double + 0.007::double * ((eid * 3) % 10), 6) as e_lon
        from (select ts as starttime, ts + to_minutes(cast(floor(value) as bigint)) as stoptime,
                     user_id % 23 as sid,
                     least(event_id % 23, (event_id * 7 + 3) % 25) as eid
              from events)""",
    "items": """
        select *, l_shipdate + to_hours((l_orderkey * 7 + l_linenumber * 5) % 24) as moment
        from lineitem""",
    "trips_long": """
        select moment as starttime, moment + to_minutes(cast(l_quantity as bigint)) as stoptime,
               'ST' || l_suppkey as s_name,
               round(40.70::double + 0.0006::double * l_suppkey, 6) as s_lat,
               round(-74.00::double + 0.0003::double * l_suppkey, 6) as s_lon,
               'ST' || (l_partkey // 20) as e_name,
               round(40.70::double + 0.0006::double * (l_partkey // 20), 6) as e_lat,
               round(-74.00::double + 0.0003::double * (l_partkey // 20), 6) as e_lon
        from items""",
    "taxi": """
        select moment as pickup_datetime, moment + to_seconds(cast(travel_time as bigint)) as dropoff_datetime,
               case when l_linenumber <> 7
                    then round(40.66::double + ((l_orderkey * 31 + l_linenumber) % 180) / 1000::double, 6)
               end as pickup_latitude,
               round(-74.11::double + ((l_partkey * 17) % 200) / 1000::double, 6) as pickup_longitude,
               round(40.66::double + ((l_suppkey * 53 + l_linenumber) % 180) / 1000::double, 6)
                   as dropoff_latitude,
               round(-74.11::double + ((l_orderkey * 19) % 200) / 1000::double, 6) as dropoff_longitude,
               l_quantity / 5::double as trip_distance, travel_time,
               l_linenumber as passenger_count,
               cast(1 + l_orderkey % 3 as int) as rate_code,
               cast(1 + l_partkey % 2 as int) as payment_type,
               l_extendedprice / 1000::double as fare_amount, l_discount as extra,
               0.5::double + 0.1::double * (l_suppkey % 2) as mta_tax, l_tax as tip_amount,
               l_extendedprice / 1000::double + l_tax + l_discount as total_amount,
               cast(l_suppkey % 3 as double) as tolls_amount,
               0.3::double * (l_partkey % 2) as imp_surcharge
        from (select *, cast(60 + (l_partkey * 13 + l_orderkey * 7) % 3600 as double) as travel_time
              from items)""",
    "faulty": """
        select *, second(starttime) = 13 as bad_time, sid = 7 as bad_station,
               strftime(stoptime, '%S')[2] = '5' and strftime(stoptime, '%M')[2] = '3' as bad_place
        from trips""",
    # popularity: one row per trip end
    "ends_long": """
        select 'start' as direction, s_name as name, s_lat as latitude, s_lon as longitude,
               cast(year(stoptime) as int) as year, cast(month(stoptime) as int) as month,
               hour(starttime) as h
        from trips_long
        union all
        select 'end', e_name, e_lat, e_lon,
               cast(year(stoptime) as int), cast(month(stoptime) as int), hour(starttime)
        from trips_long""",
    "activity": """
        select year, month, name, latitude, longitude, count(*) as count
        from ends_long group by year, month, direction, name, latitude, longitude""",
    "peak": """
        select a.* from activity a
        where count = (select max(b.count) from activity b
                       where b.year = a.year and b.month = a.month)""",
    "framed": """
        select *, 'morning' as frame from ends_long where h between 7 and 12
        union all
        select *, 'afternoon' as frame from ends_long where h between 12 and 19
        union all
        select *, 'evening' as frame from ends_long where h between 19 and 23 or h between 0 and 7""",
    "top": """
        select * from (
            select *, cast(rank() over (partition by year, frame, month order by count desc) as int)
                          as rank
            from (select year, frame, month, name, latitude, longitude, count(*) as count
                  from framed
                  group by year, frame, month, direction, name, latitude, longitude))
        where rank <= 10""",
    # balance
    "departures": """
        select s_name as name, cast(starttime as date) as date, cast(hour(starttime) as int) as hour,
               count(*) as departures
        from trips group by all""",
    "arrivals": """
        select e_name as name, cast(stoptime as date) as date, cast(hour(stoptime) as int) as hour,
               count(*) as arrivals
        from trips group by all""",
    "hourly": """
        select name, date, hour, arrivals - departures as hourly_bike_movement
        from departures join arrivals using (name, date, hour)
        where arrivals <> departures""",
    "daily": """
        select name, date, cast(sum(hourly_bike_movement) as bigint) as bike_movement
        from hourly group by name, date""",
    "short_days": """
        select d.name, date, bike_movement,
               (num_bikes_available + bike_movement) / num_bikes_available::double as filled_rate,
               latitude, longitude
        from daily d join stations s on s.name = d.name
        where bike_movement < 0 and num_bikes_available <> 0
          and (num_bikes_available + bike_movement) / num_bikes_available::double <= 0.001""",
    "over_days": """
        select d.name, date, bike_movement,
               (num_bikes_available + bike_movement) / capacity::double as filled_rate,
               latitude, longitude
        from daily d join stations s on s.name = d.name
        where bike_movement > 0 and capacity <> 0
          and (num_bikes_available + bike_movement) / capacity::double >= 1""",
    "short": """
        select h.name, h.date, hour, hourly_bike_movement, latitude, longitude
        from short_days d join hourly h on h.name = d.name and h.date = d.date""",
    "over": """
        select h.name, h.date, hour, hourly_bike_movement, latitude, longitude
        from over_days d join hourly h on h.name = d.name and h.date = d.date""",
    "grid": """
        select name, date, cast(range as int) as hour
        from (select distinct name, date from short), range(24)""",
    "stock": """
        select name, date, hour, stock, stock / opening::double <= 0.001 as is_short
        from (select g.name, g.date, g.hour, num_bikes_available as opening,
                     cast(num_bikes_available
                          + sum(coalesce(hourly_bike_movement, 0))
                            over (partition by g.name, g.date order by g.hour) as bigint) as stock
              from grid g
              left join short s on s.name = g.name and s.date = g.date and s.hour = g.hour
              join stations t on t.name = g.name)""",
    # supply
    "pairs": """
        select s.date, s.hour, s.name as start_station_name,
               s.latitude as start_latitude, s.longitude as start_longitude,
               o.name as near_station_name,
               o.latitude as near_latitude, o.longitude as near_longitude,
               2 * 6373 * asin(sqrt(
                   pow(sin(radians(o.latitude - s.latitude) / 2), 2)
                   + cos(radians(s.latitude)) * cos(radians(o.latitude))
                     * pow(sin(radians(o.longitude - s.longitude) / 2), 2))) as km
        from short s join over o on o.date = s.date and o.hour = s.hour""",
    "placed": """
        select *, row_number() over (partition by date, hour, start_station_name
                                     order by floor(km * 1e6), near_station_name) as place
        from pairs""",
    "nearby": """
        select date, hour, start_station_name,
               string_agg(near_station_name, '|' order by place) as nearby_stations
        from placed group by date, hour, start_station_name""",
    "nearby5": """
        select date, hour, start_station_name,
               string_agg(near_station_name, '|' order by place) as nearby_stations
        from placed where place <= {top_n} group by date, hour, start_station_name""",
    # crowded hours
    "customers": """
        select 'C' || c_custkey as name, c_custkey as id, date '{day}' as date,
               case when c_custkey % 3 = 0 then 9 else 10 end as hour,
               (40700000 + (c_custkey * 7919) % 20011) / 1000000::double as latitude,
               (-74000000 + (c_custkey * 4729) % 30011) / 1000000::double as longitude
        from customer""",
    "vectors": """
        select *, cos(radians(latitude)) * cos(radians(longitude)) as x,
               cos(radians(latitude)) * sin(radians(longitude)) as y, sin(radians(latitude)) as z
        from customers""",
    "dense_pairs": """
        select s.date, s.hour, s.name as start_station_name,
               s.latitude as start_latitude, s.longitude as start_longitude,
               o.name as near_station_name,
               o.latitude as near_latitude, o.longitude as near_longitude,
               2 * 6373 * asin(sqrt(
                   pow(sin(radians(o.latitude - s.latitude) / 2), 2)
                   + cos(radians(s.latitude)) * cos(radians(o.latitude))
                     * pow(sin(radians(o.longitude - s.longitude) / 2), 2))) as km,
               floor(sqrt((s.x - o.x) * (s.x - o.x) + (s.y - o.y) * (s.y - o.y)
                          + (s.z - o.z) * (s.z - o.z)) * 6373000000) as mm
        from vectors s join vectors o on o.date = s.date and o.hour = s.hour
        where s.id % 2 = 0 and o.id % 2 = 1""",
    "dense_placed": """
        select *, row_number() over (partition by date, hour, start_station_name
                                     order by mm, near_station_name) as place
        from dense_pairs""",
    "zone_trips": """
        select l_orderkey % 4 as zone, l_partkey % 4 as goal,
               (407000 + 300 * (l_orderkey % 4) + l_partkey % 7) / 10000::double as p_lat,
               (-740000 + 300 * ((l_orderkey * 3) % 4) + l_suppkey % 5) / 10000::double as p_lon,
               (407000 + 300 * (l_partkey % 4) + l_orderkey % 7) / 10000::double as d_lat,
               (-740000 + 300 * ((l_partkey * 3) % 4) + l_linenumber % 5) / 10000::double as d_lon
        from lineitem""",
    "zone_centres": """
        select cast(4 as int) as k, avg(p_lat) as latitude, avg(p_lon) as longitude
        from zone_trips group by zone""",
    # taxi
    "od": """
        select s_name as start_station_name, e_name as end_station_name,
               s_lat as start_station_latitude, s_lon as start_station_longitude,
               e_lat as end_station_latitude, e_lon as end_station_longitude,
               count(*) as count,
               case when s_lat = e_lat and s_lon = e_lon then 0 else
               6371 * acos(greatest(-1, least(1,
                   sin(radians(s_lat)) * sin(radians(e_lat))
                   + cos(radians(s_lat)) * cos(radians(e_lat)) * cos(radians(s_lon) - radians(e_lon)))))
               end as km
        from trips where year(starttime) = {bike_year} group by all""",
    "median": "select quantile_disc(round(km), 0.5) * 0.621371::double as miles from od",
    "short_taxi": """
        select * from taxi
        where trip_distance < (select miles from median)
          and pickup_latitude is not null and pickup_longitude is not null
          and dropoff_latitude is not null and dropoff_longitude is not null""",
    "moving": "select *, trip_distance / nullif(travel_time, 0) as velocity from short_taxi",
    "limits": "select quantile_disc(velocity, 0.2) as velocity from moving",
    "slow_taxi": "select * from moving where velocity <= (select velocity from limits)",
    # an exact share by the hash of the row
    "featured": """
        select travel_time / 60 as label, cast(hour(pickup_datetime) as int) as pickup_hour,
               cast(month(pickup_datetime) as int) as pickup_month,
               trip_distance / (travel_time / 60 / 60) as speed_mph,
               columns(lambda c: c in ('passenger_count', 'trip_distance', 'rate_code', 'payment_type',
                                  'fare_amount', 'extra', 'mta_tax', 'tip_amount', 'total_amount',
                                  'travel_time', 'tolls_amount', 'imp_surcharge', 'velocity'))
        from slow_taxi where trip_distance < 20 and travel_time > 0""",
    "sided": """
        select *, row_number() over (order by hash) <= floor(0.75 * count(*) over () + 0.5)
                      as trained
        from (select *, {featured_hash} as hash from featured)""",
    # a straight line through the durations
    "durations": """
        select travel_time / 60 as label, trip_distance, passenger_count % 4 = 0 as held
        from taxi where trip_distance < 20 and travel_time > 0 and pickup_latitude is not null""",
    "line": """
        select regr_slope(label, trip_distance) as slope,
               regr_intercept(label, trip_distance) as base, stddev_samp(trip_distance) as spread
        from durations where not held""",
    "predicted": """
        select trip_distance, label, base + slope * trip_distance as prediction
        from durations cross join line where held""",
}

def _hash(seed: int, columns: str) -> str:
    """The hash that draws rows: numbers in whole millionths, null empty."""
    cells = [
        f"coalesce(cast(cast(floor(cast({c} as double) * 1000000 + 0.5) as bigint) as varchar), '')"
        for c in columns.split()
    ]
    return f"md5(concat_ws('|', '{seed}', {', '.join(cells)}))"


_TAXI = (
    "pickup_datetime, dropoff_datetime, pickup_latitude, pickup_longitude, "
    "dropoff_latitude, dropoff_longitude, trip_distance, travel_time"
)
_IN_BOX = (
    "trip_distance < 10 and pickup_latitude > 40.674611 and pickup_latitude < 40.817894 "
    "and pickup_longitude > -74.104557 and pickup_longitude < -73.92718"
)
_TOP_FRAME = (
    "select year, frame, month, name, latitude, longitude, count, rank from top "
    "where year = {popular_year} and frame = '%s'"
)
_ON_DAY = "date = date '{day}'"

_SELECTS = {
    "station_projection": "select * from stations",
    "taxi_first_n": """
        select pickup_datetime, dropoff_datetime, trip_distance, travel_time from taxi
        order by 1, 2, 3, 4 limit {first_n}""",
    "taxi_travel_time": """
        select pickup_datetime, dropoff_datetime,
               cast(epoch(dropoff_datetime - pickup_datetime) as double) as travel_time
        from taxi""",
    "trip_time_parts": """
        select starttime, stoptime,
               cast(starttime as date) as start_date, cast(hour(starttime) as int) as start_hour,
               cast(stoptime as date) as end_date, cast(hour(stoptime) as int) as end_hour,
               cast(month(stoptime) as int) as month, cast(year(stoptime) as int) as year
        from trips""",
    "trips_in_year": """
        select starttime, stoptime, s_name as start_station_name, e_name as end_station_name
        from trips_long where year(stoptime) = {popular_year}""",
    "station_activity": "select * from activity where year = {popular_year}",
    "station_activity_combined": """
        select year, month, name, latitude, longitude, count(*) as count from ends_long
        where year = {popular_year} group by all""",
    "monthly_peak": "select * from peak where year = {popular_year}",
    "top_morning": _TOP_FRAME % "morning",
    "top_afternoon": _TOP_FRAME % "afternoon",
    "top_evening": _TOP_FRAME % "evening",
    "top_all_frames": "select year, frame, month, name, latitude, longitude, count, rank from top",
    "hourly_activity": """
        select year, month, cast(h as int) as hour, direction, name, latitude, longitude,
               count(*) as count
        from ends_long where year = {popular_year} group by all""",
    "top_from_hourly": """
        select year, frame, month, name, latitude, longitude, count, rank from top
        where year = {popular_year}""",
    "peak_trend": """
        select year, month, monthname(make_date(2000, month, 1)) as month_name,
               name, latitude, longitude, count
        from peak order by year, month, name""",
    "peak_trend_year": """
        select year, month, monthname(make_date(2000, month, 1)) as month_name,
               name, latitude, longitude, count
        from peak where year = {popular_year} order by year, month, name""",
    "top_for_month": (_TOP_FRAME % "evening") + " and month = 3",
    "count_range": """
        select least(0, min(count)) as low, greatest(0, max(count)) as high from peak""",
    "month_names": """
        select distinct cast(month(stoptime) as int) as month, monthname(stoptime) as month_name,
               cast(month(stoptime) as int) as month_number
        from trips_long""",
    "station_start_counts": """
        select sid as start_station_id, s_name as start_station_name,
               s_lon as start_station_longitude, s_lat as start_station_latitude,
               count(*) as starts
        from trips group by all""",
    "active_stations": """
        select id, name, latitude, longitude, capacity, num_bikes_available, num_bikes_disabled
        from stations where name in (select s_name from trips)""",
    "station_location": """
        select name, latitude, longitude from stations
        where name = '{station}' and name in (select s_name from trips)""",
    "all_stations": """
        select name, longitude, latitude from stations where name in (select s_name from trips)""",
    "hourly_departures": "select * from departures",
    "hourly_arrivals": "select * from arrivals",
    "hourly_net_flow": "select * from hourly",
    "hourly_net_flow_full": """
        select name, date, hour,
               coalesce(arrivals, 0) - coalesce(departures, 0) as hourly_bike_movement
        from departures full join arrivals using (name, date, hour)
        where coalesce(arrivals, 0) <> coalesce(departures, 0)""",
    "daily_net_flow": "select * from daily",
    "daily_deficit": "select * from daily where bike_movement < 0",
    "daily_surplus": "select * from daily where bike_movement > 0",
    "shortage_days": "select * replace (round(filled_rate, 6) as filled_rate) from short_days",
    "overload_days": "select * replace (round(filled_rate, 6) as filled_rate) from over_days",
    "shortage_hours": "select * from short",
    "overload_hours": "select * from over",
    "hourly_stock": "select * from stock",
    "hourly_stock_to_22": "select * from stock where hour < 23",
    "hourly_stock_for_station": f"""
        select * from stock where {_ON_DAY} and name = '{{station}}' order by hour""",
    "shortage_stations_on": f"select distinct name from short where {_ON_DAY} order by name",
    "overload_stations_on": f"select distinct name from over where {_ON_DAY} order by name",
    "first_station_on": f"""
        select distinct name from short where {_ON_DAY} order by name limit 1""",
    "map_points": f"""
        select distinct name, 'short' as kind, latitude, longitude from short where {_ON_DAY}
        union all
        select distinct name, 'overload' as kind, latitude, longitude from over where {_ON_DAY}""",
    "supply_pairs": "select * replace (round(km, 6) as km) from pairs",
    "supply_within_km": "select * replace (round(km, 6) as km) from pairs where km < {max_km}",
    "nearby_supply": "select * from nearby",
    "nearby_top5": "select * from nearby5",
    "nearby_supply_for": f"""
        select * from nearby5
        where {_ON_DAY} and hour = {{hour}} and start_station_name = '{{station}}'""",
    "dense_within_km": """
        select * exclude (mm) replace (round(km, 6) as km) from dense_pairs
        where km < {dense_km}""",
    "dense_supply_pairs": """
        select start_station_name, count(*) as pairs, round(sum(km), 6) as km,
               min(round(km, 6)) as nearest_km
        from dense_pairs group by start_station_name""",
    "dense_nearby_supply": """
        select date, hour, start_station_name,
               string_agg(near_station_name, '|' order by place) as nearby_stations
        from dense_placed group by all""",
    "dense_nearby_top5": """
        select date, hour, start_station_name,
               string_agg(near_station_name, '|' order by place) as nearby_stations
        from dense_placed where place <= {top_n} group by all""",
    "dense_nearby_for": """
        select date, hour, start_station_name,
               string_agg(near_station_name, '|' order by place) as nearby_stations
        from dense_placed
        where place <= {top_n} and hour = 10 and start_station_name = '{dense_station}'
        group by all""",
    "text_times": """
        select date_trunc('second', starttime) as starttime,
               date_trunc('second', stoptime) as stoptime,
               sid as start_station_id, s_lat as start_station_latitude
        from trips""",
    "refused_cells": """
        select 'starttime' as "column", 'noon' as cell, 'not a time' as reason,
               strftime(stoptime, '%Y-%m-%d %H:%M:%S') as stoptime, e_name as end_station_name
        from faulty where bad_time
        union all
        select 'start_station_id', '7.0 (closed)', 'not a whole number in range',
               strftime(stoptime, '%Y-%m-%d %H:%M:%S'), e_name
        from faulty where bad_station
        union all
        select 'start_station_latitude', replace(cast(s_lat as varchar), '.', ','), 'not a number',
               strftime(stoptime, '%Y-%m-%d %H:%M:%S'), e_name
        from faulty where bad_place""",
    "accepted_trips": """
        select date_trunc('second', starttime) as starttime,
               date_trunc('second', stoptime) as stoptime,
               sid as start_station_id, s_lat as start_station_latitude
        from faulty where not (bad_time or bad_station or bad_place)""",
    "hourly_activity_merged": """
        select year, month, cast(h as int) as hour, name, latitude, longitude, count(*) as count
        from ends_long group by year, month, h, direction, name, latitude, longitude""",
    "velocity_sketches": """
        select cast(year(pickup_datetime) as int) as year, count(*) as n, true as within
        from short_taxi where trip_distance / nullif(travel_time, 0) is not null
        group by all""",
    "recommend_zones": """
        select k, round(latitude, 6) as latitude, round(longitude, 6) as longitude
        from zone_centres""",
    "recommend_zones_steady": """
        select k, cast(row_number() over (order by latitude, longitude) - 1 as int) as cluster_id,
               round(latitude, 6) as latitude, round(longitude, 6) as longitude
        from zone_centres""",
    "new_stations_zones": """
        select round(longitude, 6) as longitude, round(latitude, 6) as latitude
        from zone_centres where k = 4""",
    "pickup_zones": """
        select p_lat as latitude, p_lon as longitude, least.p_lat as zone_latitude,
               least.p_lon as zone_longitude, count(*) as trips
        from (select *, min(struct_pack(p_lat := p_lat, p_lon := p_lon)) over (partition by zone) as least
              from zone_trips) group by all""",
    "dropoff_zones": """
        select d_lat as latitude, d_lon as longitude, least.d_lat as zone_latitude,
               least.d_lon as zone_longitude, count(*) as trips
        from (select *, min(struct_pack(d_lat := d_lat, d_lon := d_lon)) over (partition by goal) as least
              from zone_trips) group by all""",
    "duration_line": """
        select trip_distance, round(label, 6) as label, round(prediction, 6) as prediction
        from predicted""",
    "duration_line_rmse": """
        select round(sqrt(avg(pow(prediction - label, 2))), 6) as rmse from predicted""",
    "duration_scaled": """
        select trip_distance, round(trip_distance / spread, 6) as scaled
        from durations cross join line where held""",
    "supply_segments": """
        select date, hour, start_station_name, start_latitude, start_longitude,
               near_station_name, near_latitude, near_longitude, cast(place as int) as rank
        from placed where place <= {top_n}""",
    "parse_name_list": "select * from nearby",
    "parse_centres": """
        select date, cast(row_number() over (partition by date order by name) - 1 as int)
                         as cluster_id,
               latitude, longitude
        from (select distinct date, name, latitude, longitude from short)""",
    "od_pairs": "select * exclude (km), round(km) as dist from od",
    "od_distance": "select * exclude (km), round(km, 6) as dist from od",
    "median_trip_miles": "select round(miles, 6) as miles from median",
    "median_trip_miles_weighted": """
        select round(quantile_disc(km, 0.5) * 0.621371::double, 6) as miles
        from (select unnest(range(count)), km from od)""",
    "short_taxi": f"select {_TAXI} from short_taxi",
    "slow_taxi": f"select {_TAXI}, round(velocity, 6) as velocity from slow_taxi",
    "slow_velocity": "select round(velocity, 9) as velocity from limits",
    "taxi_in_bbox": f"select {_TAXI} from taxi where {_IN_BOX}",
    "taxi_clean": f"""
        select {_TAXI}, round(velocity, 6) as velocity from slow_taxi where {_IN_BOX}""",
    "cluster_totals": f"""
        select count(*) as trips, count(*) as labelled from slow_taxi where {_IN_BOX}""",
    "cluster_sample": f"""
        select pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude,
               trip_distance, round(velocity, 6) as velocity
        from (select *, row_number() over (order by {_hash(1, "pickup_latitude pickup_longitude "
                    "dropoff_latitude dropoff_longitude trip_distance velocity")}) as place,
                     count(*) over () as total
              from slow_taxi where {_IN_BOX})
        where place <= floor(0.1 * total + 0.5) and pickup_latitude <> 0""",
    "taxi_sample": f"""
        select trip_distance, pickup_latitude, pickup_longitude, passenger_count
        from (select *, row_number() over (order by {_hash(5, "trip_distance pickup_latitude "
                    "pickup_longitude passenger_count")}) as place,
                     count(*) over () as total
              from (select trip_distance, passenger_count,
                           coalesce(pickup_latitude, 0) as pickup_latitude,
                           coalesce(pickup_longitude, 0) as pickup_longitude from taxi))
        where place <= floor(total / 3::double + 0.5) and pickup_latitude <> 0""",
    "duration_split": """
        select if(trained, 'train', 'validation') as side, count(*) as trips
        from sided group by all""",
    "duration_split_rows": """
        select if(trained, 'train', 'validation') as side, round(label, 6) as label,
               trip_distance, round(total_amount, 6) as total_amount
        from sided""",
    "duration_penalised": """
        select way, round(weight, 2) as coefficient,
               round(mean_label - weight / spread * mean_time, 2) as intercept
        from (select *, y * greatest(covariance / spread / y - 0.3 / y * 0.8, 0)
                          / (variance / spread / spread + 0.3 / y * (1 - 0.8)) as weight
              from (select stddev_samp(label) as y, stddev_samp(travel_time) as spread,
                           var_pop(travel_time) as variance,
                           covar_pop(travel_time, label) as covariance,
                           avg(label) as mean_label, avg(travel_time) as mean_time
                    from sided where trained)),
             (select unnest(['fit', 'limit']) as way)""",
    "duration_split_total": """
        select count(*) as trips, round(sum(travel_time / 60), 3) as minutes
        from slow_taxi where trip_distance < 20 and travel_time > 0""",
    "duration_features": """
        select round(travel_time / 60, 6) as label, passenger_count, trip_distance, rate_code,
               payment_type, fare_amount, extra, mta_tax, tip_amount,
               round(total_amount, 6) as total_amount, travel_time, tolls_amount, imp_surcharge,
               round(velocity, 6) as velocity,
               cast(hour(pickup_datetime) as int) as pickup_hour,
               cast(month(pickup_datetime) as int) as pickup_month,
               round(trip_distance / (travel_time / 3600), 6) as speed_mph
        from slow_taxi where trip_distance < 20 and travel_time > 0""",
}


_FEATURED_HASH = _hash(
    1,
    "label passenger_count trip_distance rate_code payment_type fare_amount extra mta_tax "
    "tip_amount total_amount travel_time tolls_amount imp_surcharge velocity pickup_hour "
    "pickup_month speed_mph",
)


def _needed(sql: str) -> list[str]:
    """Names of the expressions ``sql`` uses, directly or not, in order."""
    wanted: set[str] = set()
    todo = [sql]
    while todo:
        used = set(re.findall(r"\b(?:from|join)\s+(\w+)", todo.pop())) & set(_CTES)
        todo += [_CTES[name] for name in used - wanted]
        wanted |= used
    return [name for name in _CTES if name in wanted]


def _statement(select: str) -> str:
    ctes = ",\n".join(f"{name} as ({_CTES[name].strip()})" for name in _needed(select))
    head = f"with {ctes}\n" if ctes else ""
    return (head + select.strip()).format(**parameters(), featured_hash=_FEATURED_HASH)


def all_sql() -> dict[str, str]:
    return {name: _statement(select) for name, select in _SELECTS.items()}
