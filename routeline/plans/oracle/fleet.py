"""Oracle SQL: vehicles, drivers, alerts."""

from __future__ import annotations

from routeline.plans.oracle.feeds import (
    ALERTS, GEOFENCES, VEHICLE_TELEMETRY, flat_km, haversine, hours_between, key,
    minutes_between, rounded, seconds_between, vehicle_positions,
)

SQL: dict[str, str] = {}

INSIDE = "(latitude between 8 and 37 and longitude between 68 and 97.5)"

STG_POSITIONS = f"""
select event_id, vehicle_id, driver_id, vehicle_type, event_timestamp, event_date, latitude,
  longitude, altitude_m as altitude_meters, accuracy_m as accuracy_meters, speed_kmh,
  heading as heading_degrees, trip_id, state as vehicle_state, fuel_level_pct, odometer_km,
  coalesce({INSIDE}, false) as is_valid_location,
  coalesce(speed_kmh between 0 and 200, false) as is_valid_speed,
  cast(hour(event_timestamp) as integer) as hour_of_day,
  cast(dayofweek(event_timestamp) as integer) as day_of_week,
  (hour(event_timestamp) in (8, 9, 10, 17, 18, 19, 20)) as is_peak_hour
from ({{src}}) where latitude is not null and longitude is not null"""

STG_ALERTS = f"""
select event_id, vehicle_id, driver_id, event_timestamp, event_date, event_type as alert_type,
  severity, latitude, longitude, speed as actual_speed_kmh, speed_limit as speed_limit_kmh,
  overspeed_by as overspeed_kmh, deceleration_ms2, acceleration_ms2,
  case when event_type = 'SPEEDING' then 'SAFETY' when event_type like 'HARSH%'
    then 'DRIVING_BEHAVIOR' else 'OTHER' end as alert_category,
  cast(list_position(['INFO', 'WARNING', 'HIGH', 'CRITICAL'], severity) as integer)
    as severity_score,
  cast(hour(event_timestamp) as integer) as hour_of_day
from ({ALERTS})"""

SQL["stg_vehicle_positions"] = rounded(
    STG_POSITIONS.format(src=vehicle_positions("raw", dirty=True)),
    "latitude longitude accuracy_meters speed_kmh heading_degrees fuel_level_pct odometer_km")
SQL["stg_alerts"] = rounded(
    STG_ALERTS, "latitude longitude actual_speed_kmh speed_limit_kmh overspeed_kmh "
                "deceleration_ms2 acceleration_ms2")
SQL["stg_vehicle_telemetry"] = rounded(f"""
select event_id, vehicle_id, event_timestamp, event_date, engine_rpm,
  engine_temp_c as engine_temp_celsius, oil_pressure_psi, coolant_temp_c as coolant_temp_celsius,
  fuel_level_pct, battery_voltage, odometer_km, engine_hours,
  case when engine_temp_c > 100 then 'OVERHEATING'
    when engine_temp_c < 60 and engine_rpm > 1000 then 'COLD_RUNNING' else 'NORMAL' end
    as engine_temp_status,
  case when oil_pressure_psi < 20 then 'LOW' when oil_pressure_psi > 80 then 'HIGH'
    else 'NORMAL' end as oil_pressure_status,
  case when battery_voltage < 12e0 then 'LOW' when battery_voltage > 145e-1 then 'OVERCHARGING'
    else 'NORMAL' end as battery_status,
  engine_rpm > 5000 as is_high_rpm
from ({VEHICLE_TELEMETRY})""",
    "engine_temp_celsius oil_pressure_psi coolant_temp_celsius fuel_level_pct battery_voltage "
    "odometer_km engine_hours")

SQL["bronze_validate"] = rounded(f"""
select event_id, vehicle_id, latitude, longitude, speed_kmh, {INSIDE} as is_valid_location,
  coalesce(speed_kmh between 0 and 200, true) as is_valid_speed
from ({vehicle_positions("raw", dirty=True)})""", "latitude longitude speed_kmh")

SQL["bronze_json_decode"] = rounded(f"""
select vehicle_id as kafka_key, event_id, vehicle_id, driver_id, latitude, longitude, speed_kmh,
  state, altitude_m, event_timestamp, event_date
from ({vehicle_positions("raw")})""", "latitude longitude speed_kmh")

_ORDER = "order by event_timestamp, event_id"


def _marked(src: str, state: str, where: str = "true") -> str:
    gap = minutes_between("prev_ts", "event_timestamp")
    return f"""
    select *, sum(cast(starts as integer)) over (partition by vehicle_id {_ORDER}
        rows between unbounded preceding and current row) as seq
    from (select *, coalesce(prev_ts is null or {gap} > 30
            or ({state} = 'MOVING' and prev_state in ('IDLE', 'STOPPED')), false) as starts
      from (select *, lag(event_timestamp) over w as prev_ts, lag(latitude) over w as prev_lat,
              lag(longitude) over w as prev_lng, lag({state}) over w as prev_state
            from ({src}) where {where}
            window w as (partition by vehicle_id {_ORDER})))"""


_TRIPS = f"""
with seg as (
  select *, case when starts then 0e0 else
      {haversine("prev_lat", "prev_lng", "latitude", "longitude")} end as km,
    case when starts then 0e0 else {seconds_between("prev_ts", "event_timestamp")} end as secs
  from ({_marked(vehicle_positions(), "state", INSIDE)})),
trips as (
  select vehicle_id, driver_id, vehicle_type, seq, min(event_timestamp) as trip_start_time,
    max(event_timestamp) as trip_end_time,
    min_by(latitude, (event_timestamp, event_id)) as start_latitude,
    min_by(longitude, (event_timestamp, event_id)) as start_longitude,
    max_by(latitude, (event_timestamp, event_id)) as end_latitude,
    max_by(longitude, (event_timestamp, event_id)) as end_longitude,
    min_by(trip_id, (event_timestamp, event_id)) as original_trip_id,
    sum(km) as total_distance_km, count(*) as position_count, avg(speed_kmh) as avg_speed_kmh,
    max(speed_kmh) as max_speed_kmh, min(fuel_level_pct) as min_fuel_pct,
    max(fuel_level_pct) as max_fuel_pct,
    sum(case when state = 'STOPPED' then secs else 0e0 end) as total_stop_time_seconds
  from seg group by all),
derived as (
  select *, {minutes_between("trip_start_time", "trip_end_time")} as trip_duration_minutes,
    max_fuel_pct - min_fuel_pct as fuel_consumed_pct,
    {haversine("start_latitude", "start_longitude", "end_latitude", "end_longitude")} as line_km,
    vehicle_id || '_TRIP_' || strftime(trip_start_time, '%Y%m%d') || '_' ||
      lpad(cast(seq as varchar), cast(greatest(3, length(cast(seq as varchar))) as integer), '0')
      as trip_id
  from trips)
select trip_id, trip_id as reconstructed_trip_id, original_trip_id, vehicle_id, driver_id,
  vehicle_type, trip_start_time, trip_end_time, start_latitude, start_longitude, end_latitude,
  end_longitude, total_distance_km, position_count, avg_speed_kmh, max_speed_kmh, min_fuel_pct,
  max_fuel_pct, total_stop_time_seconds, trip_duration_minutes,
  trip_duration_minutes - total_stop_time_seconds / 6e1 as moving_time_minutes,
  fuel_consumed_pct, case when fuel_consumed_pct > 0 then total_distance_km / fuel_consumed_pct
    end as fuel_efficiency_km_per_pct,
  line_km as straight_line_distance_km, line_km / total_distance_km as route_efficiency,
  case when line_km < 1 then 'LOCAL' when line_km < 50 then 'INTERCITY_SHORT'
    when line_km < 200 then 'INTERCITY_MEDIUM' else 'INTERCITY_LONG' end as trip_type,
  line_km < 2 as is_round_trip, cast(trip_start_time as date) as trip_date
from derived
where trip_duration_minutes >= 5 and position_count >= 5 and total_distance_km > 0.1"""

_TRIP_DOUBLES = ("start_latitude start_longitude end_latitude end_longitude total_distance_km "
                 "avg_speed_kmh max_speed_kmh min_fuel_pct max_fuel_pct total_stop_time_seconds "
                 "trip_duration_minutes moving_time_minutes fuel_consumed_pct "
                 "fuel_efficiency_km_per_pct straight_line_distance_km route_efficiency")
SQL["trips_haversine"] = rounded(_TRIPS, _TRIP_DOUBLES)

SQL["trip_segments"] = rounded(f"""
select event_id, vehicle_id, seq as trip_sequence, starts as is_trip_start,
  case when starts then 0e0 else
    {haversine("prev_lat", "prev_lng", "latitude", "longitude")} end as segment_distance_km,
  case when starts then 0e0 else {seconds_between("prev_ts", "event_timestamp")} end
    as segment_duration_seconds,
  case when not starts then (degrees(atan2(
      sin(radians(longitude - prev_lng)) * cos(radians(latitude)),
      cos(radians(prev_lat)) * sin(radians(latitude)) - sin(radians(prev_lat))
        * cos(radians(latitude)) * cos(radians(longitude - prev_lng)))) + 360) % 360 end
    as segment_heading
from ({_marked(vehicle_positions(), "state", INSIDE)})""",
    "segment_distance_km segment_duration_seconds segment_heading")

_INT_TRIPS = f"""
with seg as (
  select *, case when starts then 0e0 else
    {flat_km("prev_lat", "prev_lng", "latitude", "longitude", "latitude")} end as km
  from ({_marked(STG_POSITIONS.format(src=vehicle_positions()), "vehicle_state",
                 "is_valid_location")})),
trips as (
  select trip_id, vehicle_id, min_by(driver_id, (event_timestamp, event_id)) as driver_id,
    min_by(vehicle_type, (event_timestamp, event_id)) as vehicle_type,
    min(event_timestamp) as trip_start_time, max(event_timestamp) as trip_end_time,
    min(event_date) as trip_date,
    min_by(latitude, (event_timestamp, event_id)) as start_latitude,
    min_by(longitude, (event_timestamp, event_id)) as start_longitude,
    max_by(latitude, (event_timestamp, event_id)) as end_latitude,
    max_by(longitude, (event_timestamp, event_id)) as end_longitude,
    sum(km) as total_distance_km, count(*) as position_count, avg(speed_kmh) as avg_speed_kmh,
    max(speed_kmh) as max_speed_kmh, max(fuel_level_pct) as fuel_start_pct,
    min(fuel_level_pct) as fuel_end_pct,
    count(*) filter (vehicle_state = 'STOPPED') as stop_count
  from seg group by trip_id, vehicle_id)
select trip_id, vehicle_id, driver_id, vehicle_type, trip_start_time, trip_end_time, trip_date,
  start_latitude, start_longitude, end_latitude, end_longitude, total_distance_km,
  position_count, {minutes_between("trip_start_time", "trip_end_time")} as trip_duration_minutes,
  avg_speed_kmh, max_speed_kmh, fuel_start_pct, fuel_end_pct,
  fuel_start_pct - fuel_end_pct as fuel_consumed_pct, stop_count,
  line_km as straight_line_distance_km,
  case when line_km < 5 then 'LOCAL' when line_km < 50 then 'SHORT_HAUL'
    when line_km < 200 then 'MEDIUM_HAUL' else 'LONG_HAUL' end as trip_type
from (select *, {flat_km("start_latitude", "start_longitude", "end_latitude", "end_longitude",
                         "start_latitude")} as line_km from trips)
where position_count >= 5 and {minutes_between("trip_start_time", "trip_end_time")} >= 5"""
SQL["trips_sql_variant"] = rounded(
    _INT_TRIPS, "start_latitude start_longitude end_latitude end_longitude total_distance_km "
    "trip_duration_minutes avg_speed_kmh max_speed_kmh fuel_start_pct fuel_end_pct "
    "fuel_consumed_pct straight_line_distance_km")

FCT_TRIPS = f"""
select {key("trip_id")} as trip_key, trip_id, vehicle_id, driver_id, trip_date as date_key,
  vehicle_type, trip_type, trip_start_time, trip_end_time, start_latitude, start_longitude,
  end_latitude, end_longitude, straight_line_distance_km, total_distance_km,
  trip_duration_minutes, avg_speed_kmh, max_speed_kmh, fuel_consumed_pct, stop_count,
  position_count,
  case when straight_line_distance_km > 0 then total_distance_km / straight_line_distance_km end
    as route_circuity,
  case when trip_duration_minutes > 0 then total_distance_km / (trip_duration_minutes / 6e1) end
    as effective_speed_kmh,
  case when total_distance_km > 0 and fuel_consumed_pct > 0
    then total_distance_km / fuel_consumed_pct end as fuel_efficiency_km_per_pct
from ({_INT_TRIPS})"""
SQL["fct_trips"] = rounded(
    FCT_TRIPS, "start_latitude start_longitude end_latitude end_longitude "
    "straight_line_distance_km total_distance_km trip_duration_minutes avg_speed_kmh "
    "max_speed_kmh fuel_consumed_pct route_circuity effective_speed_kmh "
    "fuel_efficiency_km_per_pct")

SQL["trips_odometer"] = rounded(f"""
with t as (
  select vehicle_id, trip_id, count(*) as position_count, avg(speed_kmh) as mean,
    max(speed_kmh) as top, count(*) filter (state = 'STOPPED') as stop_count,
    min(event_timestamp) as trip_start_time, max(event_timestamp) as trip_end_time,
    min_by(driver_id, (event_timestamp, event_id)) as driver_id,
    min_by(vehicle_type, (event_timestamp, event_id)) as vehicle_type,
    min_by(latitude, (event_timestamp, event_id)) as start_latitude,
    min_by(longitude, (event_timestamp, event_id)) as start_longitude,
    max_by(latitude, (event_timestamp, event_id)) as end_latitude,
    max_by(longitude, (event_timestamp, event_id)) as end_longitude,
    cast(round(cast(min_by(fuel_level_pct, (event_timestamp, event_id)) as decimal(38,10)), 2) as double) as fuel_start_pct,
    cast(round(cast(max_by(fuel_level_pct, (event_timestamp, event_id)) as decimal(38,10)), 2) as double) as fuel_end_pct,
    cast(round(cast(max_by(odometer_km, (event_timestamp, event_id))
      - min_by(odometer_km, (event_timestamp, event_id)) as decimal(38,10)), 2) as double) as driven
  from ({vehicle_positions()}) group by all having count(*) >= 5),
m as (
  select *, case when driven <= 0 then cast(round(cast(mean * (position_count * 2 / 6e1) as decimal(38,10)), 2) as double) else driven end
      as total_distance_km,
    cast(round(cast({flat_km("start_latitude", "start_longitude", "end_latitude", "end_longitude",
                   "start_latitude")} as decimal(38,10)), 2) as double) as line_km from t)
select trip_id, vehicle_id, driver_id, vehicle_type, trip_start_time, trip_end_time,
  cast(trip_start_time as date) as trip_date, start_latitude, start_longitude, end_latitude,
  end_longitude, total_distance_km, position_count,
  cast(round(cast({minutes_between("trip_start_time", "trip_end_time")} as decimal(38,10)), 1) as double) as trip_duration_minutes,
  cast(round(cast(mean as decimal(38,10)), 1) as double) as avg_speed_kmh, cast(round(cast(top as decimal(38,10)), 1) as double) as max_speed_kmh, fuel_start_pct, fuel_end_pct,
  cast(round(cast(greatest(fuel_start_pct - fuel_end_pct, 0e0) as decimal(38,10)), 2) as double) as fuel_consumed_pct, stop_count,
  line_km as straight_line_distance_km,
  case when total_distance_km > 0 then cast(round(cast(line_km / total_distance_km as decimal(38,10)), 3) as double) end
    as route_efficiency,
  case when line_km < 5 then 'LOCAL' when line_km < 50 then 'SHORT_HAUL'
    when line_km < 200 then 'MEDIUM_HAUL' else 'LONG_HAUL' end as trip_type,
  line_km < 2 as is_round_trip
from m""", "start_latitude start_longitude end_latitude end_longitude")

DRIVER_DAILY = f"""
with p as (
  select driver_id, vehicle_id, event_date, count(*) as position_count,
    count(*) filter (vehicle_state = 'MOVING') as moving_positions,
    count(*) filter (vehicle_state = 'STOPPED') as stopped_positions,
    count(*) filter (vehicle_state = 'IDLE') as idle_positions,
    {hours_between("min(event_timestamp)", "max(event_timestamp)")} as active_hours,
    avg(speed_kmh) as avg_speed_kmh, max(speed_kmh) as max_speed_kmh,
    max(fuel_level_pct) - min(fuel_level_pct) as fuel_consumed_pct
  from ({STG_POSITIONS.format(src=vehicle_positions("raw"))})
  where is_valid_location group by all),
a as (
  select driver_id, event_date, count(*) as n,
    count(*) filter (alert_type = 'SPEEDING') as s,
    count(*) filter (alert_type = 'HARSH_BRAKING') as b,
    count(*) filter (alert_type = 'HARSH_ACCELERATION') as c,
    cast(sum(severity_score) as bigint) as sev
  from ({STG_ALERTS}) group by all)
select p.*, coalesce(n, 0) as total_alerts, coalesce(s, 0) as speeding_alerts,
  coalesce(b, 0) as harsh_braking_alerts, coalesce(c, 0) as harsh_accel_alerts,
  coalesce(sev, 0) as alert_severity_score,
  greatest(0, 100 - coalesce(5 * s, 0) - coalesce(3 * b, 0) - coalesce(2 * c, 0))
    as safety_score,
  cast(moving_positions as double) / position_count as utilization_rate
from p left join a using (driver_id, event_date)"""
_DRIVER_DOUBLES = ("active_hours avg_speed_kmh max_speed_kmh fuel_consumed_pct "
                   "utilization_rate")
SQL["driver_daily"] = rounded(DRIVER_DAILY, _DRIVER_DOUBLES)
FCT_DRIVER = f"""
select {key("driver_id", "vehicle_id", "event_date")} as performance_key, driver_id, vehicle_id,
  event_date as date_key, active_hours, position_count, moving_positions, stopped_positions,
  idle_positions, utilization_rate, avg_speed_kmh, max_speed_kmh, fuel_consumed_pct,
  total_alerts, speeding_alerts, harsh_braking_alerts, harsh_accel_alerts, alert_severity_score,
  safety_score,
  case when safety_score >= 90 and utilization_rate >= 0.7 then 'EXCELLENT'
    when safety_score >= 75 and utilization_rate >= 0.5 then 'GOOD'
    when safety_score >= 60 then 'AVERAGE' else 'NEEDS_IMPROVEMENT' end as performance_rating
from ({DRIVER_DAILY})"""
SQL["fct_driver_performance"] = rounded(FCT_DRIVER, _DRIVER_DOUBLES)

SQL["driving_events"] = f"""
with l as (
  select *, case when vehicle_type = 'TRUCK' then 8e1 else 7e1 end as cap,
    case when secs > 0 then (coalesce(prev_speed, speed_kmh) - speed_kmh) / 36e-1 / secs end
      as slowing
  from (select *, lag(speed_kmh) over w as prev_speed,
          {seconds_between("lag(event_timestamp) over w", "event_timestamp")} as secs
        from ({vehicle_positions()}) window w as (partition by vehicle_id {_ORDER}))),
k as (
  select *, case when speed_kmh > cap then 'SPEEDING' when slowing > 4 then 'HARSH_BRAKING'
    when slowing < -3.5 then 'HARSH_ACCELERATION' end as event_type from l)
select event_id, vehicle_id, driver_id, event_timestamp, cast(round(cast(latitude as decimal(38,10)), 6) as double) as latitude,
  cast(round(cast(longitude as decimal(38,10)), 6) as double) as longitude, event_type,
  case event_type when 'SPEEDING' then case when speed_kmh < cap + 20 then 'WARNING'
      else 'HIGH' end
    when 'HARSH_BRAKING' then case when slowing < 6 then 'WARNING' else 'HIGH' end
    else 'INFO' end as severity,
  case when event_type = 'SPEEDING' then cast(round(cast(speed_kmh as decimal(38,10)), 1) as double) end as speed,
  case when event_type = 'SPEEDING' then cap end as speed_limit,
  case when event_type = 'SPEEDING' then cast(round(cast(speed_kmh - cap as decimal(38,10)), 1) as double) end as overspeed_by,
  case when event_type = 'HARSH_BRAKING' then cast(round(cast(slowing as decimal(38,10)), 2) as double) end as deceleration_ms2,
  case when event_type = 'HARSH_ACCELERATION' then cast(round(cast(-slowing as decimal(38,10)), 2) as double) end as acceleration_ms2
from k where event_type is not null"""

SQL["idle_events"] = rounded(f"""
with r as (
  select *, sum(cast(changed as integer)) over (partition by vehicle_id {_ORDER}
      rows between unbounded preceding and current row) as run
  from (select *, state is distinct from lag(state) over
          (partition by vehicle_id {_ORDER}) as changed from ({vehicle_positions()})))
select vehicle_id, min(event_timestamp) as idle_start, max(event_timestamp) as idle_end,
  {minutes_between("min(event_timestamp)", "max(event_timestamp)")} as idle_minutes,
  count(*) as position_count, min_by(latitude, (event_timestamp, event_id)) as latitude,
  min_by(longitude, (event_timestamp, event_id)) as longitude
from r where state = 'IDLE' group by vehicle_id, run
having {minutes_between("min(event_timestamp)", "max(event_timestamp)")} > 5""",
    "idle_minutes latitude longitude")

SQL["trips_speed_rule"] = rounded(f"""
with m as (
  select *, sum(cast(starts as integer)) over (partition by vehicle_id {_ORDER}
      rows between unbounded preceding and current row) as seq
  from (select *, coalesce(lag(event_timestamp) over w is null
          or {minutes_between("lag(event_timestamp) over w", "event_timestamp")} > 30
          or (lag(speed_kmh) over w < 2 and speed_kmh >= 5), false) as starts
        from ({vehicle_positions()}) where {INSIDE}
        window w as (partition by vehicle_id {_ORDER})))
select vehicle_id, seq as trip_sequence, min(event_timestamp) as trip_start_time,
  max(event_timestamp) as trip_end_time, count(*) as position_count,
  avg(speed_kmh) as avg_speed_kmh, max(speed_kmh) as max_speed_kmh
from m group by vehicle_id, seq""", "avg_speed_kmh max_speed_kmh")

SQL["projected_positions"] = rounded(f"""
select event_id, vehicle_id, degrees(p2) as projected_latitude,
  degrees(radians(longitude) + atan2(sin(radians(heading)) * sin(1 / 6371e0)
    * cos(radians(latitude)), cos(1 / 6371e0) - sin(radians(latitude)) * sin(p2)))
    as projected_longitude
from (select *, asin(sin(radians(latitude)) * cos(1 / 6371e0) + cos(radians(latitude))
        * sin(1 / 6371e0) * cos(radians(heading))) as p2
      from ({vehicle_positions("raw")}))""", "projected_latitude projected_longitude")

SQL["geofence_events"] = rounded(f"""
with p as (select * from ({vehicle_positions()})), f as (select * from ({GEOFENCES})),
hit as (
  select p.vehicle_id, p.event_id, p.event_timestamp, f.geofence_id
  from p join f on abs(latitude - center_lat) < 0.02 and abs(longitude - center_lng) < 0.02
    and {haversine("latitude", "longitude", "center_lat", "center_lng")} <= radius_km),
visited as (select distinct vehicle_id, geofence_id from hit),
track as (
  select p.vehicle_id, p.event_id, p.event_timestamp, p.latitude, p.longitude, v.geofence_id,
    h.event_id is not null as inside
  from p join visited v using (vehicle_id)
  left join hit h on h.vehicle_id = p.vehicle_id and h.event_id = p.event_id
    and h.geofence_id = v.geofence_id),
turns as (
  select * from (select *, coalesce(lag(inside) over
      (partition by vehicle_id, geofence_id {_ORDER}), false) as was from track)
  where inside <> was)
select event_id, vehicle_id, geofence_id, f.geofence_type,
  case when inside then 'ENTRY' else 'EXIT' end as event_type, event_timestamp, latitude,
  longitude, case when not inside then {seconds_between(
      "lag(event_timestamp) over (partition by vehicle_id, geofence_id " + _ORDER + ")",
      "event_timestamp")} end as dwell_time_seconds
from turns join f using (geofence_id)""", "latitude longitude dwell_time_seconds")

SPEEDING = f"""
select event_id, vehicle_id, driver_id, speed_kmh, 'SPEEDING' as event_type,
  case when speed_kmh > 120 then 'CRITICAL' when speed_kmh > 100 then 'HIGH'
    when speed_kmh > 90 then 'MEDIUM' else 'LOW' end as severity, event_timestamp
from ({vehicle_positions("raw")}) where speed_kmh > 80"""
SQL["speeding_alerts"] = SPEEDING

SQL["speeding_severity_counts"] = f"""
select severity, count(*) as alerts, count(distinct vehicle_id) as vehicles
from ({SPEEDING}) group by severity"""
