"""Oracle SQL: agents, zones, areas, stops and the alert table."""

from __future__ import annotations

from routeline.plans.oracle.feeds import (
    AGENT_POSITIONS, ALERTS, DELIVERY_EVENTS, SHIPMENT_EVENTS, half_up, haversine, hours_between,
    key, rounded, seconds_between,
)

SQL: dict[str, str] = {}

_AT = "(event_timestamp, event_id)"

STG_AGENTS = f"""
select event_id, agent_id, event_timestamp, event_date, latitude, longitude,
  accuracy_m as accuracy_meters, speed_kmh, heading as heading_degrees, zone_id, vehicle_type,
  status as agent_status, is_at_stop, current_order_id, pending_orders,
  completed_today as completed_deliveries, failed_today as failed_deliveries,
  battery_pct as phone_battery_pct,
  latitude between 8 and 37 and longitude between 68 and 97.5 as is_valid_location,
  case when is_at_stop then 'STOPPED' when speed_kmh < 2 then 'IDLE'
    when speed_kmh < 10 then 'SLOW_MOVING' else 'MOVING' end as activity_state,
  cast(hour(event_timestamp) as integer) as hour_of_day,
  cast(dayofweek(event_timestamp) as integer) as day_of_week,
  hour(event_timestamp) >= 8 and hour(event_timestamp) <= 21 as is_working_hours
from ({AGENT_POSITIONS})"""
SQL["stg_agent_positions"] = rounded(
    STG_AGENTS, "latitude longitude accuracy_meters speed_kmh heading_degrees")

STG_DELIVERIES = f"""
select event_id, agent_id, agent_name, order_id, shipment_id, event_timestamp, event_date,
  event_type, customer_id, delivery_address, zone_id, delivery_lat as delivery_latitude,
  delivery_lng as delivery_longitude, is_cod, cod_amount, cod_collected, payment_mode,
  attempt_number, failure_reason, pod_type, customer_rating, time_at_location_seconds,
  case event_type when 'DELIVERED' then 'SUCCESS' when 'DELIVERY_FAILED' then 'FAILED'
    when 'DELIVERY_ATTEMPTED' then 'ATTEMPTED' else 'OTHER' end as delivery_outcome,
  event_type = 'DELIVERED' and attempt_number = 1 as is_first_attempt_success,
  case failure_reason when 'CUSTOMER_NOT_AVAILABLE' then 'CUSTOMER_ISSUE'
    when 'ACCESS_RESTRICTED' then 'CUSTOMER_ISSUE' when 'WRONG_ADDRESS' then 'ADDRESS_ISSUE'
    when 'CUSTOMER_REFUSED' then 'REFUSAL' when 'PAYMENT_ISSUE' then 'REFUSAL'
    when 'DAMAGED_PACKAGE' then 'PACKAGE_ISSUE' end as failure_category,
  cast(hour(event_timestamp) as integer) as hour_of_day,
  cast(dayofweek(event_timestamp) as integer) as day_of_week,
  case when hour(event_timestamp) < 9 or hour(event_timestamp) > 21 then 'OFF_HOURS'
    when hour(event_timestamp) <= 12 then 'MORNING'
    when hour(event_timestamp) <= 15 then 'AFTERNOON'
    when hour(event_timestamp) <= 18 then 'EVENING' else 'NIGHT' end as delivery_time_slot
from ({DELIVERY_EVENTS})"""
SQL["stg_delivery_events"] = rounded(
    STG_DELIVERIES, "delivery_latitude delivery_longitude cod_amount cod_collected")

_DISTANCE = f"""
select agent_id, event_date, sum(coalesce({haversine("plat", "plng", "latitude", "longitude")},
    0e0)) as total_distance_km, count(*) as position_count
from (select *, lag(latitude) over w as plat, lag(longitude) over w as plng
      from ({AGENT_POSITIONS})
      window w as (partition by agent_id, event_date order by event_timestamp, event_id))
group by agent_id, event_date"""
SQL["agent_distance"] = rounded(_DISTANCE, "total_distance_km")

_DELIVERY_DAYS = f"""
select agent_id, event_date, count(*) as total_delivery_events,
  count(*) filter (event_type = 'DELIVERED') as successful_deliveries,
  count(*) filter (event_type = 'DELIVERY_ATTEMPTED') as failed_attempts,
  count(*) filter (event_type = 'DELIVERY_FAILED') as final_failures,
  count(*) filter (is_cod) as cod_deliveries, sum(cod_collected) as total_cod_collected,
  avg(time_at_location_seconds) as avg_time_at_stop_seconds,
  avg(customer_rating) as avg_customer_rating, count(customer_rating) as ratings_received,
  count(*) filter (event_type = 'DELIVERED') / cast(count(*) as double)
    as delivery_success_rate,
  string_agg(failure_reason, ',' order by failure_reason) as failure_reasons
from ({DELIVERY_EVENTS}) group by agent_id, event_date"""
SQL["delivery_metrics"] = rounded(
    _DELIVERY_DAYS, "total_cod_collected avg_time_at_stop_seconds avg_customer_rating "
    "delivery_success_rate")

_SHIFTS = f"""
with s as (
  select agent_id, zone_id, vehicle_type, event_date, min(event_timestamp) as shift_start_time,
    max(event_timestamp) as shift_end_time, count(*) as position_count,
    avg(speed_kmh) as avg_speed_kmh, max(speed_kmh) as max_speed_kmh,
    count(*) filter (is_at_stop) as stop_count, avg(battery_pct) as avg_battery_pct,
    min(battery_pct) as min_battery_pct,
    max_by(completed_today, {_AT}) as completed_deliveries,
    max_by(failed_today, {_AT}) as failed_deliveries,
    max_by(pending_orders, {_AT}) as pending_at_end,
    {hours_between("min(event_timestamp)", "max(event_timestamp)")} as shift_duration_hours
  from ({AGENT_POSITIONS}) group by all),
c as (
  select s.*, d.total_distance_km, m.* exclude (agent_id, event_date),
    case when shift_duration_hours > 0 then successful_deliveries / shift_duration_hours end
      as deliveries_per_hour,
    case when successful_deliveries > 0 then d.total_distance_km / successful_deliveries end
      as km_per_delivery,
    case when shift_duration_hours > 0 then (successful_deliveries * avg_time_at_stop_seconds
      / 3.6e3) / shift_duration_hours end as utilization_rate
  from s left join ({_DISTANCE}) d using (agent_id, event_date)
    left join ({_DELIVERY_DAYS}) m using (agent_id, event_date))
select *, row_number() over (partition by event_date order by
    successful_deliveries desc nulls last, delivery_success_rate desc nulls last, agent_id,
    zone_id, vehicle_type) as overall_rank,
  row_number() over z as zone_rank, row_number() over z <= 3 as is_top_performer,
  event_date as shift_date
from c window z as (partition by zone_id, event_date order by
  successful_deliveries desc nulls last, delivery_success_rate desc nulls last, agent_id,
  vehicle_type)"""
_SHIFT_DOUBLES = ("avg_speed_kmh max_speed_kmh avg_battery_pct shift_duration_hours "
                  "total_distance_km total_cod_collected avg_time_at_stop_seconds "
                  "avg_customer_rating delivery_success_rate deliveries_per_hour "
                  "km_per_delivery utilization_rate")
SQL["agent_shifts"] = rounded(_SHIFTS, _SHIFT_DOUBLES)
SQL["agent_ranks"] = f"""
select agent_id, zone_id, event_date, successful_deliveries, zone_rank, overall_rank,
  is_top_performer from ({_SHIFTS})"""
SQL["zone_performance"] = rounded(f"""
select *, row_number() over (partition by event_date order by total_deliveries desc, zone_id)
    as zone_performance_rank
from (select zone_id, event_date, count(agent_id) as active_agents,
    cast(sum(successful_deliveries) as bigint) as total_deliveries,
    cast(sum(final_failures) as bigint) as total_failures,
    avg(delivery_success_rate) as avg_success_rate,
    avg(deliveries_per_hour) as avg_deliveries_per_hour,
    sum(total_distance_km) as total_distance_km,
    sum(total_cod_collected) as total_cod_collected,
    avg(avg_customer_rating) as avg_customer_rating
  from ({_SHIFTS}) group by zone_id, event_date)""",
    "avg_success_rate avg_deliveries_per_hour total_distance_km total_cod_collected "
    "avg_customer_rating")
SQL["top_performers"] = rounded(f"""
select agent_id, zone_id, event_date, successful_deliveries, delivery_success_rate,
  deliveries_per_hour, zone_rank
from ({_SHIFTS}) where is_top_performer
order by zone_id, zone_rank, event_date, agent_id, vehicle_type limit 20""",
    "delivery_success_rate deliveries_per_hour")
SQL["top_agents"] = rounded(f"""
select agent_id, zone_id, event_date, successful_deliveries, delivery_success_rate,
  avg_customer_rating
from ({_SHIFTS}) order by successful_deliveries desc nulls last, agent_id, event_date, zone_id
limit 10""", "delivery_success_rate avg_customer_rating")

INT_SHIFTS = f"""
with p as (
  select agent_id, zone_id, vehicle_type, event_date as shift_date,
    min(event_timestamp) as shift_start_time, max(event_timestamp) as shift_end_time,
    {hours_between("min(event_timestamp)", "max(event_timestamp)")} as shift_duration_hours,
    count(*) as position_count, count(*) filter (is_at_stop) as stop_count,
    avg(speed_kmh) as avg_speed_kmh, max(speed_kmh) as max_speed_kmh,
    avg(phone_battery_pct) as avg_battery_pct, min(phone_battery_pct) as min_battery_pct
  from ({STG_AGENTS}) where is_valid_location group by agent_id, zone_id, vehicle_type, event_date),
d as (
  select agent_id, event_date as shift_date,
    count(*) filter (event_type = 'DELIVERED') as successful_deliveries,
    count(*) filter (event_type = 'DELIVERY_ATTEMPTED') as failed_attempts,
    count(*) filter (event_type = 'DELIVERY_FAILED') as final_failures,
    count(*) filter (is_first_attempt_success) as first_attempt_successes,
    count(*) filter (is_cod and event_type = 'DELIVERED') as cod_deliveries,
    coalesce(sum(cod_collected) filter (event_type = 'DELIVERED'), 0e0) as total_cod_collected,
    count(customer_rating) as ratings_received,
    count(*) filter (delivery_time_slot = 'MORNING') as morning_deliveries,
    count(*) filter (delivery_time_slot = 'AFTERNOON') as afternoon_deliveries,
    count(*) filter (delivery_time_slot = 'EVENING') as evening_deliveries,
    count(*) filter (delivery_time_slot = 'NIGHT') as night_deliveries,
    avg(time_at_location_seconds) as avg_time_per_delivery_seconds,
    avg(customer_rating) as avg_customer_rating
  from ({STG_DELIVERIES}) group by all)
select p.*, coalesce(successful_deliveries, 0) as successful_deliveries,
  coalesce(failed_attempts, 0) as failed_attempts, coalesce(final_failures, 0) as final_failures,
  coalesce(first_attempt_successes, 0) as first_attempt_successes,
  coalesce(cod_deliveries, 0) as cod_deliveries,
  coalesce(total_cod_collected, 0e0) as total_cod_collected,
  coalesce(ratings_received, 0) as ratings_received,
  coalesce(morning_deliveries, 0) as morning_deliveries,
  coalesce(afternoon_deliveries, 0) as afternoon_deliveries,
  coalesce(evening_deliveries, 0) as evening_deliveries,
  coalesce(night_deliveries, 0) as night_deliveries, avg_time_per_delivery_seconds,
  avg_customer_rating,
  case when shift_duration_hours > 0
    then coalesce(successful_deliveries, 0) / shift_duration_hours else 0e0 end
    as deliveries_per_hour,
  case when successful_deliveries + failed_attempts + final_failures > 0
    then cast(successful_deliveries as double)
      / (successful_deliveries + failed_attempts + final_failures) end as delivery_success_rate,
  case when successful_deliveries > 0
    then cast(first_attempt_successes as double) / successful_deliveries end
    as first_attempt_success_rate,
  case when successful_deliveries >= 50 then 'TOP_PERFORMER' when successful_deliveries >= 30
    then 'GOOD' when successful_deliveries >= 15 then 'AVERAGE' else 'BELOW_AVERAGE' end
    as performance_tier
from p left join d using (agent_id, shift_date)"""
_INT_DOUBLES = ("shift_duration_hours avg_speed_kmh max_speed_kmh avg_battery_pct "
                "total_cod_collected avg_time_per_delivery_seconds avg_customer_rating "
                "deliveries_per_hour delivery_success_rate first_attempt_success_rate")
SQL["int_agent_shifts"] = rounded(INT_SHIFTS, _INT_DOUBLES)

FCT_AGENTS = f"""
select {key("agent_id", "shift_date", "zone_id", "vehicle_type")} as agent_daily_key,
  * exclude (shift_date), shift_date as date_key,
  cast(successful_deliveries >= 30 as integer) as is_productive_flag,
  cast(coalesce(delivery_success_rate >= 0.9, false) as integer) as is_high_quality_flag,
  cast(coalesce(avg_customer_rating >= 4.5, false) as integer) as is_highly_rated_flag
from ({INT_SHIFTS})"""
SQL["fct_agent_daily"] = rounded(
    f"select * exclude (max_speed_kmh) from ({FCT_AGENTS})",
    _INT_DOUBLES.replace("max_speed_kmh ", ""))

SQL["fct_zone_daily"] = rounded(f"""
with z as (
  select zone_id, date_key, count(distinct agent_id) as active_agents,
    count(*) filter (performance_tier = 'TOP_PERFORMER') as top_performers,
    cast(sum(successful_deliveries) as bigint) as total_deliveries,
    cast(sum(failed_attempts) as bigint) as total_failed_attempts,
    cast(sum(final_failures) as bigint) as total_final_failures,
    cast(sum(first_attempt_successes) as bigint) as total_first_attempt_successes,
    cast(sum(cod_deliveries) as bigint) as total_cod_deliveries,
    sum(total_cod_collected) as total_cod_amount,
    avg(deliveries_per_hour) as avg_deliveries_per_hour,
    avg(delivery_success_rate) as avg_success_rate,
    avg(first_attempt_success_rate) as avg_first_attempt_rate,
    avg(avg_customer_rating) as avg_customer_rating,
    cast(sum(ratings_received) as bigint) as total_ratings,
    avg(shift_duration_hours) as avg_shift_hours,
    cast(sum(morning_deliveries) as bigint) as morning_deliveries,
    cast(sum(afternoon_deliveries) as bigint) as afternoon_deliveries,
    cast(sum(evening_deliveries) as bigint) as evening_deliveries,
    cast(sum(night_deliveries) as bigint) as night_deliveries
  from ({FCT_AGENTS}) group by all)
select {key("zone_id", "date_key")} as zone_daily_key, *,
  top_performers / cast(active_agents as double) as top_performer_ratio,
  total_deliveries / cast(active_agents as double) as deliveries_per_agent,
  case when total_deliveries + total_failed_attempts + total_final_failures > 0
    then total_deliveries / cast(total_deliveries + total_failed_attempts
      + total_final_failures as double) end as zone_success_rate,
  case when total_cod_deliveries > 0 then total_cod_amount / total_cod_deliveries end
    as avg_cod_per_delivery,
  case when morning_deliveries >= greatest(afternoon_deliveries, evening_deliveries,
      night_deliveries) then 'MORNING'
    when afternoon_deliveries >= greatest(evening_deliveries, night_deliveries) then 'AFTERNOON'
    when evening_deliveries >= night_deliveries then 'EVENING' else 'NIGHT' end
    as peak_delivery_time,
  case when avg_success_rate >= 0.9 and avg_customer_rating >= 4.5 then 'EXCELLENT'
    when avg_success_rate >= 0.8 and avg_customer_rating >= 4.0 then 'GOOD'
    when avg_success_rate >= 0.7 then 'AVERAGE' else 'NEEDS_IMPROVEMENT' end
    as zone_performance_tier
from z""", "total_cod_amount avg_deliveries_per_hour avg_success_rate avg_first_attempt_rate "
           "avg_customer_rating avg_shift_hours top_performer_ratio deliveries_per_agent "
           "zone_success_rate avg_cod_per_delivery")

_ESTIMATE = f"""
with p as (
  select agent_id, event_date, arg_min(zone_id, {_AT}) as zone_id,
    min(event_timestamp) as shift_start_time, max(event_timestamp) as shift_end_time,
    count(*) as position_count, count(*) filter (is_at_stop) as stop_count,
    avg(speed_kmh) as mean, max(speed_kmh) as top,
    {half_up(hours_between("min(event_timestamp)", "max(event_timestamp)"), 2)} as hours
  from ({AGENT_POSITIONS}) group by agent_id, event_date),
d as (
  select agent_id, event_date, count(*) filter (event_type = 'DELIVERED') as wins,
    count(*) filter (event_type = 'DELIVERY_ATTEMPTED') as tries,
    count(*) filter (event_type = 'DELIVERY_FAILED') as fails,
    count(*) filter (event_type = 'DELIVERED' and attempt_number = 1) as firsts,
    avg(customer_rating) as stars, count(customer_rating) as rated,
    coalesce(sum(cod_collected) filter (event_type = 'DELIVERED'), 0e0) as cod
  from ({DELIVERY_EVENTS}) group by all),
j as (select p.*, coalesce(wins, 0) as wins, coalesce(tries, 0) as tries,
    coalesce(fails, 0) as fails, coalesce(firsts, 0) as firsts, stars,
    coalesce(rated, 0) as rated, coalesce(cod, 0e0) as cod
  from p left join d using (agent_id, event_date))
select {key("agent_id", "event_date")} as shift_id, agent_id, zone_id, event_date as shift_date,
  shift_start_time, shift_end_time, hours as shift_duration_hours, position_count, stop_count,
  {half_up("mean", 1)} as avg_speed_kmh, {half_up("top", 1)} as max_speed_kmh,
  wins as successful_deliveries, tries as failed_attempts, fails as final_failures,
  firsts as first_attempt_successes,
  {half_up("wins / cast(greatest(wins + tries + fails, 1) as double)", 3)}
    as delivery_success_rate,
  {half_up("wins / greatest(hours, 1e0)", 2)} as deliveries_per_hour,
  {half_up("stars", 2)} as avg_customer_rating, rated as ratings_received,
  {half_up("cod", 2)} as total_cod_collected,
  {half_up("greatest(mean, 5e0) * hours * 45e-2", 2)} as total_distance_km,
  case when wins >= 18 then 'TOP_PERFORMER' when wins >= 12 then 'GOOD' when wins >= 6
    then 'AVERAGE' else 'BELOW_AVERAGE' end as performance_tier
from j"""
SQL["shift_estimate"] = _ESTIMATE
SQL["zone_estimate"] = f"""
select zone_id, shift_date as event_date, count(distinct agent_id) as active_agents,
  cast(sum(successful_deliveries) as bigint) as total_deliveries,
  {half_up("avg(delivery_success_rate)", 3)} as avg_success_rate,
  {half_up("avg(deliveries_per_hour)", 2)} as avg_deliveries_per_hour,
  {half_up("avg(avg_customer_rating)", 2)} as avg_customer_rating,
  count(*) filter (performance_tier = 'TOP_PERFORMER') as top_performer_count
from ({_ESTIMATE}) group by all"""

_CELL = (f"'h3_9_' || cast({half_up('delivery_lat', 2)} as varchar) || '_' || "
         f"cast({half_up('delivery_lng', 2)} as varchar)")
_AREA = f"""
with e as (
  select *, {_CELL} as geo_key, event_date as date,
    case when hour(event_timestamp) between 9 and 12 then 'MORNING'
      when hour(event_timestamp) between 13 and 17 then 'AFTERNOON'
      when hour(event_timestamp) between 18 and 21 then 'EVENING' else 'OFF_HOURS' end as slot
  from ({DELIVERY_EVENTS})),
s as (select geo_key, date, slot, count(*) as n,
    count(*) filter (event_type = 'DELIVERED') / cast(count(*) as double) as rate
  from e group by all),
b as (select geo_key, date, arg_max(slot, (rate, n, slot)) as best_slot, max(rate) * 1e2
    as best_slot_success_rate from s group by all)
select {key("geo_key", "date")} as area_perf_id, geo_key, date, count(*) as total_attempts,
  count(*) filter (event_type = 'DELIVERED') as successful_deliveries,
  count(*) filter (event_type = 'DELIVERY_FAILED') as failed_deliveries,
  {half_up("count(*) filter (event_type = 'DELIVERED') * 1e2 / count(*)", 2)} as success_rate,
  case when count(*) filter (event_type = 'DELIVERED') > 0 then
    count(*) filter (event_type = 'DELIVERED' and attempt_number = 1) * 1e2
      / count(*) filter (event_type = 'DELIVERED') end as first_attempt_success_rate,
  avg(time_at_location_seconds) as avg_time_at_stop_seconds,
  count(*) filter (failure_reason = 'CUSTOMER_NOT_AVAILABLE') as failures_customer_not_available,
  count(*) filter (failure_reason = 'WRONG_ADDRESS') as failures_wrong_address,
  count(*) filter (failure_reason = 'ACCESS_RESTRICTED') as failures_access_issue,
  count(*) filter (failure_reason = 'CUSTOMER_REFUSED') as failures_refused,
  count(*) filter (failure_reason in ('PAYMENT_ISSUE', 'DAMAGED_PACKAGE', 'OTHER'))
    as failures_other,
  any_value(best_slot) as best_slot, any_value(best_slot_success_rate) as best_slot_success_rate,
  avg(customer_rating) as avg_customer_rating
from e join b using (geo_key, date) group by geo_key, date"""
SQL["area_performance"] = rounded(
    _AREA, "first_attempt_success_rate avg_time_at_stop_seconds best_slot_success_rate "
    "avg_customer_rating")

SQL["shifts_from_attempts"] = rounded(f"""
select *, orders_delivered * 1e2 / total_attempts as success_rate,
  {hours_between("first_delivery_time", "last_delivery_time")} as active_hours,
  case when last_delivery_time > first_delivery_time then orders_delivered /
    {hours_between("first_delivery_time", "last_delivery_time")} end as deliveries_per_hour
from (select agent_id, event_date as shift_date, count(*) as total_attempts,
    count(*) filter (event_type = 'DELIVERED') as orders_delivered,
    count(*) filter (event_type = 'DELIVERY_FAILED') as orders_failed,
    sum(cod_collected) as total_cod_collected, avg(customer_rating) as avg_customer_rating,
    avg(time_at_location_seconds) as avg_time_at_stop_seconds,
    min(event_timestamp) as first_delivery_time, max(event_timestamp) as last_delivery_time
  from ({DELIVERY_EVENTS}) group by agent_id, event_date)""",
    "total_cod_collected avg_customer_rating avg_time_at_stop_seconds success_rate active_hours "
    "deliveries_per_hour")

_ORDER = "partition by agent_id order by event_timestamp, event_id"
_STOPS = f"""
select agent_id, min(event_timestamp) as stop_start, max(event_timestamp) as stop_end,
  avg(latitude) as latitude, avg(longitude) as longitude, count(*) as position_count,
  {seconds_between("min(event_timestamp)", "max(event_timestamp)")} as stop_seconds,
  agent_id || ':' || cast(run as varchar) as stop_id
from (select *, sum(cast(turn as integer)) over ({_ORDER} rows unbounded preceding) as run
      from (select *, speed_kmh < 2 as slow,
              coalesce((speed_kmh < 2) <> (lag(speed_kmh) over ({_ORDER}) < 2), true) as turn
            from ({AGENT_POSITIONS})))
where slow group by agent_id, run
having {seconds_between("min(event_timestamp)", "max(event_timestamp)")} >= 60"""
SQL["agent_stops"] = rounded(_STOPS, "latitude longitude stop_seconds")
SQL["stop_matches"] = rounded(f"""
with s as (select * from ({_STOPS})),
m as (
  select d.event_id, d.order_id, d.agent_id, d.event_timestamp, s.stop_id, s.stop_seconds,
    {haversine("s.latitude", "s.longitude", "d.delivery_lat", "d.delivery_lng")} * 1e3 as away
  from ({DELIVERY_EVENTS}) d asof left join s
    on d.agent_id = s.agent_id and d.event_timestamp >= s.stop_start)
select event_id, order_id, agent_id, event_timestamp,
  case when away <= 50 then stop_id end as stop_id, case when away <= 50 then away end
    as distance_m, case when away <= 50 then stop_seconds end as stop_seconds
from m""", "distance_m stop_seconds")

_ALL_ALERTS = f"""
select 'FLEET' as module, event_type as alert_type, severity, 'VEHICLE' as entity_type,
  vehicle_id as entity_id, event_timestamp as alert_timestamp from ({ALERTS})
union all
select 'SHIPMENT', 'EXCEPTION', 'HIGH', 'SHIPMENT', shipment_id, event_timestamp
from ({SHIPMENT_EVENTS})
where event_type in ('DELIVERY_FAILED', 'RETURNED_TO_ORIGIN', 'LOST', 'DAMAGED')
union all
select 'LAST_MILE', 'DELIVERY_FAILED', 'WARNING', 'ORDER', order_id, event_timestamp
from ({DELIVERY_EVENTS}) where event_type = 'DELIVERY_FAILED'"""
_UNIFIED = f"""
select md5(concat_ws('|', module, alert_type, entity_id,
    cast(epoch_us(alert_timestamp) as varchar))) as alert_id, module, alert_type, severity,
  entity_type, entity_id, alert_timestamp,
  case severity when 'CRITICAL' then 'slack,sms' when 'HIGH' then 'slack'
    when 'WARNING' then 'slack' else '' end as channels
from (select module, alert_type, entity_id, alert_timestamp, entity_type,
    arg_max(severity, list_position(['INFO', 'WARNING', 'HIGH', 'CRITICAL'], severity))
      as severity
  from ({_ALL_ALERTS}) group by all)"""
SQL["alerts_unified"] = _UNIFIED
SQL["alerts_routed"] = f"""
select channel, module, severity, count(*) as alerts
from (select module, severity, unnest(string_split(channels, ',')) as channel
      from ({_UNIFIED}) where channels <> '') group by all"""

SQL["hourly_rollup"] = rounded(f"""
select date_trunc('hour', event_timestamp) as window_start,
  date_trunc('hour', event_timestamp) + interval 1 hour as window_end, zone_id,
  count(*) as events, count(distinct agent_id) as entities, avg(speed_kmh) as avg_speed_kmh,
  max(speed_kmh) as max_speed_kmh
from ({AGENT_POSITIONS}) group by all""", "avg_speed_kmh max_speed_kmh")
SQL["daily_rollup"] = f"""
select cast(event_date as timestamp) as window_start,
  cast(event_date as timestamp) + interval 1 day as window_end, hub_id, count(*) as events,
  count(distinct shipment_id) as entities
from ({SHIPMENT_EVENTS}) group by all"""
