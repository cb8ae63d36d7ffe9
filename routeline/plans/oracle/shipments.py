"""Oracle SQL: parcels, hubs, service levels, calendar and party dimensions."""

from __future__ import annotations

from routeline.plans.oracle.feeds import (
    DELIVERY_EVENTS, DIM_HUBS, SHIPMENT_EVENTS, half_up, hours_between, key, rounded,
)

SQL: dict[str, str] = {}

_W = "partition by shipment_id order by event_timestamp, event_id"
_AT = "(event_timestamp, event_id)"
_GAP = hours_between(f"lag(event_timestamp) over ({_W})", "event_timestamp")

_STAGE = """case when event_type in ('CREATED', 'PICKUP_SCHEDULED', 'PICKED_UP') then 'FIRST_MILE'
    when event_type like 'HUB%' or event_type = 'IN_TRANSIT' then 'MID_MILE'
    when event_type = 'OUT_FOR_DELIVERY' or event_type like 'DELIVER%' then 'LAST_MILE'"""

STG_SHIPMENTS = f"""
select event_id, shipment_id, awb_number, event_timestamp, event_date, event_type, hub_id,
  hub_name, hub_city, latitude as hub_latitude, longitude as hub_longitude, seller_id,
  customer_id, origin_hub, destination_hub, route_hops, current_hop, weight_kg, is_cod,
  cod_amount, promised_delivery_at, delivery_attempts, failure_reason, scanner_id, worker_id,
  {_STAGE} when event_type in ('RETURNED_TO_ORIGIN', 'LOST', 'DAMAGED') then 'EXCEPTION'
    else 'OTHER' end as journey_stage,
  case when starts_with(event_type, 'HUB_') then 'HUB_OPERATION'
    when starts_with(event_type, 'DELIVER') then 'DELIVERY'
    when event_type in ('CREATED', 'PICKUP_SCHEDULED', 'PICKED_UP') then 'PICKUP'
    when event_type = 'IN_TRANSIT' then 'TRANSIT' else 'OTHER' end as event_category,
  event_type in ('DELIVERED', 'DELIVERY_FAILED', 'RETURNED_TO_ORIGIN', 'LOST', 'DAMAGED')
    as is_terminal_event,
  cast(hour(event_timestamp) as integer) as hour_of_day,
  cast(dayofweek(event_timestamp) as integer) as day_of_week
from ({SHIPMENT_EVENTS})"""
SQL["stg_shipment_events"] = rounded(
    STG_SHIPMENTS, "hub_latitude hub_longitude weight_kg cod_amount")

SQL["shipment_sequence"] = rounded(f"""
select event_id, shipment_id, event_type, hub_id, event_timestamp,
  row_number() over w as event_sequence, lag(event_type) over w as prev_event_type,
  lag(event_timestamp) over w as prev_event_time, lag(hub_id) over w as prev_hub_id,
  lead(event_type) over w as next_event_type, lead(event_timestamp) over w as next_event_time,
  {hours_between("lag(event_timestamp) over w", "event_timestamp")} as time_since_prev_hours,
  {_STAGE} else 'OTHER' end as journey_stage
from ({SHIPMENT_EVENTS}) window w as ({_W})""", "time_since_prev_hours")

SQL["hub_event_sequence"] = f"""
select event_id, shipment_id, hub_id, event_type, event_timestamp,
  row_number() over (partition by shipment_id, hub_id order by event_timestamp, event_id)
    as hub_event_seq
from ({SHIPMENT_EVENTS}) where event_type like 'HUB%'"""

_DWELL = f"""
select shipment_id, hub_id, hub_name, hub_city, min(event_timestamp) as hub_arrival_time,
  max(event_timestamp) as hub_departure_time, count(*) as hub_event_count,
  string_agg(event_type, ',' order by event_timestamp, event_id) as hub_events,
  {hours_between("min(event_timestamp)", "max(event_timestamp)")} as hub_dwell_hours,
  {hours_between("min(event_timestamp)", "max(event_timestamp)")} > 12 as is_bottleneck
from ({SHIPMENT_EVENTS}) where event_type like 'HUB%' group by all"""
SQL["hub_dwell"] = rounded(_DWELL, "hub_dwell_hours")

_JOURNEYS = f"""
with g as (select *, {_GAP} as gap from ({SHIPMENT_EVENTS})),
j as (
  select shipment_id, max_by(awb_number, {_AT}) as awb_number,
    max_by(seller_id, {_AT}) as seller_id, max_by(customer_id, {_AT}) as customer_id,
    max_by(origin_hub, {_AT}) as origin_hub, max_by(destination_hub, {_AT}) as destination_hub,
    max_by(is_cod, {_AT}) as is_cod, max_by(cod_amount, {_AT}) as cod_amount,
    max_by(promised_delivery_at, {_AT}) as promised_delivery_ts,
    max_by(route_hops, {_AT}) as route_hops,
    min(event_timestamp) as journey_start_time, max(event_timestamp) as journey_end_time,
    arg_min(event_type, {_AT}) as first_event, arg_max(event_type, {_AT}) as last_event,
    count(*) as total_events, count(distinct hub_id) as hubs_visited,
    max(delivery_attempts) as delivery_attempts,
    arg_max_null(failure_reason, {_AT}) as last_failure_reason,
    count(*) filter (gap > 24) as stuck_incidents, max(gap) as max_gap_hours
  from g group by shipment_id)
select *, {hours_between("journey_start_time", "journey_end_time")} as journey_duration_hours,
  {hours_between("journey_start_time", "journey_end_time")} / 24 as journey_duration_days,
  case last_event when 'DELIVERED' then
      case when journey_end_time <= promised_delivery_ts then 'MET' else 'BREACHED' end
    when 'DELIVERY_FAILED' then 'FAILED' when 'RETURNED_TO_ORIGIN' then 'FAILED'
    else 'IN_PROGRESS' end as sla_status,
  case when last_event = 'DELIVERED' then
    {hours_between("promised_delivery_ts", "journey_end_time")} end as sla_variance_hours,
  case last_event when 'DELIVERED' then 'DELIVERED' when 'DELIVERY_FAILED' then 'FAILED'
    when 'RETURNED_TO_ORIGIN' then 'RETURNED' else
      case when stuck_incidents > 0 then 'STUCK' else 'IN_TRANSIT' end end as journey_outcome,
  delivery_attempts > 1 as had_delivery_issues, route_hops <= 2 as is_express,
  case when hubs_visited <= 2 then 'SIMPLE' when hubs_visited <= 4 then 'MODERATE'
    else 'COMPLEX' end as complexity,
  cast(journey_start_time as date) as journey_date
from j"""
_J_DOUBLES = ("cod_amount max_gap_hours journey_duration_hours journey_duration_days "
              "sla_variance_hours")
SQL["journeys"] = rounded(_JOURNEYS, _J_DOUBLES)

SQL["stuck_shipments"] = rounded(f"""
select shipment_id, awb_number, hub_id, hub_name, event_type, event_timestamp,
  gap as time_since_prev_hours
from (select *, {_GAP} as gap from ({SHIPMENT_EVENTS}))
where gap > 24 and event_type not in ('DELIVERED', 'DELIVERY_FAILED', 'RETURNED_TO_ORIGIN')""",
    "time_since_prev_hours")

SQL["journeys_risk"] = f"""
with g as (select *, {_GAP} as gap from ({SHIPMENT_EVENTS})),
j as (
  select shipment_id, arg_min(origin_hub, {_AT}) as origin_hub,
    arg_min(destination_hub, {_AT}) as destination_hub,
    arg_min(promised_delivery_at, {_AT}) as promise, arg_max(event_type, {_AT}) as last_event,
    min(event_timestamp) as journey_start_time, max(event_timestamp) as journey_end_time,
    count(*) as total_events, count(distinct hub_id) as hubs_traversed,
    count(*) filter (gap > 24) as stuck_incidents, max(delivery_attempts) as delivery_attempts
  from g group by shipment_id)
select {key("shipment_id")} as journey_id, shipment_id, origin_hub, destination_hub,
  journey_start_time, journey_end_time, cast(journey_start_time as date) as journey_date,
  {half_up(hours_between("journey_start_time", "journey_end_time"), 2)}
    as journey_duration_hours,
  case last_event when 'DELIVERED' then 'DELIVERED' when 'DELIVERY_FAILED' then 'FAILED'
    when 'DELIVERY_ATTEMPTED' then 'AT_RISK' else 'IN_TRANSIT' end as journey_outcome,
  case last_event when 'DELIVERED' then
      case when journey_end_time <= promise then 'MET' else 'BREACHED' end
    when 'DELIVERY_FAILED' then 'FAILED' when 'DELIVERY_ATTEMPTED' then 'AT_RISK'
    else 'ON_TRACK' end as sla_status,
  case when last_event = 'DELIVERED' then
    {half_up(hours_between("promise", "journey_end_time"), 2)} end as sla_variance_hours,
  total_events, hubs_traversed, stuck_incidents, delivery_attempts
from j"""

_INT_JOURNEYS = f"""
with g as (select *, {_GAP} as gap from ({STG_SHIPMENTS})),
j as (
  select shipment_id, max_by(awb_number, {_AT}) as awb_number,
    max_by(seller_id, {_AT}) as seller_id, max_by(customer_id, {_AT}) as customer_id,
    max_by(origin_hub, {_AT}) as origin_hub, max_by(destination_hub, {_AT}) as destination_hub,
    bool_or(is_cod) as is_cod, max(cod_amount) as cod_amount, max(route_hops) as route_hops,
    min(event_timestamp) as journey_start_time, max(event_timestamp) as journey_end_time,
    min(event_date) as journey_start_date, max(promised_delivery_at) as promised_delivery_at,
    arg_min(event_type, {_AT}) as first_event_type, arg_max(event_type, {_AT}) as last_event_type,
    count(*) as total_events, count(distinct hub_id) as hubs_visited,
    count(*) filter (event_category = 'HUB_OPERATION') as hub_events,
    max(delivery_attempts) as delivery_attempts,
    arg_max_null(failure_reason, {_AT}) as last_failure_reason,
    count(*) filter (gap > 24) as stuck_incidents, max(gap) as max_gap_hours
  from g group by shipment_id)
select *, {hours_between("journey_start_time", "journey_end_time")} as journey_duration_hours,
  {hours_between("journey_start_time", "journey_end_time")} / 24 as journey_duration_days,
  case when last_event_type = 'DELIVERED' then
      case when journey_end_time <= promised_delivery_at then 'MET' else 'BREACHED' end
    when last_event_type in ('DELIVERY_FAILED', 'RETURNED_TO_ORIGIN', 'LOST', 'DAMAGED')
      then 'FAILED' else 'IN_PROGRESS' end as sla_status,
  case when last_event_type = 'DELIVERED' then
    {hours_between("promised_delivery_at", "journey_end_time")} end as sla_variance_hours,
  case last_event_type when 'DELIVERED' then 'DELIVERED' when 'DELIVERY_FAILED' then 'FAILED'
    when 'RETURNED_TO_ORIGIN' then 'RETURNED' else
      case when stuck_incidents > 0 then 'STUCK' else 'IN_TRANSIT' end end as journey_outcome,
  case when hubs_visited <= 2 then 'SIMPLE' when hubs_visited <= 4 then 'MODERATE'
    else 'COMPLEX' end as journey_complexity,
  delivery_attempts > 1 as had_delivery_issues, route_hops <= 2 as is_express
from j"""
SQL["journeys_sql_variant"] = rounded(_INT_JOURNEYS, _J_DOUBLES)

FCT_SHIPMENTS = f"""
select {key("shipment_id")} as shipment_key, shipment_id, awb_number, seller_id, customer_id,
  origin_hub as origin_hub_id, destination_hub as destination_hub_id,
  o.hub_name as origin_hub_name, o.city as origin_city, o.region as origin_region,
  d.hub_name as destination_hub_name, d.city as destination_city,
  d.region as destination_region, journey_start_date as date_key, journey_start_time,
  journey_end_time, promised_delivery_at, journey_outcome, sla_status, journey_complexity,
  is_express, is_cod, route_hops, hubs_visited, total_events, journey_duration_hours,
  sla_variance_hours, max_gap_hours, stuck_incidents, delivery_attempts, had_delivery_issues,
  cod_amount, cast(sla_status = 'MET' as integer) as sla_met_flag,
  cast(sla_status = 'BREACHED' as integer) as sla_breached_flag,
  cast(journey_outcome = 'DELIVERED' as integer) as delivered_flag,
  cast(journey_outcome = 'FAILED' as integer) as failed_flag,
  cast(journey_outcome = 'RETURNED' as integer) as returned_flag
from ({_INT_JOURNEYS}) j left join ({DIM_HUBS}) o on o.hub_id = j.origin_hub
  left join ({DIM_HUBS}) d on d.hub_id = j.destination_hub"""
SQL["fct_shipments"] = rounded(
    FCT_SHIPMENTS, "journey_duration_hours sla_variance_hours max_gap_hours cod_amount")

_THROUGHPUT = f"""
select *,
  case when arrivals > 0 then cast(departures as double) / arrivals end as throughput_ratio,
  case when inscans > 0 then cast(sorted as double) / inscans end as processing_rate,
  case when morning_events >= greatest(afternoon_events, evening_events, night_events)
      then 'MORNING' when afternoon_events >= greatest(evening_events, night_events)
      then 'AFTERNOON' when evening_events >= night_events then 'EVENING'
    else 'NIGHT' end as peak_period,
  arrivals > departures * 1.2e0 as has_backlog,
  case when arrivals > 0 and cast(departures as double) / arrivals >= 0.95 then 'HIGH'
    when arrivals > 0 and cast(departures as double) / arrivals >= 0.8 then 'MEDIUM'
    else 'LOW' end as efficiency_rating
from (
  select hub_id, hub_name, hub_city, event_date,
    count(distinct shipment_id) as unique_shipments, count(*) as total_events,
    count(*) filter (event_type = 'HUB_ARRIVED') as arrivals,
    count(*) filter (event_type = 'HUB_INSCAN') as inscans,
    count(*) filter (event_type = 'HUB_SORTED') as sorted,
    count(*) filter (event_type = 'HUB_OUTSCAN') as outscans,
    count(*) filter (event_type = 'HUB_DEPARTED') as departures,
    count(*) filter (hour_of_day between 6 and 11) as morning_events,
    count(*) filter (hour_of_day between 12 and 17) as afternoon_events,
    count(*) filter (hour_of_day >= 18) as evening_events,
    count(*) filter (hour_of_day < 6) as night_events,
    count(distinct worker_id) as unique_workers,
    count(distinct scanner_id) as unique_scanners
  from ({STG_SHIPMENTS}) group by all)"""
SQL["hub_throughput"] = rounded(_THROUGHPUT, "throughput_ratio processing_rate")
FCT_HUB_DAILY = f"""
select {key("hub_id", "event_date")} as hub_daily_key, hub_id, event_date as date_key,
  d.hub_name, d.city, d.region, d.hub_type, d.capacity_daily, unique_shipments, total_events,
  arrivals, departures, inscans, outscans, sorted, throughput_ratio, processing_rate,
  efficiency_rating, unique_shipments / cast(d.capacity_daily as double)
    as capacity_utilization, morning_events, afternoon_events, evening_events, night_events,
  peak_period, unique_workers, unique_scanners, has_backlog,
  cast(efficiency_rating = 'LOW' as integer) as is_bottleneck_flag
from ({_THROUGHPUT}) t left join ({DIM_HUBS}) d using (hub_id)"""
SQL["fct_hub_daily"] = rounded(
    FCT_HUB_DAILY, "throughput_ratio processing_rate capacity_utilization")

# ---- status, hops, service levels ---------------------------------------------------------------

STATUS = f"""
select shipment_id, max_by(event_type, {_AT}) as current_status,
  max_by(hub_id, {_AT}) as current_hub_id, max_by(event_id, {_AT}) as last_event_id,
  max_by(event_type, {_AT}) as last_event_type, max(event_timestamp) as last_event_timestamp,
  max_by(latitude, {_AT}) as current_latitude, max_by(longitude, {_AT}) as current_longitude,
  min(event_timestamp) as created_at
from ({SHIPMENT_EVENTS}) group by shipment_id"""
SQL["current_status"] = rounded(STATUS, "current_latitude current_longitude")

_SILENT = hours_between("last_event_timestamp", "timestamp '2001-08-10 00:00:00'")
SQL["stuck_alerts"] = rounded(f"""
select 'SHIPMENT' as module, 'STUCK_PACKAGE' as alert_type,
  case when {_SILENT} > 72 then 'CRITICAL' when {_SILENT} > 48 then 'HIGH'
    else 'WARNING' end as severity, shipment_id as entity_id, current_hub_id as hub_id,
  {_SILENT} as hours_since_last_event, timestamp '2001-08-10 00:00:00' as alert_timestamp
from ({STATUS})
where current_status not in ('DELIVERED', 'RETURNED_TO_ORIGIN', 'LOST') and {_SILENT} > 24""",
    "hours_since_last_event")

SQL["hub_hops"] = rounded(f"""
with e as (select * from ({SHIPMENT_EVENTS})),
h as (
  select *, row_number() over w as hop, lead(event_timestamp) over w as nxt
  from e where event_type = 'HUB_ARRIVED'
    and exists (select 1 from e d where d.shipment_id = e.shipment_id
                and d.event_type = 'DELIVERED')
  window w as ({_W}))
select shipment_id, hop as hop_sequence, hub_id, hub_city, event_timestamp as arrival_timestamp,
  nxt as departure_timestamp, {hours_between("event_timestamp", "nxt")} as dwell_time_hours,
  {hours_between("event_timestamp", "nxt")} > 12 as is_bottleneck, hop = 1 as is_first_hub
from h""", "dwell_time_hours")

def _sla(events: str) -> str:
    return f"""
with s as (
  select shipment_id, max_by(origin_hub, {_AT}) as origin_hub,
    max_by(destination_hub, {_AT}) as destination_hub,
    case when max_by(route_hops, {_AT}) <= 2 then 'EXPRESS' else 'STANDARD' end as service_type,
    cast(coalesce(min(event_timestamp) filter (event_type = 'CREATED'), min(event_timestamp))
      as date) as created_date,
    cast(max_by(promised_delivery_at, {_AT}) as date) as promised_date,
    cast(min(event_timestamp) filter (event_type = 'DELIVERED') as date)
      as actual_delivery_date,
    max(event_type) filter (event_type in ('DELIVERED', 'RETURNED_TO_ORIGIN', 'LOST'))
      as final_status
  from ({events}) group by shipment_id),
d as (
  select distinct origin_hub, destination_hub, service_type,
    case when service_type = 'EXPRESS' then 3 else 7 end as promised_days
  from (select ([{", ".join("'" + h + "'" for h in (
      'HUB_DEL_01', 'HUB_MUM_01', 'HUB_BLR_01', 'HUB_CHN_01', 'HUB_HYD_01', 'HUB_KOL_01',
      'HUB_PUN_01', 'HUB_AMD_01', 'HUB_JAI_01', 'HUB_LKO_01'))}]) as hubs,
      hubs[o_custkey % 10 + 1] as origin_hub, hubs[(o_custkey // 10) % 10 + 1]
        as destination_hub,
      case when o_orderkey % 3 = 0 then 'EXPRESS' else 'STANDARD' end as service_type
    from orders))
select shipment_id, origin_hub, destination_hub, service_type, created_date, promised_date,
  actual_delivery_date, promised_days,
  cast(actual_delivery_date - created_date as integer) as actual_days,
  cast(actual_delivery_date - promised_date as integer) as variance_days,
  case when actual_delivery_date is null then 'PENDING'
    when actual_delivery_date <= promised_date then 'MET' else 'BREACHED' end as sla_status,
  final_status, actual_delivery_date is not null as is_delivered,
  actual_delivery_date <= promised_date as is_on_time
from s left join d using (origin_hub, destination_hub, service_type)"""


SQL["sla_tracking"] = _sla(SHIPMENT_EVENTS)

SQL["sla_merge"] = f"""
with before as ({_sla(f"select * from ({SHIPMENT_EVENTS}) where event_date <= date '1998-12-31'")}),
merged as (
  select * from ({_sla(SHIPMENT_EVENTS)})
  where created_date >= (select max(created_date) - 3 from before))
select * from merged
union all select * from before where shipment_id not in (select shipment_id from merged)"""

SQL["hub_inventory"] = f"""
with d as (
  select hub_id, event_date, count(*) filter (event_type = 'HUB_ARRIVED') as packages_received,
    count(*) filter (event_type = 'HUB_DEPARTED') as packages_dispatched,
    count(*) filter (event_type in ('HUB_INSCAN', 'HUB_SORTED')) as packages_processed
  from ({SHIPMENT_EVENTS}) group by all)
select *, cast(sum(packages_received - packages_dispatched) over
    (partition by hub_id order by event_date) as bigint) as closing_inventory,
  cast(coalesce(sum(packages_received - packages_dispatched) over
    (partition by hub_id order by event_date rows between unbounded preceding and 1 preceding),
    0) as bigint) as opening_inventory
from d"""

_DUE = hours_between("timestamp '1998-06-01 00:00:00'", "promised_delivery_ts")
SQL["sla_risk"] = f"""
select shipment_id, sla_status, promised_delivery_ts,
  sla_status = 'IN_PROGRESS' and {_DUE} between 0 and 12 as is_sla_at_risk,
  sla_status = 'BREACHED' or (sla_status = 'IN_PROGRESS' and {_DUE} < 0) as is_sla_breached
from ({_JOURNEYS})"""

_NEXT = [
    ("CREATED", "PICKUP_SCHEDULED PICKED_UP"), ("PICKUP_SCHEDULED", "PICKED_UP"),
    ("PICKED_UP", "HUB_ARRIVED IN_TRANSIT"), ("HUB_ARRIVED", "HUB_INSCAN"),
    ("HUB_INSCAN", "HUB_SORTED"), ("HUB_SORTED", "HUB_OUTSCAN OUT_FOR_DELIVERY"),
    ("HUB_OUTSCAN", "HUB_DEPARTED OUT_FOR_DELIVERY"), ("HUB_DEPARTED", "IN_TRANSIT HUB_ARRIVED"),
    ("IN_TRANSIT", "HUB_ARRIVED OUT_FOR_DELIVERY"),
    ("OUT_FOR_DELIVERY", "DELIVERED DELIVERY_ATTEMPTED DELIVERY_FAILED"),
    ("DELIVERY_ATTEMPTED", "OUT_FOR_DELIVERY DELIVERED DELIVERY_FAILED"),
    ("DELIVERY_FAILED", "RETURNED_TO_ORIGIN"),
]
_PAIRS = ", ".join(f"('{a}', '{b}')" for a, bs in _NEXT for b in bs.split())
SQL["validate_sequence"] = f"""
select event_id, shipment_id, event_timestamp, n as event_sequence, p as prev_event_type,
  event_type, case when p is null then event_type = 'CREATED'
    else (p, event_type) in ({_PAIRS}) or (event_type in ('LOST', 'DAMAGED')
      and p not in ('DELIVERED', 'RETURNED_TO_ORIGIN', 'LOST', 'DAMAGED')) end
    as is_valid_transition
from (select *, row_number() over w as n, lag(event_type) over w as p
      from ({SHIPMENT_EVENTS}) window w as ({_W}))"""

SQL["e2e_journey"] = rounded(f"""
with r as (
  select shipment_id, max_by(seller_id, {_AT}) as seller_id,
    max_by(customer_id, {_AT}) as customer_id, max_by(origin_hub, {_AT}) as origin_hub,
    max_by(destination_hub, {_AT}) as destination_hub,
    max_by(promised_delivery_at, {_AT}) as promise, max_by(event_type, {_AT}) as final_status,
    min(event_timestamp) as a, max(event_timestamp) as b,
    min(event_timestamp) filter (event_type = 'PICKED_UP') as pickup_timestamp,
    min(event_timestamp) filter (event_type like 'HUB%') as first_hub_timestamp,
    min(event_timestamp) filter (event_type in ('OUT_FOR_DELIVERY', 'DELIVERY_ATTEMPTED',
      'DELIVERED', 'DELIVERY_FAILED')) as lm,
    min(event_timestamp) filter (event_type = 'DELIVERED') as delivery_timestamp,
    count(distinct hub_id) as total_hubs, max(delivery_attempts) as delivery_attempts
  from ({SHIPMENT_EVENTS}) group by shipment_id),
w as (
  select shipment_id, sum(hub_dwell_hours) as total_hub_dwell_hours,
    max_by(hub_id, (hub_dwell_hours, hub_id)) as bottleneck_hub_id
  from ({_DWELL}) group by shipment_id),
l as (
  select *, case when first_hub_timestamp >= pickup_timestamp then
      {hours_between("pickup_timestamp", "first_hub_timestamp")} end as first_mile_hours,
    case when lm >= first_hub_timestamp then {hours_between("first_hub_timestamp", "lm")} end
      as mid_mile_hours,
    case when delivery_timestamp >= lm then {hours_between("lm", "delivery_timestamp")} end
      as last_mile_hours
  from r left join w using (shipment_id)),
g as (select *, greatest(first_mile_hours, mid_mile_hours, last_mile_hours,
        total_hub_dwell_hours) as longest_leg_hours from l)
select shipment_id, seller_id, customer_id, origin_hub, destination_hub, total_hubs,
  pickup_timestamp, first_hub_timestamp, first_mile_hours, mid_mile_hours,
  total_hub_dwell_hours, delivery_timestamp, last_mile_hours, delivery_attempts,
  {hours_between("a", "b")} as total_journey_hours,
  case when final_status = 'DELIVERED' then case when b <= promise then 'MET' else 'BREACHED' end
    when final_status in ('DELIVERY_FAILED', 'RETURNED_TO_ORIGIN', 'LOST', 'DAMAGED')
      then 'FAILED' else 'IN_PROGRESS' end as sla_status,
  case when final_status = 'DELIVERED' then {hours_between("promise", "b")} end
    as sla_variance_hours, final_status,
  case longest_leg_hours when first_mile_hours then 'FIRST_MILE'
    when mid_mile_hours then 'MID_MILE' when last_mile_hours then 'LAST_MILE'
    when total_hub_dwell_hours then 'HUB_DWELL' end as longest_leg,
  longest_leg_hours, bottleneck_hub_id
from g""", "first_mile_hours mid_mile_hours total_hub_dwell_hours last_mile_hours "
           "total_journey_hours sla_variance_hours longest_leg_hours")

# ---- dimensions ---------------------------------------------------------------------------------

SQL["dim_hubs_activity"] = f"""
select d.hub_id, d.hub_name, d.city, d.region, d.hub_type, d.capacity_daily, d.is_active,
  case d.hub_type when 'MEGA' then 1 when 'REGIONAL' then 2 when 'LOCAL' then 3 else 4 end
    as hub_tier,
  case d.region when 'North' then 'IN-N' when 'South' then 'IN-S' when 'East' then 'IN-E'
    when 'West' then 'IN-W' else 'IN-OT' end as region_code,
  count(e.event_id) as total_events, count(distinct e.shipment_id) as unique_shipments
from ({DIM_HUBS}) d left join ({SHIPMENT_EVENTS}) e using (hub_id) group by all"""

_CALENDAR = """
select d as date_key, d as full_date, cast(year(d) as integer) as year,
  cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as month,
  cast(week(d) as integer) as week_of_year, cast(day(d) as integer) as day_of_month,
  cast(dayofweek(d) as integer) as day_of_week, cast(dayofyear(d) as integer) as day_of_year,
  strftime(d, '%Y-%m') as year_month,
  strftime(d, '%Y') || '-Q' || cast(quarter(d) as varchar) as year_quarter,
  strftime(d, '%B') as month_name, strftime(d, '%b') as month_name_short,
  strftime(d, '%A') as day_name, strftime(d, '%a') as day_name_short,
  dayofweek(d) in (0, 6) as is_weekend, dayofweek(d) between 1 and 5 as is_weekday,
  cast(case when month(d) >= 4 then year(d) else year(d) - 1 end as integer) as fiscal_year,
  cast(case when month(d) >= 4 then month(d) - 3 else month(d) + 9 end as integer)
    as fiscal_month
from ({days})"""
SQL["dim_time"] = _CALENDAR.replace("{days}", f"""
  select distinct cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d
  from (select min(event_date) as lo, max(event_date) as hi from ({SHIPMENT_EVENTS}))""")
SQL["event_calendar"] = _CALENDAR.replace(
    "{days}", f"select distinct event_date as d from ({SHIPMENT_EVENTS})")

SQL["dim_time_hourly"] = f"""
select cast(strftime(t, '%Y%m%d%H') as integer) as time_key, cast(t as date) as full_date,
  cast(year(t) as integer) as year, cast(quarter(t) as integer) as quarter,
  cast(month(t) as integer) as month, strftime(t, '%B') as month_name,
  cast(week(t) as integer) as week_of_year, cast(day(t) as integer) as day_of_month,
  cast(isodow(t) as integer) as day_of_week, strftime(t, '%A') as day_name,
  cast(hour(t) as integer) as hour,
  cast(case when hour(t) % 12 = 0 then 12 else hour(t) % 12 end as integer) as hour_12,
  case when hour(t) < 12 then 'AM' else 'PM' end as am_pm,
  case when hour(t) <= 5 or hour(t) >= 21 then 'NIGHT' when hour(t) <= 8 then 'EARLY_MORNING'
    when hour(t) <= 11 then 'MORNING' when hour(t) <= 14 then 'AFTERNOON'
    when hour(t) <= 17 then 'LATE_AFTERNOON' else 'EVENING' end as time_band,
  dayofweek(t) in (0, 6) as is_weekend,
  hour(t) in (8, 9, 10, 17, 18, 19, 20) as is_peak_hour,
  hour(t) between 9 and 17 and dayofweek(t) between 1 and 5 as is_business_hour
from (select distinct date_trunc('hour', event_timestamp) as t from ({SHIPMENT_EVENTS}))"""

def _r(column: str, digits: int) -> str:
    return half_up(column, digits)


def _cell(lat: str, lng: str, res: int) -> str:
    return (f"'h3_{res}_' || cast({lat} as varchar) || '_' || cast({lng} as varchar)")


SQL["dim_geography"] = rounded(f"""
with c as (
  select {_r("delivery_lat", 2)} as center_latitude, {_r("delivery_lng", 2)} as center_longitude,
    count(*) as total_deliveries, count(*) filter (event_type = 'DELIVERED') as wins,
    avg(time_at_location_seconds) as secs
  from ({DELIVERY_EVENTS}) group by all)
select {_cell("center_latitude", "center_longitude", 9)} as geo_key,
  {_cell(_r("center_latitude", 1), _r("center_longitude", 1), 7)} as geo_key_coarse,
  center_latitude, center_longitude, total_deliveries,
  wins * 1e2 / total_deliveries as avg_delivery_success_rate,
  secs / 6e1 as avg_delivery_time_minutes,
  case when total_deliveries >= 100 then 'HIGH' when total_deliveries >= 20 then 'MEDIUM'
    else 'LOW' end as order_density_category
from c""", "center_latitude center_longitude avg_delivery_success_rate "
           "avg_delivery_time_minutes")

_PER_SHIPMENT = f"""
select shipment_id, max_by(customer_id, {_AT}) as customer_id,
  max_by(seller_id, {_AT}) as seller_id, max_by(cod_amount, {_AT}) as cod_amount,
  max_by(weight_kg, {_AT}) as weight_kg, max_by(origin_hub, {_AT}) as origin_hub,
  cast(min(event_timestamp) as date) as order_date,
  bool_or(event_type = 'DELIVERED') as delivered
from ({SHIPMENT_EVENTS}) group by shipment_id"""
SQL["dim_customers"] = rounded(f"""
select customer_id, count(*) as total_orders, min(order_date) as first_order_date,
  max(order_date) as last_order_date, avg(cod_amount) as avg_order_value,
  avg(cast(delivered as integer)) * 1e2 as delivery_success_rate,
  {key("customer_id")} as customer_key
from ({_PER_SHIPMENT}) group by customer_id""", "avg_order_value delivery_success_rate")
SQL["dim_sellers"] = rounded(f"""
with s as (select * from ({_PER_SHIPMENT})),
h as (select seller_id, origin_hub, count(*) as n from s group by all)
select {key("seller_id")} as seller_key, seller_id,
  (select origin_hub from h where h.seller_id = s.seller_id order by n desc, origin_hub limit 1)
    as primary_hub_id,
  count(*) as total_shipments, count(*) / count(distinct order_date) as avg_daily_shipments,
  sum(weight_kg) / count(*) as avg_weight_kg
from s group by seller_id""", "avg_daily_shipments avg_weight_kg")
