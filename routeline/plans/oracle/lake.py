"""Oracle SQL for the queries over sources, sinks and runs."""

from __future__ import annotations

from routeline.contracts import SHIPMENT_EVENT_TYPES
from routeline.plans.oracle import fleet
from routeline.plans.oracle.feeds import (
    AGENT_POSITIONS, ALERTS, DELIVERY_EVENTS, SHIPMENT_EVENTS, VEHICLE_TELEMETRY, rounded, vehicle_positions,
)

_KINDS = ", ".join(f"'{k}'" for k in SHIPMENT_EVENT_TYPES)
# the table of CRC-32, which DuckDB lacks, and the sum of one text
CRC_TABLE = """
crc_steps as (
  select range as n, 0 as step, range::bigint as c from range(256)
  union all
  select n, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end from crc_steps where step < 8),
crc_table as (select list(c order by n) as t from crc_steps where step = 8)"""


def sql_crc32(text: str) -> str:
    return (f"xor(list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::bigint), "
            f"lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)")


SQL: dict[str, str] = {
    "ingest_vehicle_telemetry": rounded(
        f"select event_id, vehicle_id, engine_rpm, engine_temp_c, event_date from ({VEHICLE_TELEMETRY})", "engine_temp_c"),
    "ingest_alerts": f"select event_id, vehicle_id, event_type, severity, event_date from ({ALERTS})",
    "ingest_shipment_events": f"""
select event_id, shipment_id, event_type, hub_id, {fleet.INSIDE} as is_valid_location,
  event_type in ({_KINDS}) as is_valid_event_type from ({SHIPMENT_EVENTS})""",
    "ingest_agent_positions": f"""
select event_id, agent_id, {fleet.INSIDE} as is_valid_location, event_date from ({AGENT_POSITIONS})""",
    "ingest_delivery_events": f"""
select event_id, agent_id, event_type,
  {fleet.INSIDE.replace("latitude", "delivery_lat").replace("longitude", "delivery_lng")} as is_valid_location, event_date
from ({DELIVERY_EVENTS})""",
    "ingest_selected_topics": f"""
select 'alerts' as topic, count(*) as rows, count(distinct event_date) as days from ({ALERTS})
union all select 'vehicle_positions', count(*), count(distinct event_date) from ({vehicle_positions("raw")})""",
    "bronze_day": f"""
select event_id, vehicle_id, event_type, event_date from ({ALERTS})
where event_date in (date '2024-01-14', date '2024-01-15')""",
    "source_views": f"""
select 'alerts' as view, severity as kind, count(*) as rows, sum(cast(event_id as bigint))::bigint as total
from ({ALERTS}) group by severity
union all select 'trips', trip_type, count(*), sum(position_count)::bigint from ({fleet.SQL["trips_haversine"]}) group by trip_type
union all select 'trips', null, count(*), -sum(position_count)::bigint from ({fleet.SQL["trips_haversine"]})""",
    "chosen_root": f"select severity, count(*) as rows from ({ALERTS}) group by severity",
    "shared_scan": rounded("select event_type, count(*) as rows, max(value) as highest from events group by event_type", "highest"),
    "silver_rerun": f"""
select event_date, count(*) as rows, count(distinct event_id) as events from ({ALERTS}) group by event_date""",
    "materialized_models": f"""
select alert_category, alert_type, count(*) as rows, max(severity_score) as worst,
  timestamp '2024-02-01 00:00:00' as loaded_at from ({fleet.STG_ALERTS}) group by all""",
    "dataset_manifest": f"""
select 'alerts' as dataset, (select count(*) from ({ALERTS})) as rows,
  'event_id,event_type,severity,timestamp,vehicle_id,driver_id,latitude,longitude,speed,speed_limit,overspeed_by,'
  || 'deceleration_ms2,acceleration_ms2,event_timestamp,event_date' as columns
union all select 'shipment_events', (select count(*) from ({SHIPMENT_EVENTS})),
  'event_id,shipment_id,awb_number,timestamp,event_type,hub_id,hub_name,hub_city,latitude,longitude,seller_id,'
  || 'customer_id,origin_hub,destination_hub,weight_kg,is_cod,cod_amount,promised_delivery,route_hops,current_hop,'
  || 'delivery_attempts,failure_reason,scanner_id,worker_id,event_timestamp,event_date'
union all select 'trips', (select count(*) from ({fleet.SQL["trips_haversine"]})), 'trip_id,vehicle_id'""",
    "latest_report": f"""
with c as (select count(*) > 0 as a, count(*) = count(distinct event_id) as b,
    avg((severity = 'HIGH')::int) >= 99e-2 as c, count(*) = count(vehicle_id) as d from ({ALERTS}))
select 'bronze' as layer, timestamp '2024-02-03 00:00:00' as run_time, a and b and c and d as overall_success,
  4::bigint as total_checks, (a::int + b::int + c::int + d::int)::bigint as passed,
  (4 - a::int - b::int - c::int - d::int)::bigint as failed, (a::int + b::int + c::int + d::int) * 25e0 as pass_rate
from c""",
    "missing_table_check": f"""
select 'alerts' as "table", 'row_count' as "check", count(*) > 0 as success, count(*) as total_rows,
  null::varchar as error from ({ALERTS})
union all select 'alerts', 'not_null', count(*) = count(vehicle_id), count(*), null from ({ALERTS})
union all select 'orders_archive', 'table_exists', false, null, 'Path not found: orders_archive'""",
    "preview_view": "select * from nation",
    "backfilled_columns": rounded(f"""
select trip_id, vehicle_id, total_distance_km, trip_duration_minutes, total_distance_km as distance_km,
  trip_duration_minutes as duration_minutes, timestamp '2024-02-01 00:00:00' as reconstructed_at
from ({fleet.SQL["trips_haversine"]})""", "total_distance_km trip_duration_minutes distance_km duration_minutes"),
    "haversine_forms": rounded(f"""
with p as (select event_id, case when latitude is not null then least(1e0, pow(sin(radians(285505e-4 - latitude) / 2), 2)
    + cos(radians(latitude)) * cos(radians(285505e-4)) * pow(sin(radians(772506e-4 - longitude) / 2), 2)) end as h
  from ({vehicle_positions("raw", dirty=True)}))
select event_id, 2 * 6371e0 * asin(sqrt(h)) as asin_km, 2 * 6371e0 * atan2(sqrt(h), sqrt(1 - h)) as atan2_km from p""",
        "asin_km atan2_km"),
    "scd2_customers": """
with c as (select *, c_custkey % 11 = 0 as gone, c_custkey % 7 = 0 as moved from customer)
select c_custkey, c_mktsegment, c_nationkey, date '2024-01-01' as effective_from,
  case when gone or moved then date '2024-06-01' end as effective_to, not (gone or moved) as is_current from c
union all
select c_custkey, c_mktsegment || '+', c_nationkey, date '2024-06-01', null, true from c where moved and not gone""",
    "correlated_vehicles": f"""
with recursive {CRC_TABLE},
seen as (
  select cast(floor(latitude / 5e-1) as bigint) as y, cast(floor(longitude / 5e-1) as bigint) as x, event_timestamp as seen_at,
    arg_max(vehicle_id, event_id) as vehicle_id
  from ({vehicle_positions("raw")}) where latitude is not null and longitude is not null group by all),
asks as (
  select event_id, shipment_id, hub_id, cast(floor(latitude / 5e-1) as bigint) as y, cast(floor(longitude / 5e-1) as bigint) as x,
    make_timestamp((1704067200 + (epoch_us(event_timestamp) // 1000000 + {sql_crc32("event_id")}) % 2592000) * 1000000) as event_timestamp
  from ({SHIPMENT_EVENTS}), crc_table where event_type = 'HUB_DEPARTED'),
met as (
  select a.*, s.vehicle_id, s.seen_at from asks a asof left join seen s
    on a.y = s.y and a.x = s.x and a.event_timestamp >= s.seen_at)
select event_id, shipment_id, hub_id, event_timestamp,
  case when event_timestamp - seen_at <= interval 6 hours then vehicle_id end as vehicle_id,
  case when event_timestamp - seen_at <= interval 6 hours then seen_at end as vehicle_seen_at
from met""",
    "changed_trips": fleet.SQL["trips_haversine"],
}
