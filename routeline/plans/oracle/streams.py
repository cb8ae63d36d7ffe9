"""Oracle SQL for the streams: the batch answer over the same input."""

from __future__ import annotations

from routeline.plans.oracle import delivery, fleet, shipments
from routeline.plans.oracle.feeds import (
    AGENT_POSITIONS, DELIVERY_EVENTS, rounded, seconds_between, vehicle_positions,
)

SQL: dict[str, str] = {
    "stream_bronze": fleet.SQL["bronze_validate"],
    "stream_speeding": fleet.SPEEDING,
    "stream_driving_events": fleet.SQL["driving_events"],
    "stream_geofence": fleet.SQL["geofence_events"],
    "stream_status_upsert": shipments.SQL["current_status"],
    "stream_alerts": delivery.SQL["alerts_unified"],
}

SQL["stream_dedup"] = rounded(f"""
select event_id, vehicle_id, event_timestamp, speed_kmh
from ({vehicle_positions("raw")})""", "speed_kmh")

SQL["stream_failure_alerts"] = f"""
select 'LAST_MILE' as module, 'DELIVERY_FAILED' as alert_type, 'WARNING' as severity,
  'ORDER' as entity_type, order_id as entity_id, agent_id, failure_reason,
  event_timestamp as alert_timestamp
from ({DELIVERY_EVENTS}) where event_type = 'DELIVERY_FAILED'"""

# a session or window is final once the watermark (latest event minus the delay) passes its end
SQL["stream_stops"] = rounded(f"""
with p as (select * from ({AGENT_POSITIONS}) where speed_kmh < 2),
s as (
  select *, sum(cast(turn as integer)) over (partition by agent_id order by event_timestamp,
      event_id rows unbounded preceding) as run
  from (select *, coalesce(event_timestamp - lag(event_timestamp) over
          (partition by agent_id order by event_timestamp, event_id) >= interval 90 minute,
          true) as turn from p))
select agent_id, min(event_timestamp) as stop_start, max(event_timestamp) as stop_end,
  avg(latitude) as latitude, avg(longitude) as longitude, count(*) as position_count,
  {seconds_between("min(event_timestamp)", "max(event_timestamp)")} as stop_seconds
from s group by agent_id, run
having {seconds_between("min(event_timestamp)", "max(event_timestamp)")} >= 60
  and max(event_timestamp) + interval 90 minute
    <= (select max(event_timestamp) - interval 10 minute from p)""",
    "latitude longitude stop_seconds")

SQL["stream_rollup"] = rounded(f"""
select cast(event_date as timestamp) as window_start,
  cast(event_date as timestamp) + interval 1 day as window_end, zone_id, count(*) as events,
  avg(speed_kmh) as avg_speed_kmh, max(speed_kmh) as max_speed_kmh
from ({AGENT_POSITIONS})
group by event_date, zone_id
having cast(event_date as timestamp) + interval 1 day
  <= (select max(event_timestamp) - interval 1 hour from ({AGENT_POSITIONS}))""",
    "avg_speed_kmh max_speed_kmh")
