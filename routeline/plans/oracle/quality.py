"""Oracle SQL: quality checks, model tests, figures and distributions."""

from __future__ import annotations

from routeline.contracts import DELIVERY_EVENT_TYPES, SHIPMENT_EVENT_TYPES
from routeline.plans.oracle import delivery, fleet, shipments
from routeline.plans.oracle.feeds import (
    DIM_HUBS, AGENT_POSITIONS, ALERTS, DELIVERY_EVENTS, SHIPMENT_EVENTS, half_up, rounded,
    vehicle_positions,
)

SQL: dict[str, str] = {}

_DIRTY = vehicle_positions("raw", dirty=True)


def _row(kind: str, table: str, source: str, column: str | None, threshold: float | None,
         total: str, passing: str, success: str, stats: bool = False,
         listing: str | None = None) -> str:
    name = "cast(null as varchar)" if column is None else f"'{column}'"
    limit = "cast(null as double)" if threshold is None else f"{threshold!r}::double"
    ratio = ("cast(null as double)" if threshold is None else
             half_up(f"{passing} / cast(nullif({total}, 0) as double)", 4))
    numbers = (f"cast(min({column}) as double), cast(max({column}) as double), avg({column})"
               if stats else "null::double, null::double, null::double")
    return f"""
    select '{kind}' as "check", '{table}' as "table", {name} as "column", {success} as success,
      {limit} as threshold, {ratio} as actual_ratio, cast({total} as bigint) as total_rows,
      cast({passing} as bigint) as passing_rows, {numbers},
      {listing or "cast(null as varchar)"} as invalid_values_sample,
      cast(null as varchar) as message, cast(null as varchar) as error
    from ({source})"""


def _count(table, source, least=1):
    return _row("row_count", table, source, None, None, "count(*)", "count(*)",
                f"count(*) >= {least}")


def _filled(table, source, column):
    return _row("not_null", table, source, column, 1.0, "count(*)", f"count({column})",
                f"count({column}) = count(*)")


def _between(table, source, column, low, high, threshold=0.98):
    inside = f"count(*) filter ({column} between {low} and {high})"
    return _row("value_range", table, source, column, threshold, f"count({column})", inside,
                f"{inside} / cast(count({column}) as double) >= {threshold!r}", stats=True)


def _among(table, source, column, values):
    listed = ", ".join(f"'{v}'" for v in values)
    good = f"count(*) filter ({column} in ({listed}))"
    return _row("accepted_values", table, source, column, 1.0, f"count({column})", good,
                f"{good} = count({column})", listing="''")


def _distinct(table, source, column):
    return _row("unique", table, source, column, None, "count(*)", f"count(distinct {column})",
                f"count(*) = count(distinct {column})")


def _all(*parts: str) -> str:
    first, *rest = parts
    named = first.replace("null::double, null::double, null::double",
                          "null::double as actual_min, null::double as actual_max, "
                          "null::double as actual_avg")
    return " union all ".join([named, *rest])


_BRONZE = _all(
    _count("vehicle_positions", _DIRTY), _filled("vehicle_positions", _DIRTY, "event_id"),
    _filled("vehicle_positions", _DIRTY, "vehicle_id"),
    _filled("vehicle_positions", _DIRTY, "latitude"),
    _filled("vehicle_positions", _DIRTY, "longitude"),
    _between("vehicle_positions", _DIRTY, "latitude", 8, 37),
    _between("vehicle_positions", _DIRTY, "longitude", 68, 97.5),
    _between("vehicle_positions", _DIRTY, "speed_kmh", 0, 200, 0.99),
    _count("shipment_events", SHIPMENT_EVENTS),
    _filled("shipment_events", SHIPMENT_EVENTS, "event_id"),
    _filled("shipment_events", SHIPMENT_EVENTS, "shipment_id"),
    _filled("shipment_events", SHIPMENT_EVENTS, "event_type"),
    _among("shipment_events", SHIPMENT_EVENTS, "event_type", SHIPMENT_EVENT_TYPES),
    _count("agent_positions", AGENT_POSITIONS),
    _filled("agent_positions", AGENT_POSITIONS, "agent_id"),
    _between("agent_positions", AGENT_POSITIONS, "latitude", 8, 37),
    _between("agent_positions", AGENT_POSITIONS, "longitude", 68, 97.5),
    _count("delivery_events", DELIVERY_EVENTS),
    _filled("delivery_events", DELIVERY_EVENTS, "event_id"),
    _filled("delivery_events", DELIVERY_EVENTS, "agent_id"),
    _among("delivery_events", DELIVERY_EVENTS, "event_type", DELIVERY_EVENT_TYPES),
    _between("delivery_events", DELIVERY_EVENTS, "customer_rating", 1, 5, 1.0),
)
_TRIPS = fleet._TRIPS
_SILVER = _all(
    _count("trips", _TRIPS), _filled("trips", _TRIPS, "trip_id"),
    _distinct("trips", _TRIPS, "trip_id"),
    _between("trips", _TRIPS, "total_distance_km", 0, 2000, 0.99),
    _count("journeys", shipments._JOURNEYS),
    _filled("journeys", shipments._JOURNEYS, "shipment_id"),
    _distinct("journeys", shipments._JOURNEYS, "shipment_id"),
    _count("agent_shifts", delivery._SHIFTS),
    _filled("agent_shifts", delivery._SHIFTS, "agent_id"),
)
_FIGURES = "actual_min actual_max actual_avg"
SQL["dq_bronze"] = rounded(_BRONZE, _FIGURES)
SQL["dq_silver"] = rounded(_SILVER, _FIGURES)
SQL["dq_report"] = f"""
select 'all' as layer, timestamp '2024-02-01 00:00:00' as run_time,
  bool_and(success) as overall_success, count(*) as total_checks,
  count(*) filter (success) as passed, count(*) filter (not success) as failed,
  {half_up("count(*) filter (success) * 1e2 / count(*)", 2)} as pass_rate
from ({_BRONZE} union all {_SILVER})"""
SQL["dq_failed"] = f"""
select "table", "column", "check", coalesce(error, 'Check failed') as reason
from ({_BRONZE}) where not success"""

_MODELS = {
    "stg_vehicle_positions": fleet.STG_POSITIONS.format(src=_DIRTY),
    "stg_vehicle_telemetry": fleet.SQL["stg_vehicle_telemetry"],
    "stg_alerts": fleet.STG_ALERTS, "stg_shipment_events": shipments.STG_SHIPMENTS,
    "stg_agent_positions": delivery.STG_AGENTS, "stg_delivery_events": delivery.STG_DELIVERIES,
    "fct_trips": fleet.FCT_TRIPS, "fct_driver_performance": fleet.FCT_DRIVER,
    "fct_shipments": shipments.FCT_SHIPMENTS, "fct_hub_daily": shipments.FCT_HUB_DAILY,
    "fct_agent_daily": delivery.FCT_AGENTS, "fct_zone_daily": delivery.SQL["fct_zone_daily"],
    "dim_time": shipments.SQL["dim_time"], "dim_hubs": DIM_HUBS,
}
_ENUMS = {
    ("stg_vehicle_positions", "vehicle_state"): "IDLE MOVING STOPPED",
    ("stg_vehicle_telemetry", "engine_temp_status"): "NORMAL OVERHEATING COLD_RUNNING",
    ("stg_alerts", "alert_type"): "SPEEDING HARSH_BRAKING HARSH_ACCELERATION",
    ("stg_alerts", "severity"): "INFO WARNING HIGH CRITICAL",
    ("stg_shipment_events", "event_type"): " ".join(SHIPMENT_EVENT_TYPES),
    ("stg_shipment_events", "journey_stage"): "FIRST_MILE MID_MILE LAST_MILE EXCEPTION OTHER",
    ("stg_agent_positions", "agent_status"): "AVAILABLE ON_DELIVERY BREAK OFFLINE",
    ("stg_delivery_events", "event_type"): " ".join(DELIVERY_EVENT_TYPES),
    ("stg_delivery_events", "delivery_outcome"): "SUCCESS FAILED ATTEMPTED OTHER",
    ("stg_delivery_events", "customer_rating"): "1 2 3 4 5",
    ("fct_shipments", "sla_status"): "MET BREACHED FAILED IN_PROGRESS",
    ("fct_shipments", "journey_outcome"): "DELIVERED FAILED RETURNED STUCK IN_TRANSIT",
    ("fct_hub_daily", "efficiency_rating"): "HIGH MEDIUM LOW",
    ("fct_agent_daily", "performance_tier"): "TOP_PERFORMER GOOD AVERAGE BELOW_AVERAGE",
    ("dim_hubs", "hub_type"): "MEGA REGIONAL LOCAL",
    ("fct_zone_daily", "zone_performance_tier"): "EXCELLENT GOOD AVERAGE NEEDS_IMPROVEMENT",
}
_UNIQUE = {m: "event_id" for m in _MODELS if m.startswith("stg")} | {
    "fct_trips": "trip_key", "fct_driver_performance": "performance_key",
    "fct_shipments": "shipment_key", "fct_hub_daily": "hub_daily_key",
    "fct_agent_daily": "agent_daily_key", "fct_zone_daily": "zone_daily_key",
    "dim_time": "date_key", "dim_hubs": "hub_id"}
_FILLED = [(m, c) for m, c in _UNIQUE.items()] + [
    ("stg_vehicle_positions", "vehicle_id"), ("stg_vehicle_positions", "latitude"),
    ("stg_vehicle_positions", "longitude"), ("stg_vehicle_telemetry", "vehicle_id"),
    ("stg_alerts", "alert_type"), ("stg_shipment_events", "shipment_id"),
    ("stg_shipment_events", "event_type"), ("stg_agent_positions", "agent_id"),
    ("stg_agent_positions", "latitude"), ("stg_agent_positions", "longitude"),
    ("stg_delivery_events", "agent_id"), ("stg_delivery_events", "order_id"),
    ("stg_delivery_events", "event_type"), ("fct_trips", "trip_id"),
    ("fct_shipments", "shipment_id")]


def _tests() -> str:
    parts = []
    for m, c in _UNIQUE.items():
        parts.append((m, c, "unique", f"count({c}) - count(distinct {c})"))
    for m, c in _FILLED:
        parts.append((m, c, "not_null", f"count(*) filter ({c} is null)"))
    for (m, c), values in _ENUMS.items():
        listed = ", ".join(f"'{v}'" for v in values.split())
        parts.append((m, c, "accepted_values", f"count(*) filter ({c} is not null and "
                                               f"cast({c} as varchar) not in ({listed}))"))
    return " union all ".join(
        f"select '{m}' as model, '{c}' as \"column\", '{t}' as test, cast({e} as bigint) as "
        f"failures from ({_MODELS[m]})" for m, c, t, e in parts)


SQL["model_tests"] = (f"select *, case when failures = 0 then 'pass' else 'warn' end as status "
                      f"from ({_tests()})")

SQL["relationships"] = f"""
select vehicle_id, count(*) as n_records from ({_DIRTY})
where vehicle_id not in (select vehicle_id from ({ALERTS}) where event_type = 'SPEEDING')
group by vehicle_id"""
SQL["expression_check"] = f"""
select count(*) as total_rows, count(*) filter (not (cod_collected <= cod_amount
    and attempt_number <= 2)) as failures,
  count(*) filter (not (cod_collected <= cod_amount and attempt_number <= 2)) = 0 as success
from ({DELIVERY_EVENTS})"""
SQL["failing_rows"] = f"""
select trip_id as unique_field, count(*) as n_records from ({vehicle_positions("raw")})
group by trip_id having count(*) > 1"""

# ---- figures ------------------------------------------------------------------------------------

SQL["kpis"] = rounded(f"""
select (select count(*) from ({fleet.FCT_TRIPS})) as trip_rows,
  (select sum(total_distance_km) from ({fleet.FCT_TRIPS})) as trip_distance_km,
  (select count(*) from ({shipments.FCT_SHIPMENTS})) as shipment_rows,
  (select avg(sla_met_flag) * 1e2 from ({shipments.FCT_SHIPMENTS})) as sla_met_rate,
  (select count(*) from ({delivery.FCT_AGENTS})) as agent_daily_rows,
  (select avg(is_productive_flag) * 1e2 from ({delivery.FCT_AGENTS})) as productive_agent_rate
""", "trip_distance_km sla_met_rate productive_agent_rate")

SQL["overview_counts"] = rounded(f"""
select * from (select count(*) as gps_points, count(distinct vehicle_id) as vehicles,
    count(distinct driver_id) as drivers, avg(speed_kmh) as avg_speed_kmh
  from ({vehicle_positions("raw")})),
 (select count(*) as shipment_events, count(distinct shipment_id) as shipments,
    count(distinct hub_id) as hubs from ({SHIPMENT_EVENTS})),
 (select count(*) as delivery_events, count(distinct agent_id) as agents,
    count(*) filter (event_type = 'DELIVERED') as delivered, avg(customer_rating) as avg_rating
  from ({DELIVERY_EVENTS}))""", "avg_speed_kmh avg_rating")

SQL["value_counts"] = f"""
select event_type, count(*) as "count" from ({SHIPMENT_EVENTS}) group by event_type"""
SQL["outcome_counts"] = f"""
select journey_outcome, count(*) as "count" from ({shipments._JOURNEYS}) group by all"""
SQL["rating_counts"] = f"""
select customer_rating, count(*) as "count" from ({DELIVERY_EVENTS})
where customer_rating is not null group by all"""
SQL["vehicles_by_type"] = f"""
select vehicle_type, count(distinct vehicle_id) as vehicles
from ({vehicle_positions("raw")}) group by all"""
SQL["hub_activity"] = f"""
select hub_name, count(event_id) as event_count, count(distinct shipment_id) as unique_shipments
from ({SHIPMENT_EVENTS}) group by all"""
SQL["zone_stats"] = f"""
select zone_id, count(event_id) as deliveries, {half_up("avg(customer_rating)", 2)} as avg_rating
from ({DELIVERY_EVENTS}) group by all"""
SQL["sla_compliance"] = rounded(f"""
select count(*) filter (sla_status = 'MET') as met, count(*) as decided,
  count(*) filter (sla_status = 'MET') * 1e2 / count(*) as sla_compliance_pct
from ({shipments._JOURNEYS}) where sla_status in ('MET', 'BREACHED')""", "sla_compliance_pct")
SQL["trip_summary"] = rounded(f"""
select count(*) as total_trips, avg(total_distance_km) as avg_distance_km,
  avg(trip_duration_minutes) as avg_duration_minutes, avg(avg_speed_kmh) as avg_speed_kmh
from ({_TRIPS})""", "avg_distance_km avg_duration_minutes avg_speed_kmh")
SQL["delivery_success_rate"] = rounded(f"""
select count(*) as total, count(*) filter (event_type = 'DELIVERED') as delivered,
  count(*) filter (event_type = 'DELIVERED') * 1e2 / count(*) as success_rate_pct
from ({DELIVERY_EVENTS})""", "success_rate_pct")


def _histogram(source: str, column: str, bins: int) -> str:
    return rounded(f"""
with v as (select cast({column} as double) as v from ({source}) where {column} is not null),
r as (select min(v) as lo, max(v) as hi, (max(v) - min(v)) / {bins}e0 as w from v),
c as (select least(cast(floor((v - lo) / w) as integer), {bins - 1}) as bin, count(*) as n
  from v, r group by all)
select cast(g.bin as integer) as bin, lo + g.bin * w as bin_start, lo + (g.bin + 1) * w
  as bin_end, coalesce(n, 0) as "count"
from (select unnest(range({bins})) as bin) g cross join r left join c on c.bin = g.bin""",
                   "bin_start bin_end")


SQL["speed_histogram"] = _histogram(vehicle_positions("raw"), "speed_kmh", 40)
SQL["distance_histogram"] = _histogram(_TRIPS, "total_distance_km", 30)
SQL["rating_histogram"] = _histogram(DELIVERY_EVENTS, "customer_rating", 5)
SQL["speed_quartiles"] = rounded(f"""
select vehicle_type, count(speed_kmh) as "count", min(speed_kmh) as min,
  quantile_cont(speed_kmh, 0.25) as p25, quantile_cont(speed_kmh, 0.5) as p50,
  quantile_cont(speed_kmh, 0.75) as p75, max(speed_kmh) as max
from ({vehicle_positions("raw")}) group by all""", "min p25 p50 p75 max")

SQL["inventory"] = f"""
select 'Bronze' as layer, 'vehicle_positions' as dataset, count(*) as rows, 17 as column_count,
  'Ready' as status from ({vehicle_positions("raw")})
union all select 'Bronze', 'shipment_events', count(*), 26, 'Ready' from ({SHIPMENT_EVENTS})
union all select 'Bronze', 'delivery_events', count(*), 23, 'Ready' from ({DELIVERY_EVENTS})
union all select 'Silver', 'trips', count(*), 28, 'Ready' from ({_TRIPS})
union all select 'Silver', 'zone_performance', 0, 0, 'Missing'"""

SQL["compact_numbers"] = """
select user_id, events, total, case
    when total >= 1000000 then format('{:.1f}M', total / 1e6)
    when total >= 1000 then format('{:.1f}K', total / 1e3)
    when total = floor(total) then format('{:,}', cast(total as bigint))
    else format('{:,.1f}', total) end as label
from (select user_id, count(*) as events, cast(round(sum(cast(value as decimal(38,10))), 2)
        as double) as total from events group by user_id)"""

SQL["vehicle_drilldown"] = rounded(f"""
select event_id, vehicle_id, event_timestamp, speed_kmh, state
from ({vehicle_positions("raw")}) where vehicle_id = 'VEH_00007'""", "speed_kmh")

SQL["sample_positions"] = rounded(f"""
select event_id, vehicle_id, latitude, longitude, speed_kmh
from ({vehicle_positions("raw")}) order by md5(event_id || ':42'), event_id limit 2000""",
    "latitude longitude speed_kmh")
