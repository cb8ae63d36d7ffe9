"""The event feeds in DuckDB SQL, written apart from the Spark adapters."""

from __future__ import annotations

from routeline.contracts import FAILURE_REASONS, HUBS


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in values) + "]"


def _pad(number: str, width: int) -> str:
    text = f"cast({number} as varchar)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as integer), '0')"


_BASE = 1704067200000000


def vehicle_positions(clock: str = "dense", dirty: bool = False) -> str:
    ts = f"make_timestamp({_BASE} + (epoch_us(ts) - {_BASE}) // 30)" if clock == "dense" else "ts"
    lat = "10 + (user_id * 37 % 1500) / 1e2 + (event_id * 7919 % 1000) / 5e4"
    if dirty:
        lat = (f"case when event_id % 97 = 0 then cast(null as double) "
               f"when user_id % 29 = 0 then 51.5e0 else {lat} end")
    vehicle = f"'VEH_' || {_pad('user_id', 5)}"
    return f"""
    select cast(event_id as varchar) as event_id, {vehicle} as vehicle_id,
      'DRV_' || {_pad('user_id % 60', 5)} as driver_id,
      (['TRUCK', 'VAN', 'BIKE'])[user_id % 3 + 1] as vehicle_type,
      {lat} as latitude,
      70 + (user_id * 53 % 2000) / 1e2 + (event_id * 104729 % 1000) / 5e4 as longitude,
      case event_type when 'click' then value when 'view' then value
        when 'purchase' then value / 4e0 else 0e0 end as speed_kmh,
      cast(event_id * 13 % 360 as double) as heading,
      cast(event_id % 900 as integer) as altitude_m, 3e0 + (event_id % 50) / 1e1 as accuracy_m,
      {vehicle} || '_T' || cast(extract(day from ts) as varchar) as trip_id,
      case event_type when 'signup' then 'IDLE' when 'error' then 'STOPPED'
        else 'MOVING' end as state,
      9e1 - (event_id % 700) / 1e1 as fuel_level_pct, event_id * 5e-1 as odometer_km,
      {ts} as event_timestamp, cast({ts} as date) as event_date
    from events"""


VEHICLE_TELEMETRY = f"""
    select cast(event_id as varchar) as event_id, 'VEH_' || {_pad('user_id', 5)} as vehicle_id,
      cast(600 + event_id * 31 % 5200 as integer) as engine_rpm,
      cast(50 + event_id % 60 as double) as engine_temp_c,
      9e1 - (event_id % 700) / 1e1 as fuel_level_pct,
      115e-1 + (event_id % 40) / 1e1 as battery_voltage, event_id * 5e-1 as odometer_km,
      event_id * 25e-2 as engine_hours, cast(15 + event_id % 75 as double) as oil_pressure_psi,
      cast(70 + event_id % 40 as double) as coolant_temp_c,
      ts as event_timestamp, cast(ts as date) as event_date
    from events"""

ALERTS = f"""
    select cast(event_id as varchar) as event_id, kind as event_type,
      case when value > 200 then 'CRITICAL' when value > 100 then 'HIGH'
        when value > 40 then 'WARNING' else 'INFO' end as severity,
      'VEH_' || {_pad('user_id', 5)} as vehicle_id,
      'DRV_' || {_pad('user_id % 60', 5)} as driver_id,
      10 + (user_id * 37 % 1500) / 1e2 as latitude, 70 + (user_id * 53 % 2000) / 1e2 as longitude,
      value as speed, 8e1 as speed_limit,
      case when kind = 'SPEEDING' then value - 8e1 end as overspeed_by,
      case when kind = 'HARSH_BRAKING' then value / 1e1 end as deceleration_ms2,
      case when kind = 'HARSH_ACCELERATION' then value / 1e1 end as acceleration_ms2,
      ts as event_timestamp, cast(ts as date) as event_date
    from (select *, case when event_type = 'click' and value > 80 then 'SPEEDING'
            when event_type = 'error' then 'HARSH_BRAKING'
            when event_type = 'signup' then 'HARSH_ACCELERATION' end as kind from events)
    where kind is not null"""

_IDS = sql_list([h[0] for h in HUBS])
_SCAN_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_REASONS = sql_list(FAILURE_REASONS)

SHIPMENT_EVENTS = f"""
    select {_SCAN_ID} as event_id, 'SHP_' || {_pad('l_orderkey', 8)} as shipment_id,
      'AWB' || {_pad('l_orderkey', 10)} as awb_number,
      case when l_returnflag = 'R' and l_linenumber >= 3 then 'DELIVERY_FAILED'
        when l_returnflag = 'A' and l_linestatus = 'F' then 'DELIVERED'
        else (['CREATED', 'PICKED_UP', 'HUB_ARRIVED', 'HUB_INSCAN', 'HUB_SORTED', 'HUB_OUTSCAN',
               'HUB_DEPARTED'])[(l_linenumber - 1) % 7 + 1] end as event_type,
      ({_IDS})[l_suppkey % 10 + 1] as hub_id,
      ({sql_list([h[1] for h in HUBS])})[l_suppkey % 10 + 1] as hub_name,
      ({sql_list([h[2] for h in HUBS])})[l_suppkey % 10 + 1] as hub_city,
      cast(({sql_list([h[4] for h in HUBS])})[l_suppkey % 10 + 1] as double) as latitude,
      cast(({sql_list([h[5] for h in HUBS])})[l_suppkey % 10 + 1] as double) as longitude,
      'SEL_' || cast(o_custkey % 75 as varchar) as seller_id,
      'CUS_' || cast(o_custkey as varchar) as customer_id,
      ({_IDS})[o_custkey % 10 + 1] as origin_hub,
      ({_IDS})[(o_custkey // 10) % 10 + 1] as destination_hub,
      5e-1 + l_partkey % 40 / 4e0 as weight_kg,
      o_orderpriority = '1-URGENT' as is_cod,
      case when o_orderpriority = '1-URGENT' then o_totalprice else 0e0 end as cod_amount,
      o_orderdate + to_hours(168) as promised_delivery_at,
      cast(2 + l_orderkey % 3 as integer) as route_hops,
      cast(l_linenumber as integer) as current_hop,
      cast(l_linenumber % 4 as integer) as delivery_attempts,
      case when l_returnflag = 'R' and l_linenumber >= 3
        then ({_REASONS})[l_partkey % 7 + 1] end as failure_reason,
      'SCN_' || cast(l_suppkey % 20 as varchar) as scanner_id,
      'WRK_' || cast(l_partkey % 50 as varchar) as worker_id,
      o_orderdate + to_hours(cast((l_linenumber * 24 + l_partkey * 7 + l_suppkey * 13) % 240
        as bigint)) as event_timestamp,
      cast(o_orderdate + to_hours(cast((l_linenumber * 24 + l_partkey * 7 + l_suppkey * 13) % 240
        as bigint)) as date) as event_date
    from lineitem join orders on l_orderkey = o_orderkey"""

_AGENT_TS = ("date_trunc('month', l_shipdate) + "
             "to_hours(cast((l_partkey * 7 + l_linenumber) % 24 as bigint))")

DELIVERY_EVENTS = f"""
    select {_SCAN_ID} as event_id,
      case l_returnflag when 'N' then 'DELIVERED' when 'A' then 'DELIVERY_ATTEMPTED'
        else 'DELIVERY_FAILED' end as event_type,
      'AGT_' || {_pad('l_suppkey % 10', 4)} as agent_id,
      'Agent ' || {_pad('l_suppkey % 10', 4)} as agent_name,
      'ORD_' || cast(l_orderkey as varchar) as order_id,
      'SHP_' || {_pad('l_orderkey', 8)} as shipment_id,
      'CUS_' || cast(l_orderkey % 1500 as varchar) as customer_id,
      10 + l_suppkey % 20 + (l_partkey % 100) / 1e3 as delivery_lat,
      70 + l_suppkey % 20 + (l_partkey % 100) / 1e3 as delivery_lng,
      'Street ' || cast(l_partkey % 200 as varchar) as delivery_address,
      'ZONE_' || cast(l_suppkey % 10 % 4 as varchar) as zone_id,
      l_linestatus = 'O' as is_cod,
      case when l_linestatus = 'O' then l_extendedprice else 0e0 end as cod_amount,
      case when l_linestatus = 'O' and l_returnflag = 'N' then l_extendedprice
        else 0e0 end as cod_collected,
      case when l_linestatus = 'O' then 'CASH' else 'PREPAID' end as payment_mode,
      cast(1 + l_linenumber % 3 as integer) as attempt_number,
      case when l_returnflag <> 'N' then ({_REASONS})[l_partkey % 7 + 1] end as failure_reason,
      case when l_returnflag = 'N' then 'OTP' end as pod_type,
      case when l_returnflag = 'N' and l_linenumber % 2 = 0
        then cast(1 + l_partkey % 5 as integer) end as customer_rating,
      cast(60 + l_partkey % 660 as integer) as time_at_location_seconds,
      {_AGENT_TS} as event_timestamp, cast({_AGENT_TS} as date) as event_date
    from lineitem"""

AGENT_POSITIONS = f"""
    select {_SCAN_ID} as event_id, 'AGT_' || {_pad('l_suppkey % 10', 4)} as agent_id,
      10 + l_suppkey % 20 + (l_partkey % 100) / 1e3 as latitude,
      70 + l_suppkey % 20 + (l_partkey % 100) / 1e3 as longitude,
      (l_partkey % 300) / 1e1 as speed_kmh, cast(l_partkey % 360 as double) as heading,
      4e0 + l_partkey % 20 / 4e0 as accuracy_m,
      'ZONE_' || cast(l_suppkey % 10 % 4 as varchar) as zone_id,
      (['BIKE', 'SCOOTER', 'BICYCLE'])[l_suppkey % 10 % 3 + 1] as vehicle_type,
      (['AVAILABLE', 'ON_DELIVERY', 'BREAK', 'OFFLINE'])[l_linenumber % 4 + 1] as status,
      l_linenumber % 3 = 0 as is_at_stop,
      'ORD_' || cast(l_orderkey as varchar) as current_order_id,
      cast(l_linenumber as integer) as pending_orders,
      cast(l_linenumber * 2 as integer) as completed_today,
      cast(l_linenumber % 2 as integer) as failed_today,
      cast(20 + l_partkey % 80 as integer) as battery_pct,
      {_AGENT_TS} as event_timestamp, cast({_AGENT_TS} as date) as event_date
    from lineitem"""

DIM_HUBS = "select * from (values " + ", ".join(
    f"('{h[0]}', '{h[1]}', '{h[2]}', '{h[3]}', {h[4]!r}::double, {h[5]!r}::double, '{h[6]}', "
    f"{h[7]}, true)" for h in HUBS) + (
    ") t(hub_id, hub_name, city, region, latitude, longitude, hub_type, capacity_daily, "
    "is_active)")

GEOFENCES = f"""
    select 'GF_' || {_pad('s_suppkey', 5)} as geofence_id,
      (['HUB', 'CITY', 'TOLL', 'CUSTOMER'])[s_suppkey % 4 + 1] as geofence_type,
      1001e-2 + (s_suppkey * 37 % 1500) / 1e2 as center_lat,
      7001e-2 + (s_suppkey * 53 % 2000) / 1e2 as center_lng, 8e-1 as radius_km
    from supplier"""


def hours_between(a: str, b: str, micros: str = "3.6e9") -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / {micros})"


def minutes_between(a: str, b: str) -> str:
    return hours_between(a, b, "6e7")


def seconds_between(a: str, b: str) -> str:
    return hours_between(a, b, "1e6")


def haversine(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    h = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))")
    return f"(6371e0 * 2 * asin(sqrt(case when {h} > 1 then 1e0 else {h} end)))"


def flat_km(lat1: str, lng1: str, lat2: str, lng2: str, at: str) -> str:
    return (f"(111e0 * sqrt(pow({lat2} - {lat1}, 2) + "
            f"pow(({lng2} - {lng1}) * cos(radians({at})), 2)))")


def key(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '__dbt_null__')" for c in cols)
    return f"md5(concat_ws('||', {parts}))"


def half_up(value: str, digits: int) -> str:
    """Decimal rounding, free of binary representation noise."""
    return f"cast(round(cast({value} as decimal(38,10)), {digits}) as double)"


def rounded(sql: str, columns: str, digits: int = 6) -> str:
    """Round the listed columns of a query, leaving order and names as they are."""
    items = ", ".join(f"{half_up(c, digits)} as {c}" for c in columns.split())
    return f"select * replace ({items}) from ({sql})"
