"""Event feeds over the given star-schema tables.

Each feed maps whole tables to one event contract, deterministically and without shuffles beyond
the orders join. They work on static and on streaming input (``table`` decides which).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routeline import contracts as C
from routeline.functions.values import padded

BASE_MICROS = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
COMPRESSION = 30                     # thirty days of raw events fit into one

Table = Callable[[SparkSession, str, str], DataFrame]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A given table, in the splits its files give it."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def stream_table(spark: SparkSession, root: str, name: str, **options: str) -> DataFrame:
    """The same table as an unbounded input; the schema is taken from its files."""
    schema = spark.read.parquet(f"{root}/{name}.parquet").schema
    return spark.readStream.schema(schema).options(**options).parquet(f"{root}/{name}*.parquet")


def _pick(values, index: Column) -> Column:
    """The value at a 0-based position of a fixed list."""
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}D" for v in values)
    return F.element_at(F.expr(f"array({listed})"), (index + 1).cast("int"))


def _plus_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + hours.cast("long") * 3_600_000_000)


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _vehicle(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), padded(number, 5))


def _raw_time() -> Column:
    return F.col("ts").cast("timestamp")


def _dense_time() -> Column:
    """Raw time squeezed towards the base instant, so that the gap rules bite."""
    return F.timestamp_micros(
        F.lit(BASE_MICROS) + F.expr(f"(unix_micros(cast(ts as timestamp)) - {BASE_MICROS}L) "
                                    f"div {COMPRESSION}"))


def vehicle_positions(spark: SparkSession, root: str, clock: str = "dense", dirty: bool = False,
                      table: Table = read_table) -> DataFrame:
    """GPS points. ``clock`` is dense (one day) or raw (thirty days); ``dirty`` adds points off
    the service area and points without a latitude."""
    e = table(spark, root, "events")
    user, eid, kind, value = (F.col(c) for c in ("user_id", "event_id", "event_type", "value"))
    ts = _dense_time() if clock == "dense" else _raw_time()
    lat = 10 + (user * 37 % 1500) / 100.0 + (eid * 7919 % 1000) / 50000.0
    lng = 70 + (user * 53 % 2000) / 100.0 + (eid * 104729 % 1000) / 50000.0
    if dirty:
        lat = F.when(eid % 97 == 0, F.lit(None).cast("double")) \
            .when(user % 29 == 0, F.lit(51.5)).otherwise(lat)
    vehicle = _vehicle("VEH_", user)
    return e.select(
        eid.cast("string").alias("event_id"),
        vehicle.alias("vehicle_id"),
        _vehicle("DRV_", user % 60).alias("driver_id"),
        _pick(("TRUCK", "VAN", "BIKE"), user % 3).alias("vehicle_type"),
        _iso(ts).alias("timestamp"),
        lat.alias("latitude"), lng.alias("longitude"),
        F.when(kind.isin("click", "view"), value).when(kind == "purchase", value / 4.0)
        .otherwise(F.lit(0.0)).alias("speed_kmh"),
        (eid * 13 % 360).cast("double").alias("heading"),
        (eid % 900).cast("int").alias("altitude_m"),
        (3.0 + (eid % 50) / 10.0).alias("accuracy_m"),
        F.concat(vehicle, F.lit("_T"), F.dayofmonth("ts").cast("string")).alias("trip_id"),
        F.when(kind == "signup", "IDLE").when(kind == "error", "STOPPED")
        .otherwise("MOVING").alias("state"),
        (90.0 - (eid % 700) / 10.0).alias("fuel_level_pct"),
        (eid * 0.5).alias("odometer_km"),
        ts.alias("event_timestamp"),
        F.to_date(ts).alias("event_date"),
    )


def vehicle_telemetry(spark: SparkSession, root: str, table: Table = read_table) -> DataFrame:
    eid, ts = F.col("event_id"), _raw_time()
    return table(spark, root, "events").select(
        eid.cast("string").alias("event_id"),
        _vehicle("VEH_", F.col("user_id")).alias("vehicle_id"),
        _iso(ts).alias("timestamp"),
        (600 + eid * 31 % 5200).cast("int").alias("engine_rpm"),
        (50 + eid % 60).cast("double").alias("engine_temp_c"),
        (90.0 - (eid % 700) / 10.0).alias("fuel_level_pct"),
        (11.5 + (eid % 40) / 10.0).alias("battery_voltage"),
        (eid * 0.5).alias("odometer_km"),
        (eid * 0.25).alias("engine_hours"),
        (15 + eid % 75).cast("double").alias("oil_pressure_psi"),
        (70 + eid % 40).cast("double").alias("coolant_temp_c"),
        ts.alias("event_timestamp"), F.to_date(ts).alias("event_date"),
    )


def alerts(spark: SparkSession, root: str, table: Table = read_table) -> DataFrame:
    eid, user, value, kind = (F.col(c) for c in ("event_id", "user_id", "value", "event_type"))
    ts = _raw_time()
    alert = F.when((kind == "click") & (value > 80), "SPEEDING") \
        .when(kind == "error", "HARSH_BRAKING").when(kind == "signup", "HARSH_ACCELERATION")
    none = F.lit(None).cast("double")
    return table(spark, root, "events").withColumn("_alert", alert) \
        .filter(F.col("_alert").isNotNull()).select(
        eid.cast("string").alias("event_id"),
        F.col("_alert").alias("event_type"),
        F.when(value > 200, "CRITICAL").when(value > 100, "HIGH").when(value > 40, "WARNING")
        .otherwise("INFO").alias("severity"),
        _iso(ts).alias("timestamp"),
        _vehicle("VEH_", user).alias("vehicle_id"),
        _vehicle("DRV_", user % 60).alias("driver_id"),
        (10 + (user * 37 % 1500) / 100.0).alias("latitude"),
        (70 + (user * 53 % 2000) / 100.0).alias("longitude"),
        value.alias("speed"), F.lit(80.0).alias("speed_limit"),
        F.when(F.col("_alert") == "SPEEDING", value - 80.0).otherwise(none)
        .alias("overspeed_by"),
        F.when(F.col("_alert") == "HARSH_BRAKING", value / 10.0).otherwise(none)
        .alias("deceleration_ms2"),
        F.when(F.col("_alert") == "HARSH_ACCELERATION", value / 10.0).otherwise(none)
        .alias("acceleration_ms2"),
        ts.alias("event_timestamp"), F.to_date(ts).alias("event_date"),
    )


def _scan_id() -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def shipment_events(spark: SparkSession, root: str, table: Table = read_table,
                    orders: DataFrame | None = None) -> DataFrame:
    """Parcel scans: one per order line, the order supplying the shipment attributes."""
    line = table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    head = (orders if orders is not None else read_table(spark, root, "orders")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    number, part, supp, cust = (F.col(c) for c in
                                ("l_linenumber", "l_partkey", "l_suppkey", "o_custkey"))
    placed = F.col("o_orderdate").cast("timestamp")
    ts = _plus_hours(placed, (number * 24 + part * 7 + supp * 13) % 240)
    failed = (F.col("l_returnflag") == "R") & (number >= 3)
    delivered = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
    kind = F.when(failed, "DELIVERY_FAILED").when(delivered, "DELIVERED").otherwise(
        _pick(("CREATED", "PICKED_UP", "HUB_ARRIVED", "HUB_INSCAN", "HUB_SORTED", "HUB_OUTSCAN",
               "HUB_DEPARTED"), (number - 1) % 7))
    hub = supp % 10
    is_cod = F.col("o_orderpriority") == "1-URGENT"
    hub_ids = [h[0] for h in C.HUBS]
    return line.join(head, line.l_orderkey == head.o_orderkey).select(
        _scan_id().alias("event_id"),
        F.concat(F.lit("SHP_"), padded(F.col("l_orderkey"), 8)).alias("shipment_id"),
        F.concat(F.lit("AWB"), padded(F.col("l_orderkey"), 10)).alias("awb_number"),
        _iso(ts).alias("timestamp"),
        kind.alias("event_type"),
        _pick(hub_ids, hub).alias("hub_id"),
        _pick([h[1] for h in C.HUBS], hub).alias("hub_name"),
        _pick([h[2] for h in C.HUBS], hub).alias("hub_city"),
        _pick([h[4] for h in C.HUBS], hub).alias("latitude"),
        _pick([h[5] for h in C.HUBS], hub).alias("longitude"),
        F.concat(F.lit("SEL_"), (cust % 75).cast("string")).alias("seller_id"),
        F.concat(F.lit("CUS_"), cust.cast("string")).alias("customer_id"),
        _pick(hub_ids, cust % 10).alias("origin_hub"),
        _pick(hub_ids, F.floor(cust / 10) % 10).alias("destination_hub"),
        (0.5 + part % 40 / 4.0).alias("weight_kg"),
        is_cod.alias("is_cod"),
        F.when(is_cod, F.col("o_totalprice")).otherwise(F.lit(0.0)).alias("cod_amount"),
        _iso(_plus_hours(placed, F.lit(168))).alias("promised_delivery"),
        (2 + F.col("l_orderkey") % 3).cast("int").alias("route_hops"),
        number.cast("int").alias("current_hop"),
        (number % 4).cast("int").alias("delivery_attempts"),
        F.when(failed, _pick(C.FAILURE_REASONS, part % 7)).alias("failure_reason"),
        F.concat(F.lit("SCN_"), (supp % 20).cast("string")).alias("scanner_id"),
        F.concat(F.lit("WRK_"), (part % 50).cast("string")).alias("worker_id"),
        ts.alias("event_timestamp"), F.to_date(ts).alias("event_date"),
    )


def _agent(spec: str = "AGT_") -> Column:
    return F.concat(F.lit(spec), padded(F.col("l_suppkey") % 10, 4))


def _zone() -> Column:
    return F.concat(F.lit("ZONE_"), (F.col("l_suppkey") % 10 % 4).cast("string"))


def _agent_time() -> Column:
    month = F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))
    return _plus_hours(month, (F.col("l_partkey") * 7 + F.col("l_linenumber")) % 24)


def _agent_lat() -> Column:
    return 10 + F.col("l_suppkey") % 20 + (F.col("l_partkey") % 100) / 1000.0


def _agent_lng() -> Column:
    return 70 + F.col("l_suppkey") % 20 + (F.col("l_partkey") % 100) / 1000.0


def delivery_events(spark: SparkSession, root: str, table: Table = read_table) -> DataFrame:
    number, part = F.col("l_linenumber"), F.col("l_partkey")
    kind = F.when(F.col("l_returnflag") == "N", "DELIVERED") \
        .when(F.col("l_returnflag") == "A", "DELIVERY_ATTEMPTED").otherwise("DELIVERY_FAILED")
    delivered = F.col("l_returnflag") == "N"
    is_cod = F.col("l_linestatus") == "O"
    cod = F.when(is_cod, F.col("l_extendedprice")).otherwise(F.lit(0.0))
    ts = _agent_time()
    return table(spark, root, "lineitem").select(
        _scan_id().alias("event_id"), kind.alias("event_type"), _iso(ts).alias("timestamp"),
        _agent().alias("agent_id"), _agent("Agent ").alias("agent_name"),
        F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("SHP_"), padded(F.col("l_orderkey"), 8)).alias("shipment_id"),
        F.concat(F.lit("CUS_"), (F.col("l_orderkey") % 1500).cast("string"))
        .alias("customer_id"),
        _agent_lat().alias("delivery_lat"), _agent_lng().alias("delivery_lng"),
        F.concat(F.lit("Street "), (part % 200).cast("string")).alias("delivery_address"),
        _zone().alias("zone_id"), is_cod.alias("is_cod"), cod.alias("cod_amount"),
        F.when(delivered, cod).otherwise(F.lit(0.0)).alias("cod_collected"),
        F.when(is_cod, "CASH").otherwise("PREPAID").alias("payment_mode"),
        (1 + number % 3).cast("int").alias("attempt_number"),
        F.when(~delivered, _pick(C.FAILURE_REASONS, part % 7)).alias("failure_reason"),
        F.when(delivered, "OTP").alias("pod_type"),
        F.when(delivered & (number % 2 == 0), 1 + part % 5).cast("int").alias("customer_rating"),
        (60 + part % 660).cast("int").alias("time_at_location_seconds"),
        ts.alias("event_timestamp"), F.to_date(ts).alias("event_date"),
    )


def agent_positions(spark: SparkSession, root: str, table: Table = read_table) -> DataFrame:
    number, part = F.col("l_linenumber"), F.col("l_partkey")
    ts = _agent_time()
    return table(spark, root, "lineitem").select(
        _scan_id().alias("event_id"), _agent().alias("agent_id"), _iso(ts).alias("timestamp"),
        _agent_lat().alias("latitude"), _agent_lng().alias("longitude"),
        ((part % 300) / 10.0).alias("speed_kmh"),
        (part % 360).cast("double").alias("heading"),
        (4.0 + part % 20 / 4.0).alias("accuracy_m"),
        _zone().alias("zone_id"),
        _pick(("BIKE", "SCOOTER", "BICYCLE"), F.col("l_suppkey") % 10 % 3).alias("vehicle_type"),
        _pick(C.AGENT_STATUSES, number % 4).alias("status"),
        (number % 3 == 0).alias("is_at_stop"),
        F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string")).alias("current_order_id"),
        number.cast("int").alias("pending_orders"),
        (number * 2).cast("int").alias("completed_today"),
        (number % 2).cast("int").alias("failed_today"),
        (20 + part % 80).cast("int").alias("battery_pct"),
        ts.alias("event_timestamp"), F.to_date(ts).alias("event_date"),
    )


def sla_definitions(spark: SparkSession, root: str) -> DataFrame:
    """Promised days per origin, destination and service, from the order book."""
    o = read_table(spark, root, "orders")
    hub_ids = [h[0] for h in C.HUBS]
    return o.select(
        _pick(hub_ids, F.col("o_custkey") % 10).alias("origin_hub"),
        _pick(hub_ids, F.floor(F.col("o_custkey") / 10) % 10).alias("destination_hub"),
        service_type(F.col("o_orderkey")).alias("service_type"),
    ).groupBy("origin_hub", "destination_hub", "service_type").agg(
        F.min(F.when(F.col("service_type") == "EXPRESS", 3).otherwise(7)).alias("promised_days"))


def service_type(orderkey: Column) -> Column:
    return F.when(orderkey % 3 == 0, "EXPRESS").otherwise("STANDARD")


def geofences(spark: SparkSession, root: str) -> DataFrame:
    """Circular fences, one per supplier."""
    key = F.col("s_suppkey")
    return read_table(spark, root, "supplier").select(
        F.concat(F.lit("GF_"), padded(key, 5)).alias("geofence_id"),
        _pick(("HUB", "CITY", "TOLL", "CUSTOMER"), key % 4).alias("geofence_type"),
        (10.01 + (key * 37 % 1500) / 100.0).alias("center_lat"),
        (70.01 + (key * 53 % 2000) / 100.0).alias("center_lng"),
        F.lit(0.8).alias("radius_km"),
    )
