"""Staging views: one row per bronze row, cleaned, renamed and classified."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeline.functions import clock, labels
from routeline.operators.bronze import in_service_area


def _timed(df: DataFrame) -> DataFrame:
    """Bronze rows with a typed event time, parsed from the payload text where it is missing."""
    if "event_timestamp" not in df.columns:
        df = df.withColumn("event_timestamp", F.try_to_timestamp(F.col("timestamp")))
    return df.withColumn("event_date", F.to_date("event_timestamp"))


def _located(df: DataFrame) -> DataFrame:
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def _yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _renamed(name: str, source: str) -> Column:
    return F.col(source).alias(name)


_HOUR = "hour_of_day"


def _time_features(*, weekday: bool = True) -> list[Column]:
    ts = F.col("event_timestamp")
    out = [clock.hour(ts).alias(_HOUR)]
    if weekday:
        out.append(clock.day_of_week(ts).alias("day_of_week"))
    return out


def stg_vehicle_positions(df: DataFrame) -> DataFrame:
    hour = clock.hour(F.col("event_timestamp"))
    return _located(_timed(df)).select(
        "event_id", "vehicle_id", "driver_id", "vehicle_type", "event_timestamp", "event_date",
        "latitude", "longitude",
        _renamed("altitude_meters", "altitude_m"), _renamed("accuracy_meters", "accuracy_m"),
        "speed_kmh", _renamed("heading_degrees", "heading"),
        "trip_id", _renamed("vehicle_state", "state"), "fuel_level_pct", "odometer_km",
        _yes(in_service_area(F.col("latitude"), F.col("longitude"))).alias("is_valid_location"),
        _yes(F.col("speed_kmh").between(0, 200)).alias("is_valid_speed"),
        *_time_features(),
        _yes(labels.is_peak_hour(hour)).alias("is_peak_hour"),
    )


def stg_vehicle_telemetry(df: DataFrame) -> DataFrame:
    temp, rpm = F.col("engine_temp_c"), F.col("engine_rpm")
    oil, volt = F.col("oil_pressure_psi"), F.col("battery_voltage")
    return _timed(df).select(
        "event_id", "vehicle_id", "event_timestamp", "event_date",
        "engine_rpm", _renamed("engine_temp_celsius", "engine_temp_c"), "oil_pressure_psi",
        _renamed("coolant_temp_celsius", "coolant_temp_c"), "fuel_level_pct", "battery_voltage",
        "odometer_km", "engine_hours",
        labels.first_match([(temp > 100, "OVERHEATING"),
                            ((temp < 60) & (rpm > 1000), "COLD_RUNNING")], "NORMAL")
        .alias("engine_temp_status"),
        labels.first_match([(oil < 20, "LOW"), (oil > 80, "HIGH")], "NORMAL")
        .alias("oil_pressure_status"),
        labels.first_match([(volt < 12.0, "LOW"), (volt > 14.5, "OVERCHARGING")], "NORMAL")
        .alias("battery_status"),
        _yes(rpm > 5000).alias("is_high_rpm"),
    )


def stg_alerts(df: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return _timed(df).select(
        "event_id", "vehicle_id", "driver_id", "event_timestamp", "event_date",
        _renamed("alert_type", "event_type"), "severity", "latitude", "longitude",
        _renamed("actual_speed_kmh", "speed"), _renamed("speed_limit_kmh", "speed_limit"),
        _renamed("overspeed_kmh", "overspeed_by"), "deceleration_ms2", "acceleration_ms2",
        labels.first_match(
            [(kind == "SPEEDING", "SAFETY"),
             (kind.isin("HARSH_BRAKING", "HARSH_ACCELERATION"), "DRIVING_BEHAVIOR")],
            "OTHER").alias("alert_category"),
        labels.severity_score(F.col("severity")).alias("severity_score"),
        *_time_features(weekday=False),
    )


def stg_shipment_events(df: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return _timed(df).select(
        "event_id", "shipment_id", "awb_number", "event_timestamp", "event_date", "event_type",
        "hub_id", "hub_name", "hub_city", _renamed("hub_latitude", "latitude"),
        _renamed("hub_longitude", "longitude"), "seller_id", "customer_id", "origin_hub",
        "destination_hub", "route_hops", "current_hop", "weight_kg", "is_cod", "cod_amount",
        F.try_to_timestamp(F.col("promised_delivery").cast("string"))
        .alias("promised_delivery_at"),
        "delivery_attempts", "failure_reason", "scanner_id", "worker_id",
        labels.journey_stage(kind).alias("journey_stage"),
        labels.event_category(kind).alias("event_category"),
        labels.is_terminal(kind).alias("is_terminal_event"),
        *_time_features(),
    )


def stg_agent_positions(df: DataFrame) -> DataFrame:
    speed, hour = F.col("speed_kmh"), clock.hour(F.col("event_timestamp"))
    return _located(_timed(df)).select(
        "event_id", "agent_id", "event_timestamp", "event_date", "latitude", "longitude",
        _renamed("accuracy_meters", "accuracy_m"), "speed_kmh",
        _renamed("heading_degrees", "heading"), "zone_id", "vehicle_type",
        _renamed("agent_status", "status"), "is_at_stop", "current_order_id", "pending_orders",
        _renamed("completed_deliveries", "completed_today"),
        _renamed("failed_deliveries", "failed_today"),
        _renamed("phone_battery_pct", "battery_pct"),
        _yes(in_service_area(F.col("latitude"), F.col("longitude"))).alias("is_valid_location"),
        labels.first_match([(F.col("is_at_stop"), "STOPPED"), (speed < 2, "IDLE"),
                            (speed < 10, "SLOW_MOVING")], "MOVING").alias("activity_state"),
        *_time_features(),
        _yes(hour.between(8, 21)).alias("is_working_hours"),
    )


def stg_delivery_events(df: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return _timed(df).select(
        "event_id", "agent_id", "agent_name", "order_id", "shipment_id", "event_timestamp",
        "event_date", "event_type", "customer_id", "delivery_address", "zone_id",
        _renamed("delivery_latitude", "delivery_lat"),
        _renamed("delivery_longitude", "delivery_lng"),
        "is_cod", "cod_amount", "cod_collected", "payment_mode", "attempt_number",
        "failure_reason", "pod_type", "customer_rating", "time_at_location_seconds",
        labels.first_match([(kind == "DELIVERED", "SUCCESS"),
                            (kind == "DELIVERY_FAILED", "FAILED"),
                            (kind == "DELIVERY_ATTEMPTED", "ATTEMPTED")], "OTHER")
        .alias("delivery_outcome"),
        _yes((kind == "DELIVERED") & (F.col("attempt_number") == 1))
        .alias("is_first_attempt_success"),
        labels.failure_category(F.col("failure_reason")).alias("failure_category"),
        *_time_features(),
        labels.delivery_time_slot(clock.hour(F.col("event_timestamp")))
        .alias("delivery_time_slot"),
    )
