"""Event contracts, enumerations and thresholds shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- Fixed values: topic contracts (column name and type, in payload order) -----------------
CONTRACTS: dict[str, str] = {
    "vehicle_positions": (
        "event_id string, vehicle_id string, driver_id string, vehicle_type string, "
        "timestamp string, latitude double, longitude double, speed_kmh double, heading double, "
        "altitude_m int, accuracy_m double, trip_id string, state string, "
        "fuel_level_pct double, odometer_km double"
    ),
    "vehicle_telemetry": (
        "event_id string, vehicle_id string, timestamp string, engine_rpm int, "
        "engine_temp_c double, fuel_level_pct double, battery_voltage double, "
        "odometer_km double, engine_hours double, oil_pressure_psi double, coolant_temp_c double"
    ),
    "shipment_events": (
        "event_id string, shipment_id string, awb_number string, timestamp string, "
        "event_type string, hub_id string, hub_name string, hub_city string, latitude double, "
        "longitude double, seller_id string, customer_id string, origin_hub string, "
        "destination_hub string, weight_kg double, is_cod boolean, cod_amount double, "
        "promised_delivery string, route_hops int, current_hop int, delivery_attempts int, "
        "failure_reason string, scanner_id string, worker_id string"
    ),
    "agent_positions": (
        "event_id string, agent_id string, timestamp string, latitude double, longitude double, "
        "speed_kmh double, heading double, accuracy_m double, zone_id string, "
        "vehicle_type string, status string, is_at_stop boolean, current_order_id string, "
        "pending_orders int, completed_today int, failed_today int, battery_pct int"
    ),
    "delivery_events": (
        "event_id string, event_type string, timestamp string, agent_id string, "
        "agent_name string, order_id string, shipment_id string, customer_id string, "
        "delivery_lat double, delivery_lng double, delivery_address string, zone_id string, "
        "is_cod boolean, cod_amount double, cod_collected double, payment_mode string, "
        "attempt_number int, failure_reason string, pod_type string, customer_rating int, "
        "time_at_location_seconds int"
    ),
    "alerts": (
        "event_id string, event_type string, severity string, timestamp string, "
        "vehicle_id string, driver_id string, latitude double, longitude double, speed double, "
        "speed_limit double, overspeed_by double, deceleration_ms2 double, "
        "acceleration_ms2 double"
    ),
}

# ---- Fixed values: enumerations ---------------------------------------------------------------
SHIPMENT_EVENT_TYPES = (
    "CREATED", "PICKUP_SCHEDULED", "PICKED_UP", "HUB_ARRIVED", "HUB_INSCAN", "HUB_SORTED",
    "HUB_OUTSCAN", "HUB_DEPARTED", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERY_ATTEMPTED",
    "DELIVERED", "DELIVERY_FAILED", "RETURNED_TO_ORIGIN", "LOST", "DAMAGED",
)
FIRST_MILE_EVENTS = ("CREATED", "PICKUP_SCHEDULED", "PICKED_UP")
MID_MILE_EVENTS = (
    "HUB_ARRIVED", "HUB_INSCAN", "HUB_SORTED", "HUB_OUTSCAN", "HUB_DEPARTED", "IN_TRANSIT",
)
LAST_MILE_EVENTS = ("OUT_FOR_DELIVERY", "DELIVERY_ATTEMPTED", "DELIVERED", "DELIVERY_FAILED")
EXCEPTION_EVENTS = ("RETURNED_TO_ORIGIN", "LOST", "DAMAGED")
DELIVERY_EVENT_TYPES = ("DELIVERED", "DELIVERY_ATTEMPTED", "DELIVERY_FAILED")
FAILURE_REASONS = (
    "CUSTOMER_NOT_AVAILABLE", "WRONG_ADDRESS", "ACCESS_RESTRICTED", "CUSTOMER_REFUSED",
    "PAYMENT_ISSUE", "DAMAGED_PACKAGE", "OTHER",
)
VEHICLE_STATES = ("IDLE", "MOVING", "STOPPED")
AGENT_STATUSES = ("AVAILABLE", "ON_DELIVERY", "BREAK", "OFFLINE")
ALERT_TYPES = ("SPEEDING", "HARSH_BRAKING", "HARSH_ACCELERATION")
SEVERITIES = ("INFO", "WARNING", "HIGH", "CRITICAL")
ALERT_CHANNELS = {
    "CRITICAL": ("slack", "sms"),
    "HIGH": ("slack",),
    "WARNING": ("slack",),
    "INFO": (),
}

# ---- Fixed values: hub master rows ------------------------------------------------------------
HUBS = (
    ("HUB_DEL_01", "Delhi Hub", "Delhi", "North", 28.5505, 77.2506, "MEGA", 500, True),
    ("HUB_MUM_01", "Mumbai Hub", "Mumbai", "West", 19.0330, 72.8520, "MEGA", 450, True),
    ("HUB_BLR_01", "Bangalore Hub", "Bangalore", "South", 13.0100, 77.5500, "MEGA", 400, True),
    ("HUB_CHN_01", "Chennai Hub", "Chennai", "South", 13.0600, 80.2100, "MEGA", 350, True),
    ("HUB_HYD_01", "Hyderabad Hub", "Hyderabad", "South", 17.4400, 78.3800, "MEGA", 380, True),
    ("HUB_KOL_01", "Kolkata Hub", "Kolkata", "East", 22.5726, 88.3639, "MEGA", 320, True),
    ("HUB_PUN_01", "Pune Hub", "Pune", "West", 18.5204, 73.8567, "REGIONAL", 200, True),
    ("HUB_AMD_01", "Ahmedabad Hub", "Ahmedabad", "West", 23.0225, 72.5714, "REGIONAL", 180, True),
    ("HUB_JAI_01", "Jaipur Hub", "Jaipur", "North", 26.9124, 75.7873, "REGIONAL", 150, True),
    ("HUB_LKO_01", "Lucknow Hub", "Lucknow", "North", 26.8467, 80.9462, "REGIONAL", 140, True),
)
HUB_SCHEMA = (
    "hub_id string, hub_name string, city string, region string, latitude double, "
    "longitude double, hub_type string, capacity_daily int, is_active boolean"
)


@dataclass(frozen=True)
class Bounds:
    """Inclusive service-area box."""

    lat_min: float = 8.0
    lat_max: float = 37.0
    lng_min: float = 68.0
    lng_max: float = 97.5


@dataclass(frozen=True)
class Thresholds:
    """Default limits of the detection rules."""

    trip_gap_minutes: int = 30
    min_trip_minutes: int = 5
    min_trip_positions: int = 5
    min_trip_km: float = 0.1
    max_speed_kmh: float = 200.0
    speeding_kmh: float = 80.0
    idle_minutes: int = 5
    stuck_hours: int = 24
    sla_risk_hours: int = 12
    bottleneck_hours: int = 12
    stop_speed_kmh: float = 2.0
    stop_seconds: int = 60
    proximity_m: float = 50.0


BOUNDS = Bounds()
LIMITS = Thresholds()


def contract(topic: str) -> T.StructType:
    """The declared payload schema of a topic."""
    return T.StructType.fromDDL(CONTRACTS[topic])
