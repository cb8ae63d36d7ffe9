"""The warehouse: staging views, intermediate tables and marts over the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from routeline.operators import delivery, dims, fleet, shipments, staging
from routeline.sources.sinks import materialize

STAGING = {
    "stg_vehicle_positions": ("vehicle_positions", staging.stg_vehicle_positions),
    "stg_vehicle_telemetry": ("vehicle_telemetry", staging.stg_vehicle_telemetry),
    "stg_alerts": ("alerts", staging.stg_alerts),
    "stg_shipment_events": ("shipment_events", staging.stg_shipment_events),
    "stg_agent_positions": ("agent_positions", staging.stg_agent_positions),
    "stg_delivery_events": ("delivery_events", staging.stg_delivery_events),
}
INTERMEDIATE = {
    "int_vehicle_trips": (fleet.int_vehicle_trips, ["stg_vehicle_positions"]),
    "int_driver_daily_metrics": (fleet.int_driver_daily_metrics,
                                 ["stg_vehicle_positions", "stg_alerts"]),
    "int_shipment_journeys": (shipments.int_shipment_journeys, ["stg_shipment_events"]),
    "int_hub_throughput": (shipments.int_hub_throughput, ["stg_shipment_events"]),
    "int_agent_shifts": (delivery.int_agent_shifts,
                         ["stg_agent_positions", "stg_delivery_events"]),
}
MARTS = {
    "fct_trips": (fleet.fct_trips, ["int_vehicle_trips"]),
    "fct_driver_performance": (fleet.fct_driver_performance, ["int_driver_daily_metrics"]),
    "fct_shipments": (shipments.fct_shipments, ["int_shipment_journeys", "dim_hubs"]),
    "fct_hub_daily": (shipments.fct_hub_daily, ["int_hub_throughput", "dim_hubs"]),
    "fct_agent_daily": (delivery.fct_agent_daily, ["int_agent_shifts"]),
    "fct_zone_daily": (delivery.fct_zone_daily, ["fct_agent_daily"]),
}


def build_models(spark: SparkSession, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All models whose inputs are present, as lazy frames."""
    models = {name: build(bronze[source]) for name, (source, build) in STAGING.items()
              if source in bronze}
    models["dim_hubs"] = dims.dim_hubs(spark)
    models["dim_time"] = dims.dim_time(spark)
    for name, (build, inputs) in {**INTERMEDIATE, **MARTS}.items():
        if all(i in models for i in inputs):
            models[name] = build(*[models[i] for i in inputs])
    return models


def publish(spark: SparkSession, bronze: dict[str, DataFrame], root: str,
            as_of: str | None = None) -> dict[str, DataFrame]:
    """Build and store the models: staging as views, the rest as tables. Every table is computed
    from the stored tables before it, so no intermediate result is computed twice."""
    stored = {name: materialize(name, build(bronze[source]), "view")
              for name, (source, build) in STAGING.items() if source in bronze}
    for name, df in (("dim_hubs", dims.dim_hubs(spark)), ("dim_time", dims.dim_time(spark))):
        stored[name] = materialize(name, df, "table", root, as_of)
    for name, (build, inputs) in {**INTERMEDIATE, **MARTS}.items():
        if all(i in stored for i in inputs):
            stored[name] = materialize(name, build(*[stored[i] for i in inputs]), "table", root,
                                       as_of)
    return stored
