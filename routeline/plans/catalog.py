"""The query catalogue: every operator over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeline import contracts as C
from routeline.operators import (
    alerting, bronze, delivery, dims, fleet, quality, serving, shipments, staging,
)
from routeline.functions.values import compact_number, rounded
from routeline.plans import daily
from routeline.session import scratch_path
from routeline.sources import feeds
from routeline.sources.tables import read_bronze
from routeline.streaming import detect, ingest, status

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: doubles rounded half up, instants as plain timestamps, lists as text."""
    out = []
    for field in df.schema.fields:
        c = f"`{field.name}`"
        if isinstance(field.dataType, T.DoubleType):
            c = f"cast(round(cast({c} as decimal(38,10)), {digits}) as double)"
        elif isinstance(field.dataType, T.TimestampType):
            c = f"cast({c} as timestamp_ntz)"
        elif isinstance(field.dataType, T.ArrayType):
            c = f"array_join({c}, ',')"
        out.append(f"{c} as `{field.name}`")
    return df.selectExpr(*out)


def query(build: Query, name: str | None = None) -> Query:
    """Register a query under its function name."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return present(build(spark, root))

    QUERIES[name or build.__name__] = run
    return build


# ---- staging and validation -------------------------------------------------------------------

@query
def stg_vehicle_positions(spark, root):
    return staging.stg_vehicle_positions(
        feeds.vehicle_positions(spark, root, clock="raw", dirty=True))


@query
def stg_vehicle_telemetry(spark, root):
    return staging.stg_vehicle_telemetry(feeds.vehicle_telemetry(spark, root))


@query
def stg_alerts(spark, root):
    return staging.stg_alerts(feeds.alerts(spark, root))


@query
def bronze_validate(spark, root):
    df = feeds.vehicle_positions(spark, root, clock="raw", dirty=True)
    return bronze.with_valid_speed(bronze.with_valid_location(df)).select(
        "event_id", "vehicle_id", "latitude", "longitude", "speed_kmh", "is_valid_location",
        "is_valid_speed")


def encoded(df: DataFrame, topic: str, key: str) -> DataFrame:
    """Topic rows (``key``, ``value``) that carry the contract columns as JSON."""
    names = [c for c in C.contract(topic).names if c in df.columns]
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*names)).alias("value"))


@query
def bronze_json_decode(spark, root):
    raw = encoded(feeds.vehicle_positions(spark, root, clock="raw"), "vehicle_positions",
                  "vehicle_id")
    return bronze.parse_events(raw, C.contract("vehicle_positions")).select(
        "kafka_key", "event_id", "vehicle_id", "driver_id", "latitude", "longitude", "speed_kmh",
        "state", "altitude_m", "event_timestamp", "event_date")


# ---- fleet --------------------------------------------------------------------------------------

def _positions(spark, root):
    return feeds.vehicle_positions(spark, root)


@query
def trips_haversine(spark, root):
    return fleet.reconstruct_trips(_positions(spark, root))


@query
def trip_segments(spark, root):
    marked = fleet.mark_trip_starts(bronze.valid_positions(_positions(spark, root)))
    return fleet.enrich_segments(marked).select(
        "event_id", "vehicle_id", "trip_sequence", "is_trip_start", "segment_distance_km",
        "segment_duration_seconds", "segment_heading")


def _int_trips(spark, root):
    return fleet.int_vehicle_trips(staging.stg_vehicle_positions(_positions(spark, root)))


@query
def trips_sql_variant(spark, root):
    return _int_trips(spark, root)


@query
def fct_trips(spark, root):
    return fleet.fct_trips(_int_trips(spark, root))


@query
def trips_odometer(spark, root):
    return fleet.trips_from_odometer(_positions(spark, root))


@query
def trips_speed_rule(spark, root):
    marked = fleet.mark_trip_starts(bronze.valid_positions(_positions(spark, root)),
                                    rule="speed")
    return marked.groupBy("vehicle_id", "trip_sequence").agg(
        F.min("event_timestamp").alias("trip_start_time"),
        F.max("event_timestamp").alias("trip_end_time"),
        F.count(F.lit(1)).alias("position_count"), F.avg("speed_kmh").alias("avg_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"))


def _driver_daily(spark, root):
    return fleet.int_driver_daily_metrics(
        staging.stg_vehicle_positions(feeds.vehicle_positions(spark, root, clock="raw")),
        staging.stg_alerts(feeds.alerts(spark, root)))


@query
def driver_daily(spark, root):
    return _driver_daily(spark, root)


@query
def fct_driver_performance(spark, root):
    return fleet.fct_driver_performance(_driver_daily(spark, root))


@query
def driving_events(spark, root):
    return fleet.detect_driving_events(_positions(spark, root))


@query
def idle_events(spark, root):
    return fleet.detect_idle(_positions(spark, root))


@query
def projected_positions(spark, root):
    return fleet.project_positions(feeds.vehicle_positions(spark, root, clock="raw"), 1.0)


@query
def geofence_events(spark, root):
    return alerting.geofence_events(_positions(spark, root), feeds.geofences(spark, root))


def _speeding(spark, root):
    return alerting.speeding_alerts(feeds.vehicle_positions(spark, root, clock="raw")).select(
        "event_id", "vehicle_id", "driver_id", "speed_kmh", "event_type", "severity",
        "event_timestamp")


@query
def speeding_alerts(spark, root):
    return _speeding(spark, root)


@query
def speeding_severity_counts(spark, root):
    return _speeding(spark, root).groupBy("severity").agg(
        F.count(F.lit(1)).alias("alerts"), F.countDistinct("vehicle_id").alias("vehicles"))


# ---- shipments ----------------------------------------------------------------------------------

def _scans(spark, root):
    return feeds.shipment_events(spark, root)


def _staged_scans(spark, root):
    return staging.stg_shipment_events(_scans(spark, root))


@query
def stg_shipment_events(spark, root):
    return _staged_scans(spark, root)


@query
def shipment_sequence(spark, root):
    return shipments.sequence_events(_scans(spark, root)).select(
        "event_id", "shipment_id", "event_type", "hub_id", "event_timestamp", "event_sequence",
        "prev_event_type", "prev_event_time", "prev_hub_id", "next_event_type",
        "next_event_time", "time_since_prev_hours", "journey_stage")


@query
def hub_event_sequence(spark, root):
    return shipments.sequence_hub_events(_scans(spark, root)).select(
        "event_id", "shipment_id", "hub_id", "event_type", "event_timestamp", "hub_event_seq")


@query
def hub_dwell(spark, root):
    return shipments.hub_dwell(_scans(spark, root))


def _journeys(spark, root):
    return shipments.journeys(_scans(spark, root))


@query
def journeys(spark, root):
    return _journeys(spark, root).drop("promised_delivery")


@query
def stuck_shipments(spark, root):
    return shipments.stuck_shipments(_scans(spark, root))


@query
def journeys_risk(spark, root):
    return shipments.journeys_risk_view(_scans(spark, root))


def _int_journeys(spark, root):
    return shipments.int_shipment_journeys(_staged_scans(spark, root))


@query
def journeys_sql_variant(spark, root):
    return _int_journeys(spark, root)


def _fct_shipments(spark, root):
    return shipments.fct_shipments(_int_journeys(spark, root), dims.dim_hubs(spark))


@query
def fct_shipments(spark, root):
    return _fct_shipments(spark, root)


def _throughput(spark, root):
    return shipments.int_hub_throughput(_staged_scans(spark, root))


@query
def hub_throughput(spark, root):
    return _throughput(spark, root)


@query
def fct_hub_daily(spark, root):
    return shipments.fct_hub_daily(_throughput(spark, root), dims.dim_hubs(spark))


@query
def current_status(spark, root):
    return shipments.current_status(_scans(spark, root))


@query
def stuck_alerts(spark, root):
    status = shipments.current_status(_scans(spark, root))
    return shipments.stuck_alerts(status, as_of="2001-08-10 00:00:00")


@query
def hub_hops(spark, root):
    return shipments.hub_hops(_scans(spark, root))


@query
def sla_tracking(spark, root):
    return shipments.sla_tracking(_scans(spark, root), feeds.sla_definitions(spark, root))


@query
def sla_merge(spark, root):
    """The scans up to a day, then all of them, merged with a look-back of three days."""
    scans, definitions = _scans(spark, root), feeds.sla_definitions(spark, root)
    table = daily.sla_table(spark, scratch_path(spark, "sla"))
    daily.merge_sla(table, scans.filter("event_date <= date'1998-12-31'"), definitions)
    daily.merge_sla(table, scans, definitions)
    return table.read().drop("created_month")


@query
def hub_inventory(spark, root):
    return shipments.hub_inventory(_scans(spark, root))


@query
def sla_risk(spark, root):
    flagged = shipments.with_sla_risk(_journeys(spark, root), as_of="1998-06-01 00:00:00")
    return flagged.select("shipment_id", "sla_status", "promised_delivery_ts", "is_sla_at_risk",
                          "is_sla_breached")


@query
def validate_sequence(spark, root):
    return shipments.validate_sequence(_scans(spark, root))


@query
def e2e_journey(spark, root):
    scans = _scans(spark, root)
    return shipments.e2e_journey(scans, shipments.hub_dwell(scans))


# ---- dimensions ---------------------------------------------------------------------------------

@query
def dim_hubs_activity(spark, root):
    """The hub dimension with the scans recorded at each hub."""
    activity = _scans(spark, root).groupBy("hub_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("shipment_id").alias("unique_shipments"))
    return dims.dim_hubs(spark).drop("latitude", "longitude") \
        .join(activity, "hub_id", "left").fillna(0, ["total_events", "unique_shipments"])


@query
def dim_time(spark, root):
    """The calendar of the whole period the scans cover, gaps included."""
    span = _scans(spark, root).agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day")))
                       .alias("date_day"))
    return dims.calendar(days)


@query
def event_calendar(spark, root):
    return dims.event_calendar(_scans(spark, root))


@query
def dim_time_hourly(spark, root):
    return dims.event_hours(_scans(spark, root))


@query
def dim_geography(spark, root):
    return dims.dim_geography(feeds.delivery_events(spark, root))


@query
def dim_customers(spark, root):
    return dims.dim_customers(_scans(spark, root))


@query
def dim_sellers(spark, root):
    return dims.dim_sellers(_scans(spark, root))


# ---- last mile ----------------------------------------------------------------------------------

def _agents(spark, root):
    return feeds.agent_positions(spark, root)


def _deliveries(spark, root):
    return feeds.delivery_events(spark, root)


@query
def stg_agent_positions(spark, root):
    return staging.stg_agent_positions(_agents(spark, root))


@query
def stg_delivery_events(spark, root):
    return staging.stg_delivery_events(_deliveries(spark, root))


@query
def agent_distance(spark, root):
    return delivery.agent_distance(_agents(spark, root))


@query
def delivery_metrics(spark, root):
    return delivery.delivery_metrics(_deliveries(spark, root))


def _shifts(spark, root):
    return delivery.agent_shifts(_agents(spark, root), _deliveries(spark, root))


@query
def agent_shifts(spark, root):
    return _shifts(spark, root)


@query
def agent_ranks(spark, root):
    return _shifts(spark, root).select(
        "agent_id", "zone_id", "event_date", "successful_deliveries", "zone_rank",
        "overall_rank", "is_top_performer")


@query
def zone_performance(spark, root):
    return delivery.zone_performance(_shifts(spark, root))


@query
def top_performers(spark, root):
    return serving.top_performers(_shifts(spark, root))


@query
def top_agents(spark, root):
    return serving.top_agents(_shifts(spark, root))


def _int_shifts(spark, root):
    return delivery.int_agent_shifts(staging.stg_agent_positions(_agents(spark, root)),
                                     staging.stg_delivery_events(_deliveries(spark, root)))


@query
def int_agent_shifts(spark, root):
    return _int_shifts(spark, root)


def _fct_agents(spark, root):
    return delivery.fct_agent_daily(_int_shifts(spark, root))


@query
def fct_agent_daily(spark, root):
    return _fct_agents(spark, root)


@query
def fct_zone_daily(spark, root):
    return delivery.fct_zone_daily(_fct_agents(spark, root))


def _estimate(spark, root):
    return delivery.shift_summary_estimate(_agents(spark, root), _deliveries(spark, root))


@query
def shift_estimate(spark, root):
    return _estimate(spark, root)


@query
def zone_estimate(spark, root):
    return delivery.zone_summary_estimate(_estimate(spark, root))


@query
def area_performance(spark, root):
    return delivery.area_performance(_deliveries(spark, root))


@query
def shifts_from_attempts(spark, root):
    return delivery.shifts_from_attempts(_deliveries(spark, root))


@query
def agent_stops(spark, root):
    return delivery.detect_stops(_agents(spark, root))


@query
def stop_matches(spark, root):
    return delivery.match_stops(delivery.detect_stops(_agents(spark, root)),
                                _deliveries(spark, root))


# ---- alerts and roll-ups ------------------------------------------------------------------------

def _unified(spark, root):
    return alerting.unify_alerts(
        alerting.fleet_alert_records(feeds.alerts(spark, root)),
        alerting.shipment_exception_records(_scans(spark, root)),
        alerting.delivery_failure_records(_deliveries(spark, root)))


@query
def alerts_unified(spark, root):
    return _unified(spark, root)


@query
def alerts_routed(spark, root):
    return alerting.route_alerts(_unified(spark, root)).groupBy(
        "channel", "module", "severity").agg(F.count(F.lit(1)).alias("alerts"))


@query
def hourly_rollup(spark, root):
    return serving.rollup_events(_agents(spark, root), "1 hour", ("zone_id",), "agent_id",
                                 ("speed_kmh",))


@query
def daily_rollup(spark, root):
    return serving.rollup_events(_scans(spark, root), "1 day", ("hub_id",), "shipment_id")


# ---- quality ------------------------------------------------------------------------------------

def _dirty(spark, root):
    return feeds.vehicle_positions(spark, root, clock="raw", dirty=True)


def _bronze_tables(spark, root):
    return {"vehicle_positions": _dirty(spark, root), "shipment_events": _scans(spark, root),
            "agent_positions": _agents(spark, root), "delivery_events": _deliveries(spark, root)}


def _silver_tables(spark, root):
    return {"trips": fleet.reconstruct_trips(_positions(spark, root)),
            "journeys": _journeys(spark, root), "agent_shifts": _shifts(spark, root)}


@query
def dq_bronze(spark, root):
    return quality.bronze_suite(spark, _bronze_tables(spark, root))


@query
def dq_silver(spark, root):
    return quality.silver_suite(spark, _silver_tables(spark, root))


@query
def dq_report(spark, root):
    results = quality.run_checks(spark, "all", {**_bronze_tables(spark, root),
                                                **_silver_tables(spark, root)})
    return quality.quality_report(results, "all", "2024-02-01 00:00:00").drop("checks")


@query
def dq_failed(spark, root):
    return quality.failed_checks(quality.bronze_suite(spark, _bronze_tables(spark, root)))


@query
def model_tests(spark, root):
    staged = _staged_scans(spark, root)
    positions = staging.stg_vehicle_positions(_dirty(spark, root))
    agents = staging.stg_agent_positions(_agents(spark, root))
    deliveries = staging.stg_delivery_events(_deliveries(spark, root))
    hubs = dims.dim_hubs(spark)
    days = delivery.fct_agent_daily(delivery.int_agent_shifts(agents, deliveries))
    return quality.run_model_tests({
        "stg_vehicle_positions": positions,
        "stg_vehicle_telemetry": staging.stg_vehicle_telemetry(
            feeds.vehicle_telemetry(spark, root)),
        "stg_alerts": staging.stg_alerts(feeds.alerts(spark, root)),
        "stg_shipment_events": staged, "stg_agent_positions": agents,
        "stg_delivery_events": deliveries,
        "fct_trips": fleet.fct_trips(_int_trips(spark, root)),
        "fct_driver_performance": fleet.fct_driver_performance(_driver_daily(spark, root)),
        "fct_shipments": shipments.fct_shipments(shipments.int_shipment_journeys(staged), hubs),
        "fct_hub_daily": shipments.fct_hub_daily(shipments.int_hub_throughput(staged), hubs),
        "fct_agent_daily": days, "fct_zone_daily": delivery.fct_zone_daily(days),
        "dim_hubs": hubs, "dim_time": dim_time(spark, root),
    })


@query
def relationships(spark, root):
    warned = feeds.alerts(spark, root).filter("event_type = 'SPEEDING'")
    return quality.check_relationship(_dirty(spark, root), warned, "vehicle_id")


@query
def expression_check(spark, root):
    return quality.check_expression(_deliveries(spark, root),
                                    "cod_collected <= cod_amount and attempt_number <= 2")


@query
def failing_rows(spark, root):
    return quality.failing_rows(feeds.vehicle_positions(spark, root, clock="raw"),
                                quality.unique("trip_id"))


# ---- figures and distributions ------------------------------------------------------------------

@query
def kpis(spark, root):
    return serving.warehouse_kpis(fleet.fct_trips(_int_trips(spark, root)),
                                  _fct_shipments(spark, root), _fct_agents(spark, root))


@query
def overview_counts(spark, root):
    return serving.overview_counts(feeds.vehicle_positions(spark, root, clock="raw"),
                                   _scans(spark, root), _deliveries(spark, root))


@query
def value_counts(spark, root):
    return serving.value_counts(_scans(spark, root), "event_type")


@query
def outcome_counts(spark, root):
    return serving.value_counts(_journeys(spark, root), "journey_outcome", order="asc")


@query
def rating_counts(spark, root):
    return serving.value_counts(_deliveries(spark, root).filter("customer_rating is not null"),
                                "customer_rating")


@query
def vehicles_by_type(spark, root):
    return serving.vehicles_by_type(feeds.vehicle_positions(spark, root, clock="raw"))


@query
def hub_activity(spark, root):
    return serving.hub_activity(_scans(spark, root))


@query
def zone_stats(spark, root):
    return serving.zone_stats(_deliveries(spark, root))


@query
def sla_compliance(spark, root):
    return serving.sla_compliance(_journeys(spark, root))


@query
def trip_summary(spark, root):
    return serving.trip_summary(fleet.reconstruct_trips(_positions(spark, root)))


@query
def delivery_success_rate(spark, root):
    return serving.delivery_success_rate(_deliveries(spark, root))


@query
def speed_histogram(spark, root):
    return serving.histogram(feeds.vehicle_positions(spark, root, clock="raw"), "speed_kmh", 40)


@query
def distance_histogram(spark, root):
    return serving.histogram(fleet.reconstruct_trips(_positions(spark, root)),
                             "total_distance_km", 30)


@query
def rating_histogram(spark, root):
    return serving.histogram(_deliveries(spark, root), "customer_rating", 5)


@query
def speed_quartiles(spark, root):
    return serving.speed_quartiles(feeds.vehicle_positions(spark, root, clock="raw"))


@query
def inventory(spark, root):
    return serving.inventory({
        "vehicle_positions": ("Bronze", feeds.vehicle_positions(spark, root, clock="raw")),
        "shipment_events": ("Bronze", _scans(spark, root)),
        "delivery_events": ("Bronze", _deliveries(spark, root)),
        "trips": ("Silver", fleet.reconstruct_trips(_positions(spark, root))),
        "zone_performance": ("Silver", None),
    })


@query
def compact_numbers(spark, root):
    totals = feeds.read_table(spark, root, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), rounded(F.sum("value"), 2).alias("total"))
    return totals.withColumn("label", compact_number(F.col("total")))


@query
def vehicle_drilldown(spark, root):
    return serving.positions_for(feeds.vehicle_positions(spark, root, clock="raw"),
                                 "VEH_00007").select(
        "event_id", "vehicle_id", "event_timestamp", "speed_kmh", "state")


@query
def sample_positions(spark, root):
    return serving.sample_positions(feeds.vehicle_positions(spark, root, clock="raw"), 2000) \
        .select("event_id", "vehicle_id", "latitude", "longitude", "speed_kmh")


# ---- streams --------------------------------------------------------------------------------------
# The given tables are read as unbounded input; each stream runs to the end of it into a table in
# the shared scratch folder, which is then read back.

def _drain(spark, stream: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    ingest.write_stream(stream, f"{path}/table", f"{path}/checkpoint", partition_cols=(),
                        available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/table")


def _position_stream(spark, root, **kwargs):
    return feeds.vehicle_positions(spark, root, table=feeds.stream_table, **kwargs)


@query
def stream_bronze(spark, root):
    raw = encoded(_position_stream(spark, root, clock="raw", dirty=True), "vehicle_positions",
                  "vehicle_id")
    path = scratch_path(spark, "bronze")
    rows = ingest.bronze_rows(raw, "vehicle_positions")
    with ingest.open_writers(spark):
        ingest.write_stream(rows, f"{path}/table", f"{path}/checkpoint",
                            available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/table").select(
        "event_id", "vehicle_id", "latitude", "longitude", "speed_kmh", "is_valid_location",
        "is_valid_speed")


@query
def stream_dedup(spark, root):
    """Every event is delivered twice and kept once."""
    twice = _position_stream(spark, root, clock="raw").unionByName(
        _position_stream(spark, root, clock="raw"))
    raw = encoded(twice, "vehicle_positions", "vehicle_id")
    path = scratch_path(spark, "dedup")
    ingest.write_deduplicated(
        ingest.bronze_rows(raw, "vehicle_positions"), f"{path}/bronze/vehicle_positions",
        f"{path}/bronze_late/vehicle_positions", f"{path}/checkpoint", "1 hour",
        available_now=True).awaitTermination()
    return read_bronze(spark, path, "vehicle_positions").select(
        "event_id", "vehicle_id", "event_timestamp", "speed_kmh")


@query
def stream_speeding(spark, root):
    alerts = detect.stream_speeding(_position_stream(spark, root, clock="raw"))
    return _drain(spark, alerts, "speeding").select(
        "event_id", "vehicle_id", "driver_id", "speed_kmh", "event_type", "severity",
        "event_timestamp")


@query
def stream_driving_events(spark, root):
    path = scratch_path(spark, "driving")
    detect.stream_driving_events(_position_stream(spark, root), path, f"{path}/checkpoint",
                                 available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/events").drop("batch")


@query
def stream_geofence(spark, root):
    path = scratch_path(spark, "geofence")
    detect.stream_geofence(_position_stream(spark, root), feeds.geofences(spark, root), path,
                           f"{path}/checkpoint", available_now=True).awaitTermination()
    return detect.read_geofence_events(spark, path)


@query
def stream_status_upsert(spark, root):
    path = scratch_path(spark, "status")
    scans = feeds.shipment_events(spark, root, table=feeds.stream_table)
    status.stream_status(scans, f"{path}/table", f"{path}/checkpoint",
                         available_now=True).awaitTermination()
    return status.read_status(spark, f"{path}/table")


@query
def stream_alerts(spark, root):
    """All alert records as a stream, each twice, unified in a table that keeps the worst."""
    path = scratch_path(spark, "alerts")
    records = alerting.alert_records(
        alerting.fleet_alert_records(feeds.alerts(spark, root, table=feeds.stream_table)),
        alerting.shipment_exception_records(feeds.shipment_events(spark, root, table=feeds.stream_table)),
        alerting.delivery_failure_records(feeds.delivery_events(spark, root, table=feeds.stream_table)))
    detect.stream_alerts(records.unionByName(records), f"{path}/table", f"{path}/checkpoint",
                         available_now=True).awaitTermination()
    return detect.read_alerts(spark, f"{path}/table")


@query
def stream_failure_alerts(spark, root):
    failed = feeds.delivery_events(spark, root, table=feeds.stream_table)
    return _drain(spark, detect.stream_failure_alerts(failed), "failures")


@query
def stream_stops(spark, root):
    """Sessions of slow points at most ninety minutes apart that the watermark has closed."""
    slow = detect.stream_stops(feeds.agent_positions(spark, root, table=feeds.stream_table),
                               gap="90 minutes")
    return _drain(spark, slow, "stops")


@query
def stream_rollup(spark, root):
    rolled = serving.rollup_events(
        feeds.agent_positions(spark, root, table=feeds.stream_table), "1 day", ("zone_id",),
        measures=("speed_kmh",))
    return _drain(spark, rolled, "rollup")


from routeline.plans import catalog_lake  # noqa: E402,F401  registers its queries
