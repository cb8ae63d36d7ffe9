"""Parcel journeys, hub dwell and throughput, service levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeline import contracts as C
from routeline.functions import labels
from routeline.functions.clock import elapsed
from routeline.functions.values import (
    count_when, require_non_negative_number, rounded, safe_div, surrogate_key,
)
from routeline.operators.timeline import Timeline, with_last_seen, with_neighbours

BY_SHIPMENT = Timeline(keys=("shipment_id",))
FINAL_EVENTS = ("DELIVERED", "DELIVERY_FAILED", "RETURNED_TO_ORIGIN")
CLOSED_STATUSES = ("DELIVERED", "RETURNED_TO_ORIGIN", "LOST")


def _at() -> Column:
    return F.struct("event_timestamp", "event_id")


def _last(*columns: str) -> Column:
    """Attributes of the latest event."""
    return F.max_by(F.struct(*columns), _at())


def _hub_count() -> Column:
    """Distinct hubs of a shipment. The set is bounded by the hub network, so it can travel with
    the other aggregates instead of costing a second shuffle of all events."""
    return F.size(F.collect_set("hub_id")).cast("long")


# ---- sequencing -----------------------------------------------------------------------------

def sequence_events(events: DataFrame, line: Timeline = BY_SHIPMENT) -> DataFrame:
    """Number the scans of each shipment and attach the neighbouring scans."""
    linked = with_neighbours(
        events, line, sequence="event_sequence",
        previous={"prev_event_type": "event_type", "prev_event_time": "event_timestamp",
                  "prev_hub_id": "hub_id"},
        following={"next_event_type": "event_type", "next_event_time": "event_timestamp"})
    return linked.withColumns({
        "time_since_prev_hours": elapsed(F.col("prev_event_time"), F.col("event_timestamp"),
                                         "hours"),
        "journey_stage": labels.journey_stage(F.col("event_type"), with_exception=False),
    })


def sequence_hub_events(events: DataFrame) -> DataFrame:
    """Number the hub scans of each shipment at each hub."""
    line = Timeline(keys=("shipment_id", "hub_id"))
    return with_neighbours(events.filter(F.col("event_type").like("HUB_%")), line,
                           sequence="hub_event_seq")


def _with_gaps(events: DataFrame, line: Timeline) -> DataFrame:
    linked = with_neighbours(events, line, previous={"_before": "event_timestamp"})
    return linked.withColumn("_gap", elapsed(F.col("_before"), F.col("event_timestamp"), "hours"))


# ---- journeys -------------------------------------------------------------------------------

def hub_dwell(events: DataFrame, bottleneck_hours: float = C.LIMITS.bottleneck_hours) -> DataFrame:
    """Stay of each shipment at each hub.

    ``hub_events`` lists the scan types in order of (event_timestamp, event_id). The list is part of
    the result; a stay holds the few scans one parcel gets at one hub.
    """
    require_non_negative_number(bottleneck_hours, "bottleneck_hours")
    place = ["shipment_id", "hub_id", "hub_name", "hub_city"]
    stays = events.filter(F.col("event_type").like("HUB_%")).groupBy(*place).agg(
        F.min("event_timestamp").alias("hub_arrival_time"),
        F.max("event_timestamp").alias("hub_departure_time"),
        F.count(F.lit(1)).alias("hub_event_count"),
        F.sort_array(F.collect_list(F.struct("event_timestamp", "event_id", "event_type"))).alias("_scans"))
    hours = elapsed(F.col("hub_arrival_time"), F.col("hub_departure_time"), "hours")
    listed = F.transform("_scans", lambda scan: scan["event_type"])
    return stays.select(*place, "hub_arrival_time", "hub_departure_time", "hub_event_count",
                        listed.alias("hub_events"), hours.alias("hub_dwell_hours"),
                        (hours > bottleneck_hours).alias("is_bottleneck"))


_JOURNEY_ATTRIBUTES = ("awb_number", "seller_id", "customer_id", "origin_hub", "destination_hub",
                       "is_cod", "cod_amount", "promised_delivery", "route_hops")


def aggregate_journeys(events: DataFrame, stuck_hours: float = C.LIMITS.stuck_hours,
                       line: Timeline = BY_SHIPMENT) -> DataFrame:
    """One row per shipment; attributes that changed on the way are those of its latest scan."""
    gapped = _with_gaps(events, line)
    return gapped.groupBy("shipment_id").agg(
        _last(*_JOURNEY_ATTRIBUTES, "event_type", "failure_reason").alias("_end"),
        F.min("event_timestamp").alias("journey_start_time"),
        F.max("event_timestamp").alias("journey_end_time"),
        F.min_by("event_type", _at()).alias("first_event"),
        F.count(F.lit(1)).alias("total_events"),
        _hub_count().alias("hubs_visited"),
        F.max("delivery_attempts").alias("delivery_attempts"),
        count_when(F.col("_gap") > stuck_hours).alias("stuck_incidents"),
        F.max("_gap").alias("max_gap_hours"),
    ).select(
        "shipment_id", *[F.col("_end")[a].alias(a) for a in _JOURNEY_ATTRIBUTES],
        "journey_start_time", "journey_end_time", "first_event",
        F.col("_end")["event_type"].alias("last_event"), "total_events", "hubs_visited",
        "delivery_attempts", F.col("_end")["failure_reason"].alias("last_failure_reason"),
        "stuck_incidents", "max_gap_hours",
    )


def _sla(last: Column, end: Column, promised: Column, failed: tuple[str, ...]) -> dict:
    delivered = last == "DELIVERED"
    return {
        "sla_status": labels.first_match(
            [(delivered & (end <= promised), "MET"), (delivered, "BREACHED"),
             (last.isin(*failed), "FAILED")], "IN_PROGRESS"),
        "sla_variance_hours": F.when(delivered, elapsed(promised, end, "hours")),
    }


def with_sla(journeys: DataFrame) -> DataFrame:
    hours = elapsed(F.col("journey_start_time"), F.col("journey_end_time"), "hours")
    promised = F.try_to_timestamp(F.col("promised_delivery").cast("string"))
    return journeys.withColumns({
        "promised_delivery_ts": promised, "journey_duration_hours": hours,
        "journey_duration_days": hours / 24.0,
        **_sla(F.col("last_event"), F.col("journey_end_time"), promised,
               ("DELIVERY_FAILED", "RETURNED_TO_ORIGIN")),
    })


def _outcome(last: Column, stuck: Column) -> Column:
    return labels.first_match(
        [(last == "DELIVERED", "DELIVERED"), (last == "DELIVERY_FAILED", "FAILED"),
         (last == "RETURNED_TO_ORIGIN", "RETURNED"), (stuck > 0, "STUCK")], "IN_TRANSIT")


def _complexity(hubs: Column) -> Column:
    return labels.first_match([(hubs <= 2, "SIMPLE"), (hubs <= 4, "MODERATE")], "COMPLEX")


def classify_journeys(journeys: DataFrame) -> DataFrame:
    return journeys.withColumns({
        "journey_outcome": _outcome(F.col("last_event"), F.col("stuck_incidents")),
        "had_delivery_issues": F.col("delivery_attempts") > 1,
        "is_express": F.col("route_hops") <= 2,
        "complexity": _complexity(F.col("hubs_visited")),
    })


def journeys(events: DataFrame, stuck_hours: float = C.LIMITS.stuck_hours,
             line: Timeline = BY_SHIPMENT) -> DataFrame:
    require_non_negative_number(stuck_hours, "stuck_hours")
    done = classify_journeys(with_sla(aggregate_journeys(events, stuck_hours, line)))
    return done.withColumn("journey_date", F.to_date("journey_start_time"))


def reconstruct_journeys(events: DataFrame, stuck_hours: float = C.LIMITS.stuck_hours,
                         bottleneck_hours: float = C.LIMITS.bottleneck_hours
                         ) -> tuple[DataFrame, DataFrame]:
    """(journeys, hub dwell) of an event table."""
    return journeys(events, stuck_hours), hub_dwell(events, bottleneck_hours)


def stuck_shipments(events: DataFrame, hours: float | None = None,
                    line: Timeline = BY_SHIPMENT) -> DataFrame:
    """Scans that ended a silence longer than ``hours`` without closing the shipment."""
    limit = C.LIMITS.stuck_hours if hours is None else hours
    return _with_gaps(events, line).filter(
        (F.col("_gap") > limit) & ~F.col("event_type").isin(*FINAL_EVENTS)
    ).select(
        "shipment_id", "awb_number", "hub_id", "hub_name", "event_type", "event_timestamp",
        F.col("_gap").alias("time_since_prev_hours"),
    ).orderBy(F.desc("time_since_prev_hours"), "shipment_id", "event_timestamp")


def journeys_risk_view(events: DataFrame, line: Timeline = BY_SHIPMENT) -> DataFrame:
    """Journeys labelled for follow-up; the promise is the one made at the first scan."""
    gapped = _with_gaps(events, line)
    first = F.min_by(F.struct("origin_hub", "destination_hub", "promised_delivery"), _at())
    rows = gapped.groupBy("shipment_id").agg(
        first.alias("a"), F.max_by("event_type", _at()).alias("last"),
        F.min("event_timestamp").alias("journey_start_time"),
        F.max("event_timestamp").alias("journey_end_time"),
        F.count(F.lit(1)).alias("total_events"),
        _hub_count().alias("hubs_traversed"),
        count_when(F.col("_gap") > 24).alias("stuck_incidents"),
        F.max("delivery_attempts").alias("delivery_attempts"),
    )
    last, end = F.col("last"), F.col("journey_end_time")
    promised = F.try_to_timestamp(F.col("a")["promised_delivery"].cast("string"))
    delivered = last == "DELIVERED"
    return rows.select(
        surrogate_key(F.col("shipment_id")).alias("journey_id"), "shipment_id",
        F.col("a")["origin_hub"].alias("origin_hub"),
        F.col("a")["destination_hub"].alias("destination_hub"),
        "journey_start_time", "journey_end_time",
        F.to_date("journey_start_time").alias("journey_date"),
        rounded(elapsed(F.col("journey_start_time"), end, "hours"), 2)
        .alias("journey_duration_hours"),
        labels.first_match([(delivered, "DELIVERED"), (last == "DELIVERY_FAILED", "FAILED"),
                            (last == "DELIVERY_ATTEMPTED", "AT_RISK")], "IN_TRANSIT")
        .alias("journey_outcome"),
        labels.first_match([(delivered & (end <= promised), "MET"), (delivered, "BREACHED"),
                            (last == "DELIVERY_FAILED", "FAILED"),
                            (last == "DELIVERY_ATTEMPTED", "AT_RISK")], "ON_TRACK")
        .alias("sla_status"),
        F.when(delivered, rounded(elapsed(promised, end, "hours"), 2))
        .alias("sla_variance_hours"),
        "total_events", "hubs_traversed", "stuck_incidents", "delivery_attempts",
    )


# ---- warehouse models -----------------------------------------------------------------------

def int_shipment_journeys(stg: DataFrame, stuck_hours: float = C.LIMITS.stuck_hours,
                          line: Timeline = BY_SHIPMENT) -> DataFrame:
    """Warehouse journeys from the staging view; first and last events are chronological."""
    gapped = _with_gaps(stg, line)
    parties = ("awb_number", "seller_id", "customer_id", "origin_hub", "destination_hub")
    rows = gapped.groupBy("shipment_id").agg(
        _last(*parties, "event_type", "failure_reason").alias("_end"),
        F.max("is_cod").alias("is_cod"), F.max("cod_amount").alias("cod_amount"),
        F.max("route_hops").alias("route_hops"),
        F.min("event_timestamp").alias("journey_start_time"),
        F.max("event_timestamp").alias("journey_end_time"),
        F.min("event_date").alias("journey_start_date"),
        F.max("promised_delivery_at").alias("promised_delivery_at"),
        F.min_by("event_type", _at()).alias("first_event_type"),
        F.count(F.lit(1)).alias("total_events"),
        _hub_count().alias("hubs_visited"),
        count_when(F.col("event_category") == "HUB_OPERATION").alias("hub_events"),
        F.max("delivery_attempts").alias("delivery_attempts"),
        count_when(F.col("_gap") > stuck_hours).alias("stuck_incidents"),
        F.max("_gap").alias("max_gap_hours"),
    )
    end = F.col("_end")
    hours = elapsed(F.col("journey_start_time"), F.col("journey_end_time"), "hours")
    sla = _sla(end["event_type"], F.col("journey_end_time"), F.col("promised_delivery_at"),
               ("DELIVERY_FAILED", *C.EXCEPTION_EVENTS))
    return rows.select(
        "shipment_id", *[end[p].alias(p) for p in parties], "is_cod", "cod_amount", "route_hops",
        "journey_start_time", "journey_end_time", "journey_start_date", "promised_delivery_at",
        "first_event_type", end["event_type"].alias("last_event_type"), "total_events",
        "hubs_visited", "hub_events", "delivery_attempts",
        end["failure_reason"].alias("last_failure_reason"), "stuck_incidents", "max_gap_hours",
        hours.alias("journey_duration_hours"), (hours / 24.0).alias("journey_duration_days"),
        *[c.alias(name) for name, c in sla.items()],
        _outcome(end["event_type"], F.col("stuck_incidents")).alias("journey_outcome"),
        _complexity(F.col("hubs_visited")).alias("journey_complexity"),
        F.coalesce(F.col("delivery_attempts") > 1, F.lit(False)).alias("had_delivery_issues"),
        F.coalesce(F.col("route_hops") <= 2, F.lit(False)).alias("is_express"),
    )


def int_hub_throughput(stg: DataFrame) -> DataFrame:
    """Scan volumes per hub and day.

    Events are reduced to a parcel's visit first: parcels are counted without sending every event once per
    distinct count. Workers and scanners are collected; a hub's staff of one day bounds these sets.
    """
    kind, hour = F.col("event_type"), F.col("hour_of_day")
    place = ["hub_id", "hub_name", "hub_city", "event_date"]
    counts = {
        "total_events": F.count(F.lit(1)), "arrivals": count_when(kind == "HUB_ARRIVED"),
        "inscans": count_when(kind == "HUB_INSCAN"), "sorted": count_when(kind == "HUB_SORTED"),
        "outscans": count_when(kind == "HUB_OUTSCAN"), "departures": count_when(kind == "HUB_DEPARTED"),
        "morning_events": count_when(hour.between(6, 11)), "afternoon_events": count_when(hour.between(12, 17)),
        "evening_events": count_when(hour.between(18, 23)), "night_events": count_when(hour.between(0, 5))}
    people = {"unique_workers": "worker_id", "unique_scanners": "scanner_id"}
    visits = stg.filter("hub_id is not null").groupBy(*place, "shipment_id").agg(
        *[c.alias(name) for name, c in counts.items()],
        *[F.collect_set(c).alias(name) for name, c in people.items()])
    rows = visits.groupBy(*place).agg(
        F.count("shipment_id").alias("unique_shipments"), *[F.sum(name).alias(name) for name in counts],
        *[F.size(F.array_distinct(F.flatten(F.collect_set(name)))).cast("long").alias(name) for name in people])
    ratio = safe_div(F.col("departures"), F.col("arrivals"))
    peak = labels.peak_of([(F.col(f"{p.lower()}_events"), p)
                           for p in ("MORNING", "AFTERNOON", "EVENING", "NIGHT")])
    return rows.withColumns({
        "throughput_ratio": ratio,
        "processing_rate": safe_div(F.col("sorted"), F.col("inscans")),
        "peak_period": peak,
        "has_backlog": F.col("arrivals") > F.col("departures") * 1.2,
        "efficiency_rating": labels.at_least(ratio, ((0.95, "HIGH"), (0.8, "MEDIUM")), "LOW"),
    })


def _hub_role(hubs: DataFrame, prefix: str, key: str) -> DataFrame:
    """The hub dimension in one role; the planner broadcasts it if it is small."""
    return hubs.select(
        F.col("hub_id").alias(key), F.col("hub_name").alias(f"{prefix}_hub_name"),
        F.col("city").alias(f"{prefix}_city"), F.col("region").alias(f"{prefix}_region"))


def fct_shipments(journeys: DataFrame, hubs: DataFrame) -> DataFrame:
    def flag(column: str, value: str, name: str) -> Column:
        return F.when(F.col(column) == value, 1).otherwise(0).alias(name)

    return (
        journeys.withColumnsRenamed({"origin_hub": "origin_hub_id",
                                     "destination_hub": "destination_hub_id"})
        .join(_hub_role(hubs, "origin", "origin_hub_id"), "origin_hub_id", "left")
        .join(_hub_role(hubs, "destination", "destination_hub_id"), "destination_hub_id", "left")
        .select(
            surrogate_key(F.col("shipment_id")).alias("shipment_key"), "shipment_id",
            "awb_number", "seller_id", "customer_id", "origin_hub_id", "destination_hub_id",
            "origin_hub_name", "origin_city", "origin_region", "destination_hub_name",
            "destination_city", "destination_region",
            F.col("journey_start_date").alias("date_key"), "journey_start_time",
            "journey_end_time", "promised_delivery_at", "journey_outcome", "sla_status",
            "journey_complexity", "is_express", "is_cod", "route_hops", "hubs_visited",
            "total_events", "journey_duration_hours", "sla_variance_hours", "max_gap_hours",
            "stuck_incidents", "delivery_attempts", "had_delivery_issues", "cod_amount",
            flag("sla_status", "MET", "sla_met_flag"),
            flag("sla_status", "BREACHED", "sla_breached_flag"),
            flag("journey_outcome", "DELIVERED", "delivered_flag"),
            flag("journey_outcome", "FAILED", "failed_flag"),
            flag("journey_outcome", "RETURNED", "returned_flag"),
        )
    )


def fct_hub_daily(throughput: DataFrame, hubs: DataFrame) -> DataFrame:
    master = hubs.select("hub_id", F.col("hub_name").alias("_name"), "city", "region",
                         "hub_type", "capacity_daily")
    return throughput.join(master, "hub_id", "left").select(
        surrogate_key(F.col("hub_id"), F.col("event_date")).alias("hub_daily_key"), "hub_id",
        F.col("event_date").alias("date_key"), F.col("_name").alias("hub_name"), "city",
        "region", "hub_type", "capacity_daily", "unique_shipments", "total_events", "arrivals",
        "departures", "inscans", "outscans", "sorted", "throughput_ratio", "processing_rate",
        "efficiency_rating",
        safe_div(F.col("unique_shipments"), F.col("capacity_daily"))
        .alias("capacity_utilization"),
        "morning_events", "afternoon_events", "evening_events", "night_events", "peak_period",
        "unique_workers", "unique_scanners", "has_backlog",
        F.when(F.col("efficiency_rating") == "LOW", 1).otherwise(0).alias("is_bottleneck_flag"),
    )


# ---- status, hops, service levels -----------------------------------------------------------

def current_status(events: DataFrame) -> DataFrame:
    """Latest state per shipment, whatever the arrival order of its events."""
    latest = _last("event_type", "hub_id", "latitude", "longitude", "event_timestamp", "event_id")
    s = F.col("s")
    return events.groupBy("shipment_id").agg(
        latest.alias("s"), F.min("event_timestamp").alias("created_at")).select(
        "shipment_id", s["event_type"].alias("current_status"),
        s["hub_id"].alias("current_hub_id"), s["event_id"].alias("last_event_id"),
        s["event_type"].alias("last_event_type"),
        s["event_timestamp"].alias("last_event_timestamp"),
        s["latitude"].alias("current_latitude"), s["longitude"].alias("current_longitude"),
        "created_at")


def stuck_alerts(status: DataFrame, as_of: str,
                 hours: float = C.LIMITS.stuck_hours) -> DataFrame:
    """Open shipments that have been silent for more than ``hours`` at ``as_of``."""
    now = F.lit(as_of).cast("timestamp")
    silent = elapsed(F.col("last_event_timestamp"), now, "hours")
    return status.filter(~F.col("current_status").isin(*CLOSED_STATUSES)).select(
        F.lit("SHIPMENT").alias("module"), F.lit("STUCK_PACKAGE").alias("alert_type"),
        labels.above(silent, ((72, "CRITICAL"), (48, "HIGH")), "WARNING").alias("severity"),
        F.col("shipment_id").alias("entity_id"), F.col("current_hub_id").alias("hub_id"),
        silent.alias("hours_since_last_event"), now.alias("alert_timestamp"),
    ).filter(F.col("hours_since_last_event") > hours)


def hub_hops(events: DataFrame, date: str | None = None,
             bottleneck_hours: float = C.LIMITS.bottleneck_hours) -> DataFrame:
    """Hub arrivals, hop by hop, of the shipments delivered (on ``date``, or ever)."""
    done = events.filter(F.col("event_type") == "DELIVERED")
    if date:
        done = done.filter(F.col("event_date") == date)
        events = events.filter(F.col("event_date") <= date)
    arrivals = events.filter(F.col("event_type") == "HUB_ARRIVED").join(
        done.select("shipment_id"), "shipment_id", "left_semi")
    hops = with_neighbours(arrivals, BY_SHIPMENT, sequence="hop_sequence",
                           following={"departure_timestamp": "event_timestamp"})
    hours = elapsed(F.col("event_timestamp"), F.col("departure_timestamp"), "hours")
    return hops.select(
        "shipment_id", "hop_sequence", "hub_id", "hub_city",
        F.col("event_timestamp").alias("arrival_timestamp"), "departure_timestamp",
        hours.alias("dwell_time_hours"), (hours > bottleneck_hours).alias("is_bottleneck"),
        (F.col("hop_sequence") == 1).alias("is_first_hub"))


def sla_tracking(events: DataFrame, definitions: DataFrame, since: str | None = None) -> DataFrame:
    """Promised against actual days per shipment.

    ``since`` limits a run to shipments created from that day on: those with a scan since then, with all their
    scans, of which the older ones may show that a shipment was created before.
    """
    if since:
        recent = events.filter(F.col("event_date") >= F.lit(since).cast("date"))
        events = events.join(recent.select("shipment_id").distinct(), "shipment_id", "left_semi")
    rows = events.groupBy("shipment_id").agg(
        _last("origin_hub", "destination_hub", "promised_delivery", "route_hops").alias("s"),
        F.min(F.when(F.col("event_type") == "CREATED", F.col("event_timestamp")))
        .alias("_created"),
        F.min("event_timestamp").alias("_first"),
        F.min(F.when(F.col("event_type") == "DELIVERED", F.col("event_timestamp")))
        .alias("delivered_at"),
        F.max(F.when(F.col("event_type").isin(*CLOSED_STATUSES), F.col("event_type")))
        .alias("final_status"),
    ).select(
        "shipment_id", F.col("s")["origin_hub"].alias("origin_hub"),
        F.col("s")["destination_hub"].alias("destination_hub"),
        F.when(F.col("s")["route_hops"] <= 2, "EXPRESS").otherwise("STANDARD")
        .alias("service_type"),
        F.to_date(F.coalesce("_created", "_first")).alias("created_date"),
        F.to_date(F.try_to_timestamp(F.col("s")["promised_delivery"].cast("string")))
        .alias("promised_date"),
        F.to_date("delivered_at").alias("actual_delivery_date"), "final_status")
    if since:
        rows = rows.filter(F.col("created_date") >= F.lit(since).cast("date"))
    actual, promised = F.col("actual_delivery_date"), F.col("promised_date")
    keys = ["origin_hub", "destination_hub", "service_type"]
    return rows.join(definitions, keys, "left").select(
        "shipment_id", *keys, "created_date", "promised_date", "actual_delivery_date",
        "promised_days", F.datediff(actual, "created_date").alias("actual_days"),
        labels.sla_variance_days(promised, actual).alias("variance_days"),
        labels.sla_status(promised, actual, actual.isNotNull()).alias("sla_status"),
        "final_status", actual.isNotNull().alias("is_delivered"),
        (actual <= promised).alias("is_on_time"))


def hub_inventory(events: DataFrame) -> DataFrame:
    """Opening and closing stock per hub and day. Events are reduced to hub days first; the
    running sum then covers one row per day of a hub."""
    kind = F.col("event_type")
    days = events.filter("hub_id is not null").groupBy("hub_id", "event_date").agg(
        count_when(kind == "HUB_ARRIVED").alias("packages_received"),
        count_when(kind == "HUB_DEPARTED").alias("packages_dispatched"),
        count_when(kind.isin("HUB_INSCAN", "HUB_SORTED")).alias("packages_processed"))
    by_day = Window.partitionBy("hub_id").orderBy("event_date")
    net = F.col("packages_received") - F.col("packages_dispatched")
    closing = F.sum(net).over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.withColumn("closing_inventory", closing).withColumn(
        "opening_inventory", F.col("closing_inventory") - net)


def with_sla_risk(journeys: DataFrame, as_of: str,
                  hours: float = C.LIMITS.sla_risk_hours) -> DataFrame:
    """Flag undelivered journeys whose promise falls due within ``hours`` of ``as_of``, and
    those already past it."""
    due = elapsed(F.lit(as_of).cast("timestamp"), F.col("promised_delivery_ts"), "hours")
    open_ = F.col("sla_status") == "IN_PROGRESS"
    return journeys.withColumns({
        "is_sla_at_risk": F.coalesce(open_ & due.between(0, hours), F.lit(False)),
        "is_sla_breached": F.coalesce((F.col("sla_status") == "BREACHED") | (open_ & (due < 0)),
                                      F.lit(False)),
    })


# ---- Fixed values: scans allowed after each scan ----------------------------------------------
NEXT_EVENTS = {
    "CREATED": ("PICKUP_SCHEDULED", "PICKED_UP"),
    "PICKUP_SCHEDULED": ("PICKED_UP",),
    "PICKED_UP": ("HUB_ARRIVED", "IN_TRANSIT"),
    "HUB_ARRIVED": ("HUB_INSCAN",),
    "HUB_INSCAN": ("HUB_SORTED",),
    "HUB_SORTED": ("HUB_OUTSCAN", "OUT_FOR_DELIVERY"),
    "HUB_OUTSCAN": ("HUB_DEPARTED", "OUT_FOR_DELIVERY"),
    "HUB_DEPARTED": ("IN_TRANSIT", "HUB_ARRIVED"),
    "IN_TRANSIT": ("HUB_ARRIVED", "OUT_FOR_DELIVERY"),
    "OUT_FOR_DELIVERY": ("DELIVERED", "DELIVERY_ATTEMPTED", "DELIVERY_FAILED"),
    "DELIVERY_ATTEMPTED": ("OUT_FOR_DELIVERY", "DELIVERED", "DELIVERY_FAILED"),
    "DELIVERY_FAILED": ("RETURNED_TO_ORIGIN",),
}


def validate_sequence(events: DataFrame, line: Timeline = BY_SHIPMENT,
                      allowed: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Flag scans that do not follow from the scan before. LOST and DAMAGED may follow any
    scan of an open shipment."""
    table = NEXT_EVENTS if allowed is None else allowed
    linked = with_neighbours(events, line, sequence="event_sequence",
                             previous={"prev_event_type": "event_type"})
    before, now = F.col("prev_event_type"), F.col("event_type")
    follows = F.lit(False)
    for origin, targets in table.items():
        follows = follows | ((before == origin) & now.isin(*targets))
    mishap = now.isin("LOST", "DAMAGED") & ~before.isin("DELIVERED", "RETURNED_TO_ORIGIN",
                                                         "LOST", "DAMAGED")
    ok = F.when(before.isNull(), now == "CREATED").otherwise(follows | mishap)
    return linked.select("event_id", "shipment_id", "event_timestamp", "event_sequence",
                         "prev_event_type", "event_type",
                         F.coalesce(ok, F.lit(False)).alias("is_valid_transition"))


def correlate_vehicle(events: DataFrame, positions: DataFrame, within_hours: float = 6.0,
                      cell_degrees: float = 0.5, slice_line: Timeline | None = None) -> DataFrame:
    """The vehicle last seen in the cell of a hub departure, no earlier than ``within_hours``.

    An as-of join without pairs: departures and positions form one series per cell, in which
    every departure looks up the latest position before it.
    """
    def cell(lat: str, lng: str) -> Column:
        return F.concat_ws(":", F.floor(F.col(lat) / cell_degrees).cast("string"),
                           F.floor(F.col(lng) / cell_degrees).cast("string"))

    seen = positions.filter("latitude is not null and longitude is not null").select(
        cell("latitude", "longitude").alias("cell"), "event_timestamp", "event_id",
        F.struct(F.col("vehicle_id"), F.col("event_timestamp").alias("seen_at")).alias("v"),
        F.lit(0).alias("_asks"), F.lit(None).cast("string").alias("shipment_id"),
        F.lit(None).cast("string").alias("hub_id"))
    asks = events.filter(F.col("event_type") == "HUB_DEPARTED").select(
        cell("latitude", "longitude").alias("cell"), "event_timestamp", "event_id",
        F.lit(None).cast(seen.schema["v"].dataType).alias("v"), F.lit(1).alias("_asks"),
        "shipment_id", "hub_id")
    line = slice_line or Timeline(keys=("cell",), order=("event_timestamp", "_asks", "event_id"))
    found = with_last_seen(seen.unionByName(asks), line, F.col("v"), "last")
    fresh = elapsed(F.col("last")["seen_at"], F.col("event_timestamp"), "hours") <= within_hours
    return found.filter("_asks = 1").select(
        "event_id", "shipment_id", "hub_id", "event_timestamp",
        F.when(fresh, F.col("last")["vehicle_id"]).alias("vehicle_id"),
        F.when(fresh, F.col("last")["seen_at"]).alias("vehicle_seen_at"))


def e2e_journey(events: DataFrame, dwell: DataFrame) -> DataFrame:
    """Leg durations per shipment, the longest leg and the hub it waited at longest."""
    def first(kinds: tuple[str, ...]) -> Column:
        return F.min(F.when(F.col("event_type").isin(*kinds), F.col("event_timestamp")))

    rows = events.groupBy("shipment_id").agg(
        _last("seller_id", "customer_id", "origin_hub", "destination_hub", "event_type",
              "promised_delivery").alias("s"),
        F.min("event_timestamp").alias("start"), F.max("event_timestamp").alias("end"),
        first(("PICKED_UP",)).alias("pickup_timestamp"),
        first(("HUB_ARRIVED", "HUB_INSCAN", "HUB_SORTED", "HUB_OUTSCAN", "HUB_DEPARTED"))
        .alias("first_hub_timestamp"),
        first(C.LAST_MILE_EVENTS).alias("last_mile_timestamp"),
        first(("DELIVERED",)).alias("delivery_timestamp"),
        _hub_count().alias("total_hubs"),
        F.max("delivery_attempts").alias("delivery_attempts"))
    waits = dwell.groupBy("shipment_id").agg(
        F.sum("hub_dwell_hours").alias("total_hub_dwell_hours"),
        F.max_by("hub_id", F.struct("hub_dwell_hours", "hub_id")).alias("bottleneck_hub_id"))

    def leg(a: str, b: str) -> Column:
        hours = elapsed(F.col(a), F.col(b), "hours")
        return F.when(hours >= 0, hours)

    legs = {"FIRST_MILE": "first_mile_hours", "MID_MILE": "mid_mile_hours",
            "LAST_MILE": "last_mile_hours", "HUB_DWELL": "total_hub_dwell_hours"}
    joined = rows.join(waits, "shipment_id", "left").withColumns({
        "first_mile_hours": leg("pickup_timestamp", "first_hub_timestamp"),
        "mid_mile_hours": leg("first_hub_timestamp", "last_mile_timestamp"),
        "last_mile_hours": leg("last_mile_timestamp", "delivery_timestamp"),
    })
    longest = F.greatest(*[F.col(c) for c in legs.values()])
    promised = F.try_to_timestamp(F.col("s")["promised_delivery"].cast("string"))
    sla = _sla(F.col("s")["event_type"], F.col("end"), promised,
               ("DELIVERY_FAILED", *C.EXCEPTION_EVENTS))
    return joined.select(
        "shipment_id", *[F.col("s")[c].alias(c) for c in
                         ("seller_id", "customer_id", "origin_hub", "destination_hub")],
        "total_hubs", "pickup_timestamp", "first_hub_timestamp", "first_mile_hours",
        "mid_mile_hours", "total_hub_dwell_hours", "delivery_timestamp", "last_mile_hours",
        "delivery_attempts", elapsed(F.col("start"), F.col("end"), "hours")
        .alias("total_journey_hours"),
        *[c.alias(name) for name, c in sla.items()],
        F.col("s")["event_type"].alias("final_status"),
        labels.first_match((F.col(c) == longest, name) for name, c in legs.items())
        .alias("longest_leg"),
        longest.alias("longest_leg_hours"), "bottleneck_hub_id")
