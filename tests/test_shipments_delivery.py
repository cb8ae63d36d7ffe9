"""Hand-made cases for journeys, dwell, shifts, stops and dimensions."""

import datetime as dt

from pyspark.sql import functions as F

from routeline.operators import delivery, dims, shipments
from routeline.sources import feeds

ROOT = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 5, 1)


def scans(spark, spec):
    """spec: (shipment, hours, type, hub[, promise hours[, reason]])"""
    rows = []
    for i, (ship, hours, kind, hub, *rest) in enumerate(spec):
        promise = (T0 + dt.timedelta(hours=rest[0] if rest else 48)).isoformat()
        ts = T0 + dt.timedelta(hours=hours)
        rows.append((f"e{i:03d}", ship, "A" + ship, kind, hub, hub, hub, 20.0, 77.0, "S", "C",
                     "HUB_DEL_01", "HUB_MUM_01", True, 10.0, promise, 2, 1,
                     rest[1] if len(rest) > 1 else None, "w", "s", ts, ts.date()))
    return spark.createDataFrame(rows, (
        "event_id string, shipment_id string, awb_number string, event_type string, "
        "hub_id string, hub_name string, hub_city string, latitude double, longitude double, "
        "seller_id string, customer_id string, origin_hub string, destination_hub string, "
        "is_cod boolean, cod_amount double, promised_delivery string, route_hops int, "
        "delivery_attempts int, failure_reason string, worker_id string, scanner_id string, "
        "event_timestamp timestamp, event_date date"))


def test_delivered_exactly_at_the_promise_is_met(spark):
    got = {r["shipment_id"]: r for r in shipments.journeys(scans(spark, [
        ("a", 0, "CREATED", "h1", 48), ("a", 48, "DELIVERED", "h2", 48),
        ("b", 0, "CREATED", "h1", 48), ("b", 48.01, "DELIVERED", "h2", 48),
    ])).collect()}
    assert got["a"]["sla_status"] == "MET" and got["b"]["sla_status"] == "BREACHED"
    assert got["a"]["sla_variance_hours"] == 0.0


def test_last_event_is_chronological_and_keeps_a_null_reason(spark):
    row = shipments.journeys(scans(spark, [
        ("a", 0, "PICKUP_SCHEDULED", "h1"),
        ("a", 5, "DELIVERY_FAILED", "h1", 48, "WRONG_ADDRESS"),
        ("a", 6, "DELIVERED", "h1"),
    ])).first()
    assert (row["last_event"], row["last_failure_reason"]) == ("DELIVERED", None)


def test_changed_promise_does_not_split_a_journey(spark):
    rows = shipments.journeys(scans(spark, [
        ("a", 0, "CREATED", "h1", 24), ("a", 30, "DELIVERED", "h1", 36)])).collect()
    assert len(rows) == 1 and rows[0]["sla_status"] == "MET"
    risk = shipments.journeys_risk_view(scans(spark, [
        ("a", 0, "CREATED", "h1", 24), ("a", 30, "DELIVERED", "h1", 36)])).first()
    assert risk["sla_status"] == "BREACHED"  # judged by the first promise


def test_stuck_threshold_zero_is_not_the_default(spark):
    df = scans(spark, [("a", 0, "CREATED", "h"), ("a", 1, "PICKED_UP", "h"),
                       ("a", 40, "HUB_ARRIVED", "h"), ("a", 90, "DELIVERED", "h")])
    assert shipments.stuck_shipments(df).count() == 1
    assert shipments.stuck_shipments(df, hours=0).count() == 2


def test_hub_dwell_lists_scans(spark):
    row = shipments.hub_dwell(scans(spark, [
        ("a", 0, "HUB_ARRIVED", "h"), ("a", 1, "HUB_INSCAN", "h"), ("a", 2, "HUB_INSCAN", "h"),
        ("a", 13, "HUB_DEPARTED", "h"), ("a", 14, "IN_TRANSIT", "h")])).first()
    assert row["hub_events"] == ["HUB_ARRIVED", "HUB_INSCAN", "HUB_INSCAN", "HUB_DEPARTED"]
    assert (row["hub_event_count"], row["hub_dwell_hours"], row["is_bottleneck"]) == (4, 13, True)


def test_status_ignores_arrival_order(spark):
    df = scans(spark, [("a", 9, "DELIVERED", "h2"), ("a", 1, "CREATED", "h1")])
    status = shipments.current_status(df)
    assert status.first()["current_status"] == "DELIVERED"
    assert shipments.stuck_alerts(status, "2024-06-01 00:00:00").count() == 0


def test_transition_rules(spark):
    got = shipments.validate_sequence(scans(spark, [
        ("a", 0, "CREATED", "h"), ("a", 1, "PICKED_UP", "h"), ("a", 2, "DELIVERED", "h"),
        ("a", 3, "LOST", "h"), ("b", 0, "HUB_ARRIVED", "h")])).orderBy("event_id").collect()
    assert [r["is_valid_transition"] for r in got] == [True, True, False, False, False]


def test_hops_on_a_delivery_date(spark):
    df = scans(spark, [("a", 0, "HUB_ARRIVED", "h1"), ("a", 13, "HUB_ARRIVED", "h2"),
                       ("a", 20, "DELIVERED", "h2"), ("b", 0, "HUB_ARRIVED", "h1")])
    got = shipments.hub_hops(df, "2024-05-01").orderBy("hop_sequence").collect()
    assert [(r["hop_sequence"], r["dwell_time_hours"], r["is_bottleneck"]) for r in got] == [
        (1, 13.0, True), (2, None, None)]
    assert shipments.hub_hops(df, "2024-05-02").count() == 0


def test_vehicle_correlation_is_an_as_of_lookup(spark):
    events = scans(spark, [("a", 5, "HUB_DEPARTED", "h"), ("b", 30, "HUB_DEPARTED", "h")])
    pos = spark.createDataFrame(
        [("p1", "V1", T0 + dt.timedelta(hours=3), 20.1, 77.1),
         ("p2", "V2", T0 + dt.timedelta(hours=4), 20.2, 77.2),
         ("p3", "V3", T0 + dt.timedelta(hours=6), 20.2, 77.2),
         ("p4", "V4", T0 + dt.timedelta(hours=5), 30.0, 77.2)],
        "event_id string, vehicle_id string, event_timestamp timestamp, latitude double, "
        "longitude double")
    got = shipments.correlate_vehicle(events, pos).orderBy("shipment_id").collect()
    assert [r["vehicle_id"] for r in got] == ["V2", None]  # V3 was seen a day before b left


def test_agents_and_deliveries_join_from_the_positions(spark):
    pos = feeds.agent_positions(spark, ROOT)
    deliv = feeds.delivery_events(spark, ROOT)
    some = deliv.filter("agent_id <> 'AGT_0001'")
    shifts = delivery.agent_shifts(pos.filter("agent_id <> 'AGT_0002'"), some)
    agents = {r["agent_id"]: r["n"] for r in shifts.groupBy("agent_id").agg(
        F.count("successful_deliveries").alias("n")).collect()}
    assert agents["AGT_0001"] == 0 and "AGT_0002" not in agents


def test_agent_in_two_zones_gets_two_keys(spark):
    pos = feeds.agent_positions(spark, ROOT)
    both = pos.unionByName(pos.withColumn("zone_id", F.lit("ZONE_X")).withColumn(
        "event_id", F.concat("event_id", F.lit("x"))))
    from routeline.operators import staging
    facts = delivery.fct_agent_daily(delivery.int_agent_shifts(
        staging.stg_agent_positions(both),
        staging.stg_delivery_events(feeds.delivery_events(spark, ROOT))))
    assert facts.count() == facts.select("agent_daily_key").distinct().count()
    assert facts.filter("zone_id = 'ZONE_X'").count() > 0


def test_tier_limits(spark):
    pos = feeds.agent_positions(spark, ROOT)
    row = pos.orderBy("event_id").first()
    pos = pos.filter(F.col("event_id") == row["event_id"])
    wins = [(f"d{i}", row["agent_id"], row["event_timestamp"], row["event_date"], "DELIVERED")
            for i in range(50)]
    deliv = spark.createDataFrame(wins, "event_id string, agent_id string, "
                                  "event_timestamp timestamp, event_date date, "
                                  "event_type string").withColumns({
        "agent_name": F.lit("x"), "order_id": F.lit("o"), "shipment_id": F.lit("s"),
        "customer_id": F.lit("c"), "delivery_address": F.lit("a"), "zone_id": F.lit("z"),
        "delivery_lat": F.lit(1.0), "delivery_lng": F.lit(1.0), "is_cod": F.lit(True),
        "cod_amount": F.lit(1.0), "cod_collected": F.lit(1.0), "payment_mode": F.lit("CASH"),
        "attempt_number": F.lit(1), "failure_reason": F.lit(None).cast("string"),
        "pod_type": F.lit("OTP"), "customer_rating": F.lit(5),
        "time_at_location_seconds": F.lit(60)})
    from routeline.operators import staging
    got = delivery.int_agent_shifts(staging.stg_agent_positions(pos),
                                    staging.stg_delivery_events(deliv)).first()
    assert got["performance_tier"] == "TOP_PERFORMER" and got["deliveries_per_hour"] == 0.0


def test_zone_ties_rank_by_id(spark):
    day = dt.date(2024, 1, 1)
    shifts = spark.createDataFrame(
        [("a", "Z2", day, 5, 0, 1.0, 1.0, 1.0, 0.0, None),
         ("b", "Z1", day, 5, 0, 1.0, 1.0, 1.0, 0.0, None)],
        "agent_id string, zone_id string, event_date date, successful_deliveries long, "
        "final_failures long, delivery_success_rate double, deliveries_per_hour double, "
        "total_distance_km double, total_cod_collected double, avg_customer_rating double")
    got = {r["zone_id"]: r["zone_performance_rank"]
           for r in delivery.zone_performance(shifts).collect()}
    assert got == {"Z1": 1, "Z2": 2}


def test_dimensions(spark):
    hubs = dims.dim_hubs(spark)
    assert hubs.count() == 10 and hubs.filter("hub_tier = 2").count() == 4
    days = dims.dim_time(spark)
    assert days.count() == 1096
    row = days.filter("date_key = '2024-02-29'").first()
    assert (row["year_quarter"], row["fiscal_year"], row["fiscal_month"], row["is_weekday"]) == (
        "2024-Q1", 2023, 11, True)
    hours = dims.dim_time_hourly(spark, "2024-01-01", "2024-01-02")
    assert hours.count() == 48 and hours.filter("is_business_hour").count() == 18


def test_scd2_merge_and_its_repetition(spark):
    old = spark.createDataFrame(
        [("h1", "MEGA", dt.date(2024, 1, 1), None, True),
         ("h2", "LOCAL", dt.date(2024, 1, 1), None, True),
         ("h3", "LOCAL", dt.date(2024, 1, 1), None, True),
         ("h1", "LOCAL", dt.date(2023, 1, 1), dt.date(2024, 1, 1), False)],
        "hub_id string, kind string, effective_from date, effective_to date, is_current boolean")
    new = spark.createDataFrame([("h1", "MEGA"), ("h2", "MEGA"), ("h4", None)],
                                "hub_id string, kind string")
    merged = dims.scd2_merge(old, new, "hub_id", "2024-06-01")
    live = {r["hub_id"]: (r["kind"], str(r["effective_from"]))
            for r in merged.filter("is_current").collect()}
    assert live == {"h1": ("MEGA", "2024-01-01"), "h2": ("MEGA", "2024-06-01"),
                    "h4": (None, "2024-06-01")}
    assert merged.filter("not is_current").count() == 3
    again = dims.scd2_merge(merged, new, "hub_id", "2024-07-01")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, merged.collect()))


def test_scd2_history_folds_repeats(spark):
    rows = [("k", d, v) for d, v in ((1, "a"), (2, "a"), (3, "b"), (4, "a"))]
    log = spark.createDataFrame(rows, "k string, d int, v string")
    got = dims.scd2_history(log, "k", "d", ["v"]).orderBy("effective_from").collect()
    assert [(r["v"], r["effective_from"], r["effective_to"]) for r in got] == [
        ("a", 1, 3), ("b", 3, 4), ("a", 4, None)]


def test_stop_matching_needs_proximity(spark):
    stops = spark.createDataFrame(
        [("A", T0, 20.0, 77.0, "A:1", 120.0)], "agent_id string, stop_start timestamp, "
        "latitude double, longitude double, stop_id string, stop_seconds double")
    deliv = spark.createDataFrame(
        [("A", T0 + dt.timedelta(minutes=1), "d1", "o1", 20.0002, 77.0),
         ("A", T0 + dt.timedelta(minutes=2), "d2", "o2", 20.01, 77.0),
         ("A", T0 - dt.timedelta(minutes=2), "d3", "o3", 20.0, 77.0)],
        "agent_id string, event_timestamp timestamp, event_id string, order_id string, "
        "delivery_lat double, delivery_lng double")
    got = {r["event_id"]: r["stop_id"] for r in delivery.match_stops(stops, deliv).collect()}
    assert got == {"d1": "A:1", "d2": None, "d3": None}


def test_first_reason_list_is_sorted_and_complete(spark):
    day = spark.createDataFrame(
        [("A", T0, r) for r in ("B", "A", "B", None)],
        "agent_id string, event_timestamp timestamp, failure_reason string")
    assert delivery.failure_reason_lists(day).first()["failure_reasons"] == ["A", "B", "B"]


def test_reasons_are_spelled_out_after_the_joins_and_ranks(spark):
    """Lists of failure reasons grow with a day; sorts and exchanges of shifts carry counts."""
    root = "/root/testdata/sf0.001"
    positions, deliveries = feeds.agent_positions(spark, root), feeds.delivery_events(spark, root)
    shifts = delivery.agent_shifts(positions, deliveries)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = shifts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    spelled = [i for i, line in enumerate(plan) if "array_repeat" in line]
    windows = [i for i, line in enumerate(plan) if "Window [" in line]
    assert spelled == [0] and windows and min(windows) > 0
    want = {(r.agent_id, r.event_date): r.failure_reasons
            for r in delivery.failure_reason_lists(deliveries).collect()}
    got = shifts.select("agent_id", "event_date", "failure_reasons").collect()
    assert all(r.failure_reasons == want.get((r.agent_id, r.event_date)) for r in got) and want
