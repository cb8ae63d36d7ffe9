"""Queries over sources, sinks and runs: the given tables pass through a lake in the scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeline import contracts as C
from routeline.functions import geo
from routeline.operators import bronze, dims, fleet, quality, serving, shipments, staging
from routeline.plans import changes
from routeline.plans.catalog import encoded, query
from routeline.session import scratch_path
from routeline.sources import feeds, sinks, tables
from routeline.streaming import ingest

AS_OF = "2024-02-01 00:00:00"


# ---- ingest of every topic ------------------------------------------------------------------------

def _ingested(spark: SparkSession, topic: str, feed: DataFrame, key: str, by: tuple[str, ...] = ("event_date",)) -> DataFrame:
    """A topic's feed as JSON messages, through the ingest stream into a bronze table."""
    path = scratch_path(spark, topic)
    with ingest.open_writers(spark):
        ingest.write_stream(ingest.bronze_rows(encoded(feed, topic, key), topic), f"{path}/table", f"{path}/checkpoint",
                            partition_cols=by, available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/table")


@query
def ingest_vehicle_telemetry(spark, root):
    feed = feeds.vehicle_telemetry(spark, root, table=feeds.stream_table)
    return _ingested(spark, "vehicle_telemetry", feed, "vehicle_id").select(
        "event_id", "vehicle_id", "engine_rpm", "engine_temp_c", "event_date")


@query
def ingest_alerts(spark, root):
    feed = feeds.alerts(spark, root, table=feeds.stream_table)
    return _ingested(spark, "alerts", feed, "vehicle_id").select(
        "event_id", "vehicle_id", "event_type", "severity", "event_date")


@query
def ingest_shipment_events(spark, root):
    feed = feeds.shipment_events(spark, root, table=feeds.stream_table)
    # the scans span thousands of days, so this table is kept by type
    return _ingested(spark, "shipment_events", feed, "shipment_id", ("event_type",)).select(
        "event_id", "shipment_id", "event_type", "hub_id", "is_valid_location", "is_valid_event_type")


@query
def ingest_agent_positions(spark, root):
    feed = feeds.agent_positions(spark, root, table=feeds.stream_table)
    return _ingested(spark, "agent_positions", feed, "agent_id").select(
        "event_id", "agent_id", "is_valid_location", "event_date")


@query
def ingest_delivery_events(spark, root):
    feed = feeds.delivery_events(spark, root, table=feeds.stream_table)
    return _ingested(spark, "delivery_events", feed, "agent_id").select(
        "event_id", "agent_id", "event_type", "is_valid_location", "event_date")


@query
def ingest_selected_topics(spark, root):
    """Two topics started together from folders of messages, awaited, and counted."""
    path = scratch_path(spark, "topics")
    for topic, feed, key in (("alerts", feeds.alerts(spark, root), "vehicle_id"),
                             ("vehicle_positions", feeds.vehicle_positions(spark, root, clock="raw"), "vehicle_id")):
        encoded(feed, topic, key).select("value").write.text(f"{path}/in/{topic}")
    ingest.run_streams(spark, path, f"{path}/checkpoints", ("alerts", "vehicle_positions"), folder=f"{path}/in",
                       fmt="text", available_now=True)
    ingest.stop_streams(spark)
    counted = [tables.read_bronze(spark, path, t).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("event_date").alias("days")).select(
        F.lit(t).alias("topic"), "rows", "days") for t in ("alerts", "vehicle_positions")]
    return counted[0].unionByName(counted[1])


# ---- tables, views, sinks -------------------------------------------------------------------------

def _lake(spark: SparkSession, root: str) -> str:
    """Bronze alerts (one in ten late), and trips in two files of unlike columns."""
    path = scratch_path(spark, "lake")
    alerts = feeds.alerts(spark, root)
    late = F.pmod(F.crc32("event_id"), F.lit(10)) == 0
    for rows, layer in ((alerts.filter(~late), "bronze"), (alerts.filter(late), "bronze_late")):
        rows.write.partitionBy("event_date").parquet(f"{path}/{layer}/alerts")
    trips = fleet.reconstruct_trips(feeds.vehicle_positions(spark, root)).select(
        "trip_id", "vehicle_id", "trip_type", "position_count")
    sinks.write_silver(trips.withColumn("day", F.lit(1)), f"{path}/silver/fleet/trips", "day")
    trips.drop("trip_type").withColumns({"day": F.lit(2), "position_count": -F.col("position_count")}).write.mode(
        "append").partitionBy("day").parquet(f"{path}/silver/fleet/trips")
    return path


@query
def bronze_day(spark, root):
    """One day of bronze, late rows included, with the day before."""
    return tables.read_bronze(spark, _lake(spark, root), "alerts", "2024-01-15", 1).select(
        "event_id", "vehicle_id", "event_type", "event_date")


@query
def source_views(spark, root):
    """Every dataset of a lake as a view, columns matched by name."""
    names = tables.register_sources(spark, _lake(spark, root))
    assert names == ["alerts", "trips"]
    return spark.sql("""
        select 'alerts' as view, severity as kind, count(*) as rows, sum(cast(event_id as bigint)) as total
        from alerts group by severity
        union all
        select 'trips', trip_type, count(*), sum(position_count) from trips group by trip_type""")


@query
def chosen_root(spark, root):
    """Of two roots the one with more datasets is read."""
    full, poor = _lake(spark, root), scratch_path(spark, "poor")
    feeds.alerts(spark, root).filter("severity = 'HIGH'").write.partitionBy("event_date").parquet(f"{poor}/bronze/alerts")
    chosen = tables.resolve_root(spark, [poor, full])
    assert tables.data_root(spark, full, "sample") == "sample"  # in auto mode all core datasets are needed
    return tables.read_bronze(spark, chosen, "alerts").groupBy("severity").agg(F.count(F.lit(1)).alias("rows"))


@query
def shared_scan(spark, root):
    """Two figures of one scan, held for both and then released."""
    with tables.ScanCache(spark) as cache:
        path = f"{root}/events.parquet"
        kinds = cache.get(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).collect()
        most = cache.get(path).groupBy("event_type").agg(F.max("value").alias("highest")).collect()
    highest = {r["event_type"]: r["highest"] for r in most}  # as many rows as kinds of events
    return spark.createDataFrame([(r["event_type"], r["rows"], highest[r["event_type"]]) for r in kinds],
                                 "event_type string, rows long, highest double")


@query
def silver_rerun(spark, root):
    """Alerts written by day twice leave one copy."""
    path = scratch_path(spark, "silver")
    for _ in range(2):
        sinks.write_silver(feeds.alerts(spark, root), path, "event_date")
    return spark.read.parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("events"))


@query
def materialized_models(spark, root):
    """A staging view and a table built from it, read through their names."""
    path = scratch_path(spark, "models")
    sinks.materialize("lake_stg_alerts", staging.stg_alerts(feeds.alerts(spark, root)), "view")
    by_kind = spark.table("lake_stg_alerts").groupBy("alert_category", "alert_type").agg(
        F.count(F.lit(1)).alias("rows"), F.max("severity_score").alias("worst"))
    sinks.materialize("lake_alert_kinds", by_kind, "table", path, AS_OF)
    return spark.table("lake_alert_kinds").withColumnRenamed("dbt_loaded_at", "loaded_at")


@query
def dataset_manifest(spark, root):
    """Datasets written once, with the rows counted by the write."""
    return sinks.write_with_manifest({
        "alerts": feeds.alerts(spark, root), "shipment_events": feeds.shipment_events(spark, root),
        "trips": fleet.reconstruct_trips(feeds.vehicle_positions(spark, root)).select("trip_id", "vehicle_id"),
    }, scratch_path(spark, "manifest"))


@query
def latest_report(spark, root):
    """Two stored reports of the alerts' checks; the later one counts."""
    path = scratch_path(spark, "reports")
    alerts = feeds.alerts(spark, root)
    for share, day in ((alerts.filter("severity = 'HIGH'"), "2024-02-02 00:00:00"), (alerts, "2024-02-03 00:00:00")):
        checks = quality.run_table_checks_now(share, "alerts", [
            quality.row_count(), quality.unique("event_id"),
            quality.accepted_values("severity", ("HIGH",), 0.99), quality.not_null("vehicle_id")])
        report = quality.quality_report(checks, "bronze", day)
        sinks.write_report(report, path)
    return quality.latest_report(sinks.read_reports(spark, path, report.schema)).drop("checks")


@query
def missing_table_check(spark, root):
    suite = {"alerts": [quality.row_count(), quality.not_null("vehicle_id")], "orders_archive": [quality.row_count()]}
    return quality.run_suite(spark, suite, {"alerts": feeds.alerts(spark, root)}, now=True).select(
        "table", "check", "success", "total_rows", "error")


@query
def preview_view(spark, root):
    feeds.read_table(spark, root, "nation").createOrReplaceTempView("lake_nation")
    return serving.preview(spark, "lake_nation", n=25, allowed=("lake_nation",))


# ---- rows -----------------------------------------------------------------------------------------

@query
def backfilled_columns(spark, root):
    """Trips under the names their readers know, and stamped."""
    trips = fleet.reconstruct_trips(feeds.vehicle_positions(spark, root)).select(
        "trip_id", "vehicle_id", "total_distance_km", "trip_duration_minutes")
    return bronze.stamp(bronze.alias_columns(trips, bronze.TRIP_ALIASES), "reconstructed_at", AS_OF)


@query
def haversine_forms(spark, root):
    """Both forms of the distance from every point to a city."""
    points = feeds.vehicle_positions(spark, root, clock="raw", dirty=True)
    here, there = (F.col("latitude"), F.col("longitude")), (F.lit(28.5505), F.lit(77.2506))
    return points.select("event_id", geo.haversine_km(*here, *there, form="asin").alias("asin_km"),
                         geo.haversine_km(*here, *there).alias("atan2_km"))


@query
def scd2_customers(spark, root):
    """A customer dimension after a load in which some segments changed and some customers vanished."""
    key = F.col("c_custkey")
    rows = feeds.read_table(spark, root, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    old = rows.withColumns({"effective_from": F.lit("2024-01-01").cast("date"),
                            "effective_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    new = rows.filter(key % 11 != 0).withColumn(
        "c_mktsegment", F.when(key % 7 == 0, F.concat("c_mktsegment", F.lit("+"))).otherwise(F.col("c_mktsegment")))
    merged = dims.scd2_merge(old, new, "c_custkey", "2024-06-01")
    return dims.scd2_merge(merged, new, "c_custkey", "2024-07-01")  # the same load again changes nothing


@query
def correlated_vehicles(spark, root):
    """Hub departures, moved into the month of the vehicle points, and the vehicle last seen near each."""
    seconds = F.unix_micros("event_timestamp") / 1_000_000
    scans = feeds.shipment_events(spark, root).withColumn("event_timestamp", F.timestamp_seconds(
        F.lit(1_704_067_200) + F.pmod(seconds.cast("long") + F.crc32("event_id"), F.lit(30 * 86_400))))
    return shipments.correlate_vehicle(scans, feeds.vehicle_positions(spark, root, clock="raw"))


# ---- runs -----------------------------------------------------------------------------------------

@query
def changed_trips(spark, root):
    """Points in bronze, one in nine arriving late: two change-driven runs give the day's trips."""
    path = scratch_path(spark, "changes")
    points = feeds.vehicle_positions(spark, root)
    late = F.pmod(F.crc32("event_id"), F.lit(9)) == 0
    for rows, layer in ((points.filter(~late), "bronze"), (points.filter(late), "bronze_late")):
        rows.write.partitionBy("event_date").parquet(f"{path}/{layer}/vehicle_positions")
        changes.run_changes(spark, path, AS_OF)
    return changes.live_table(spark, path, "trips").read().drop("reconstructed_at")
