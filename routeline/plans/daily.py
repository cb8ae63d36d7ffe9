"""The daily run: bronze day -> silver entities -> warehouse -> tests and quality report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeline.operators import delivery, fleet, quality, shipments
from routeline.operators.bronze import stamp
from routeline.plans import warehouse
from routeline.sources import sinks
from routeline.sources.tables import BRONZE_PATHS, DATASET_PATHS, has_data, read_bronze, \
    read_parquet_tree
from routeline.sources.versions import NULL_PARTITION, KeyedTable


def processing_date(run_date: str) -> str:
    """A run handles the day before it."""
    return (dt.date.fromisoformat(run_date) - dt.timedelta(days=1)).isoformat()


def run_trips(spark: SparkSession, root: str, date: str | None = None, lookback_days: int = 0,
              write_output: bool = True, as_of: str | None = None) -> DataFrame:
    """Trips of a day. With a look-back, points of earlier days let a trip that crosses midnight
    keep its true start; only trips of ``date`` are returned."""
    trips = fleet.reconstruct_trips(read_bronze(spark, root, "vehicle_positions", date,
                                                lookback_days))
    if date and lookback_days:
        trips = trips.filter(F.col("trip_date") == F.lit(date).cast("date"))
    trips = stamp(trips, "reconstructed_at", as_of)
    if write_output:
        sinks.write_silver(trips, f"{root}/{DATASET_PATHS['trips']}", "trip_date")
    return trips


def run_journeys(spark: SparkSession, root: str, date: str | None = None,
                 write_output: bool = True, as_of: str | None = None
                 ) -> tuple[DataFrame, DataFrame]:
    events = read_bronze(spark, root, "shipment_events", date)
    journeys, dwell = shipments.reconstruct_journeys(events)
    journeys = stamp(journeys, "reconstructed_at", as_of)
    dwell = dwell.withColumn("arrival_date", F.to_date("hub_arrival_time"))
    if write_output:
        sinks.write_silver(journeys, f"{root}/{DATASET_PATHS['journeys']}", "journey_date")
        sinks.write_silver(dwell, f"{root}/silver/shipment/hub_dwell", "arrival_date")
    return journeys, dwell


def run_shifts(spark: SparkSession, root: str, date: str | None = None,
               write_output: bool = True, as_of: str | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """Shifts and zones of a day. The zones are computed from the stored shifts."""
    shifts = stamp(delivery.agent_shifts(read_bronze(spark, root, "agent_positions", date),
                                         read_bronze(spark, root, "delivery_events", date)),
                   "aggregated_at", as_of)
    if not write_output:
        return shifts, delivery.zone_performance(shifts)
    path = f"{root}/{DATASET_PATHS['agent_shifts']}"
    sinks.write_silver(shifts, path, "shift_date")
    stored = read_parquet_tree(spark, path)
    if date:
        stored = stored.filter(F.col("shift_date") == F.lit(date).cast("date"))
    zones = delivery.zone_performance(stored)
    sinks.write_silver(zones, f"{root}/{DATASET_PATHS['zone_performance']}", "event_date")
    return stored, zones


def sla_table(spark: SparkSession, path: str) -> KeyedTable:
    """Service levels, one row per shipment, in files of the month of creation."""
    return KeyedTable(spark, path, ("shipment_id",), "created_month")


def merge_sla(table: KeyedTable, events: DataFrame, definitions: DataFrame, lookback_days: int = 3) -> dict:
    """Merge the shipments created since ``lookback_days`` before the newest one in the table; all at first.

    A shipment whose row stays the same is not written, nor is a month without changes.
    """
    since, months = None, [p for p in table.partitions() if p != NULL_PARTITION]
    if months:
        since = table.read(lambda p: p == max(months)).agg(
            F.date_sub(F.max("created_date"), lookback_days).cast("string")).first()[0]
    rows = shipments.sla_tracking(events, definitions, since)
    return table.merge(rows.withColumn("created_month", F.trunc("created_date", "month")))


def run_daily(spark: SparkSession, root: str, date: str | None = None,
              as_of: str | None = None) -> DataFrame:
    """One day end to end; returns the quality report, which is also stored. Rerunning a day
    replaces its partitions. The caller decides what a failed report means."""
    run_trips(spark, root, date, as_of=as_of)
    run_journeys(spark, root, date, as_of=as_of)
    run_shifts(spark, root, date, as_of=as_of)
    bronze = {t: read_bronze(spark, root, t) for t, p in BRONZE_PATHS.items()
              if has_data(spark, f"{root}/{p}")}
    models = warehouse.publish(spark, bronze, f"{root}/gold", as_of)
    results = f"{root}/quality/model_tests"
    quality.run_model_tests(models).write.mode("overwrite").parquet(results)
    quality.store_failing_rows(models, spark.read.parquet(results), f"{root}/quality/failing_rows")
    tables = {name: read_bronze(spark, root, name) if name in BRONZE_PATHS else read_parquet_tree(spark, f"{root}/{path}")
              for name, path in DATASET_PATHS.items() if has_data(spark, f"{root}/{path}")}
    checks = quality.run_checks(spark, "all", tables, now=True)
    report = quality.quality_report(checks, "all", as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
    sinks.write_report(report, f"{root}/quality/reports")
    return report
