"""The change-driven run: what arrived since the last run decides what is computed anew.

1. **Arrivals.** Each bronze table and its late rows are read as a stream of files up to what is there. The
   stream's checkpoint is the ledger of files; a batch leaves the days it brought and, for scans, the parcels.
2. **Parcels** with new scans are rebuilt from all their scans, however many days those span: the days from the
   parcels' first one on are read, of which the stored journeys know the earliest.
3. **Days** with new rows are rebuilt from that day's rows, late ones included, and replace that day's partition
   of the trips, the shifts and the day facts.
4. **Checks** run over the days that changed and the tables that were written.
5. The run's place in the arrivals is published last. A run that dies before is done again by the next one, which
   finds the same arrivals; merges and replaced partitions make that harmless.

The tables are versioned (``sources.versions``), below ``root/live``: readers see the state before or after a
write. Trips of a day start at its midnight, as in a run for one day.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeline.contracts import CONTRACTS
from routeline.operators import delivery, dims, fleet, quality, shipments, staging
from routeline.operators.bronze import stamp
from routeline.plans import warehouse
from routeline.sources.tables import DATASET_PATHS, has_data, read_bronze
from routeline.sources.versions import NULL_PARTITION, KeyedTable, Versions

KEYS = {"shipment_events": "shipment_id"}
LAYERS = ("bronze", "bronze_late")

# table -> (key, partition); those with topics are rebuilt for every day on which a topic brought rows
LIVE = {
    "trips": (("trip_id",), "trip_date"),
    "journeys": (("shipment_id",), "journey_date"),
    "hub_dwell": (("shipment_id", "hub_id", "hub_name", "hub_city"), "arrival_date"),
    "agent_shifts": (("agent_id", "zone_id", "vehicle_type", "shift_date"), "shift_date"),
    "zone_performance": (("zone_id", "event_date"), "event_date"),
    "fct_shipments": (("shipment_id",), "date_key"),
    "fct_trips": (("trip_key",), "date_key"),
    "fct_driver_performance": (("performance_key",), "date_key"),
    "fct_hub_daily": (("hub_daily_key",), "date_key"),
    "fct_agent_daily": (("agent_daily_key",), "date_key"),
    "fct_zone_daily": (("zone_daily_key",), "date_key"),
}
DAY_FACTS = {
    "fct_trips": ("vehicle_positions",),
    "fct_driver_performance": ("vehicle_positions", "alerts"),
    "fct_hub_daily": ("shipment_events",),
    "fct_agent_daily": ("agent_positions", "delivery_events"),
    "fct_zone_daily": ("agent_positions", "delivery_events"),
}


def live_table(spark: SparkSession, root: str, name: str) -> KeyedTable:
    key, partition = LIVE[name]
    return KeyedTable(spark, f"{root}/live/{name}", key, partition)


@dataclass(frozen=True)
class Arrived:
    """What a topic brought since the last run: days as text, and the frame of keys where the topic has one."""

    days: frozenset[str]
    rows: DataFrame | None


def note_arrivals(spark: SparkSession, root: str, topic: str) -> None:
    """Write down the days and keys of bronze files not seen before."""
    columns = ["event_date", *([KEYS[topic]] if topic in KEYS else [])]
    for layer in LAYERS:
        path, place = f"{root}/{layer}/{topic}", f"{layer}-{topic}"
        if not has_data(spark, path):
            continue

        def store(batch: DataFrame, batch_id: int, place: str = place) -> None:
            batch.select(*columns).distinct().write.mode("overwrite").parquet(
                f"{root}/live/_arrived/{place}/batch={batch_id}")

        schema = spark.read.parquet(path).schema
        spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(store).option(
            "checkpointLocation", f"{root}/live/_files/{place}").trigger(availableNow=True).start().awaitTermination()


def arrivals(spark: SparkSession, root: str, topic: str, seen: dict[str, int]) -> tuple[Arrived, dict[str, int]]:
    """What came after the batches ``seen``, and the batches seen then."""
    parts, newest = [], {}
    for place in (f"{layer}-{topic}" for layer in LAYERS):
        path = f"{root}/live/_arrived/{place}"
        if has_data(spark, path):
            rows = spark.read.parquet(path).filter(F.col("batch") > seen.get(place, -1))
            last = rows.agg(F.max("batch")).first()[0]
            if last is not None:
                newest[place] = last
                parts.append(rows.drop("batch"))
    if not parts:
        return Arrived(frozenset(), None), newest
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # as many rows as there are days
    days = frozenset(r[0] for r in rows.select(
        F.coalesce(F.col("event_date").cast("string"), F.lit(NULL_PARTITION))).distinct().collect())
    return Arrived(days, rows), newest


def rows_of_days(spark: SparkSession, root: str, topic: str, days: Iterable[str]) -> DataFrame:
    """Bronze rows of some days, late ones included; the filter prunes partitions."""
    dated = sorted(d for d in days if d != NULL_PARTITION)
    wanted = F.col("event_date").isin(*[F.lit(d).cast("date") for d in dated]) if dated else F.lit(False)
    if NULL_PARTITION in days:
        wanted = wanted | F.col("event_date").isNull()
    return read_bronze(spark, root, topic).filter(wanted)


def scans_of_changed_parcels(spark: SparkSession, root: str, arrived: Arrived) -> DataFrame:
    """All scans of the parcels with new ones, read from their first day on."""
    keys = arrived.rows.select("shipment_id").distinct()
    first = min((d for d in arrived.days if d != NULL_PARTITION), default=None)
    stored = live_table(spark, root, "journeys").read()
    if stored is not None:
        known = stored.select("shipment_id", "journey_start_time").join(keys, "shipment_id", "left_semi").agg(
            F.min(F.to_date("journey_start_time")).cast("string")).first()[0]
        first = min((d for d in (first, known) if d), default=None)
    scans = read_bronze(spark, root, "shipment_events")
    if first:
        scans = scans.filter((F.col("event_date") >= F.lit(first).cast("date")) | F.col("event_date").isNull())
    return scans.join(keys, scans["shipment_id"].eqNullSafe(keys["shipment_id"]), "left_semi")


def rebuild_parcels(spark: SparkSession, root: str, arrived: Arrived, as_of: str | None) -> list[str]:
    scans = scans_of_changed_parcels(spark, root, arrived)
    journeys, dwell = shipments.reconstruct_journeys(scans)
    facts = shipments.fct_shipments(
        shipments.int_shipment_journeys(staging.stg_shipment_events(scans)), dims.dim_hubs(spark))
    for name, rows in (("hub_dwell", dwell.withColumn("arrival_date", F.to_date("hub_arrival_time"))),
                       ("fct_shipments", facts), ("journeys", stamp(journeys, "reconstructed_at", as_of))):
        live_table(spark, root, name).merge(rows)
    return ["hub_dwell", "fct_shipments", "journeys"]


def rebuild_day(spark: SparkSession, root: str, day: str, topics: set[str], as_of: str | None) -> list[str]:
    """Replace ``day`` in the tables that depend on the topics with new rows."""
    have = [t for t in CONTRACTS if has_data(spark, f"{root}/bronze/{t}")]
    rows = {t: rows_of_days(spark, root, t, [day]) for t in have}
    written = []

    def put(name: str, df: DataFrame) -> None:
        live_table(spark, root, name).replace(df, [day])
        written.append(name)

    if "vehicle_positions" in topics:
        trips = fleet.reconstruct_trips(rows["vehicle_positions"])
        put("trips", stamp(trips, "reconstructed_at", as_of))
    if topics & {"agent_positions", "delivery_events"} and {"agent_positions", "delivery_events"} <= set(have):
        shifts = stamp(delivery.agent_shifts(rows["agent_positions"], rows["delivery_events"]), "aggregated_at", as_of)
        put("agent_shifts", shifts)
        put("zone_performance", delivery.zone_performance(
            live_table(spark, root, "agent_shifts").read(lambda p: p == day)))
    models = warehouse.build_models(spark, rows)
    for name, needs in DAY_FACTS.items():
        if topics & set(needs) and name in models:
            put(name, models[name])
    return written


def run_changes(spark: SparkSession, root: str, as_of: str | None = None) -> DataFrame | None:
    """Bring the live tables up to date with bronze; the stored quality report, None if nothing arrived."""
    ledger = Versions(spark, f"{root}/live/_ledger")
    state = ledger.load() or {"version": -1, "seen": {}}
    seen, changed = dict(state["seen"]), {}
    for topic in CONTRACTS:
        note_arrivals(spark, root, topic)
        arrived, newest = arrivals(spark, root, topic, state["seen"])
        seen |= newest
        if arrived.rows is not None:
            changed[topic] = arrived
    if not changed:
        return None
    written = set()
    if "shipment_events" in changed:
        written |= set(rebuild_parcels(spark, root, changed["shipment_events"], as_of))
    for day in sorted({d for a in changed.values() for d in a.days} - {NULL_PARTITION}):
        topics = {t for t, a in changed.items() if day in a.days}
        written |= set(rebuild_day(spark, root, day, topics, as_of))
    report = f"{root}/live/_reports/run={state['version'] + 1}"
    check_changes(spark, root, changed, written, as_of).write.mode("overwrite").parquet(report)
    ledger.publish({"version": state["version"] + 1, "seen": seen})
    return spark.read.parquet(report)


def check_changes(spark: SparkSession, root: str, changed: dict[str, Arrived], written: set[str],
                  as_of: str | None) -> DataFrame:
    """The quality report over the changed days of bronze and the tables written."""
    tables = {t: rows_of_days(spark, root, t, a.days) for t, a in changed.items()}
    tables |= {n: live_table(spark, root, n).read() for n in written if n in DATASET_PATHS}
    suites = {**quality.BRONZE_SUITE, **quality.SILVER_SUITE}
    checks = quality.run_suite(spark, {n: c for n, c in suites.items() if n in tables}, tables, now=True)
    return quality.quality_report(checks, "all", as_of)
