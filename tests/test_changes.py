"""The change-driven run: parcels over several days, late rows, reruns, pruned scans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from routeline.operators import shipments
from routeline.plans import changes
from routeline.sources import feeds
from routeline.sources.tables import read_bronze

ROOT = "/root/testdata/sf0.001"
AS_OF = "2024-02-01 00:00:00"
DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def put(df, root, topic, layer="bronze"):
    df.withColumn("event_date", F.to_date("event_timestamp")).coalesce(1).write.mode("append").partitionBy(
        "event_date").parquet(f"{root}/{layer}/{topic}")


@pytest.fixture(scope="module")
def days(spark):
    """Scans of fifty parcels spread over three days, and vehicle points of one day."""
    picked = F.col("shipment_id") < "SHP_00000050"
    number = F.pmod(F.crc32("event_id"), F.lit(3))
    scans = feeds.shipment_events(spark, ROOT).filter(picked).withColumn(
        "event_timestamp", F.timestamp_micros(F.unix_micros(F.lit("2024-01-01 08:00:00").cast("timestamp"))
                                              + number * 86_400_000_000 + F.pmod(F.crc32(F.reverse("event_id")), F.lit(10_000)) * 1_000_000))
    return scans.withColumn("event_date", F.to_date("event_timestamp")).cache(), feeds.vehicle_positions(spark, ROOT).cache()


def test_three_days_and_a_late_row(spark, tmp_path, days):
    root, (scans, points) = str(tmp_path), days
    put(points, root, "vehicle_positions")
    late = scans.filter("event_date = '2024-01-01'").orderBy("event_id").limit(1).cache()
    on_time = scans.join(late, "event_id", "left_anti").select(*scans.columns)
    live = lambda name: changes.live_table(spark, root, name)
    for n, day in enumerate(DAYS):
        put(on_time.filter(F.col("event_date") == F.lit(day)), root, "shipment_events")
        report = changes.run_changes(spark, root, AS_OF).first()
        assert report["failed"] == 0 and live("journeys").versions.load()["version"] == n
    # one journey a parcel, whatever days it took
    want = shipments.journeys(on_time)
    got = live("journeys").read().select(*want.columns)
    assert rows(got) == rows(want) and got.filter("datediff(journey_end_time, journey_start_time) = 2").count() > 20
    assert live("trips").read().count() > 0 and live("trips").versions.load()["version"] == 0
    # nothing new: nothing done
    assert changes.run_changes(spark, root, AS_OF) is None
    # a late row of the first day reaches silver, gold and checks; other days keep their files
    before = {n: live(n).versions.load()["folders"] for n in ("fct_hub_daily", "trips")}
    put(late, root, "shipment_events", "bronze_late")
    report = changes.run_changes(spark, root, AS_OF).first()
    assert {c["total_rows"] for c in report["checks"] if c["table"] == "shipment_events"} == {
        scans.filter("event_date = '2024-01-01'").count()}
    assert rows(live("journeys").read().select(*want.columns)) == rows(shipments.journeys(scans))
    hub = late.first()["hub_id"]
    after = live("fct_hub_daily").versions.load()["folders"]
    assert {d for d in after if after[d] != before["fct_hub_daily"].get(d)} == {"2024-01-01"}
    assert live("trips").versions.load()["folders"] == before["trips"]
    if hub:
        events = live("fct_hub_daily").read().filter((F.col("hub_id") == hub) & (F.col("date_key") == F.lit(DAYS[0])))
        assert events.first()["total_events"] == scans.filter((F.col("hub_id") == hub) & (F.col("event_date") == F.lit(DAYS[0]))).count()
    facts = live("fct_shipments").read()
    assert facts.count() == scans.select("shipment_id").distinct().count()


def test_a_run_that_died_is_done_again(spark, tmp_path, days, monkeypatch):
    root, (scans, _) = str(tmp_path), days
    put(scans, root, "shipment_events")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(changes, "check_changes", die)
        with pytest.raises(RuntimeError):
            changes.run_changes(spark, root, AS_OF)
    report = changes.run_changes(spark, root, AS_OF)
    assert report.first()["failed"] == 0
    journeys = changes.live_table(spark, root, "journeys")
    assert journeys.versions.load()["version"] == 0  # the second run found the rows as they are
    assert journeys.read().count() == scans.select("shipment_id").distinct().count()


def test_scans_are_pruned(spark, tmp_path, days):
    root, (scans, _) = str(tmp_path), days
    put(scans, root, "shipment_events")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    one = changes.rows_of_days(spark, root, "shipment_events", ["2024-01-02"])
    assert "PartitionFilters: [isnotnull(event_date" in plan(one) or "PartitionFilters: [(event_date" in plan(one)
    arrived = changes.Arrived(frozenset(["2024-01-03"]), scans.filter("event_date = '2024-01-03'"))
    assert "PartitionFilters: [((event_date" in plan(changes.scans_of_changed_parcels(spark, root, arrived))
    assert read_bronze(spark, root, "shipment_events").count() == scans.count()
