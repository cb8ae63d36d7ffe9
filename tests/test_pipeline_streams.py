"""Daily run and streams: idempotence, restarts, late and broken rows."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from routeline.operators import alerting, fleet
from routeline.plans import daily
from routeline.plans.catalog import encoded
from routeline.sources import feeds, tables
from routeline.streaming import detect, ingest, status

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bronze_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    frames = {
        "vehicle_positions": feeds.vehicle_positions(spark, ROOT),
        "vehicle_telemetry": feeds.vehicle_telemetry(spark, ROOT),
        "alerts": feeds.alerts(spark, ROOT),
        "shipment_events": feeds.shipment_events(spark, ROOT),
        "agent_positions": feeds.agent_positions(spark, ROOT),
        "delivery_events": feeds.delivery_events(spark, ROOT),
    }
    for name, df in frames.items():
        # one bronze day; few silver days keep the number of folders small
        if name == "shipment_events":
            df = df.filter("event_timestamp between '1998-03-01' and '1998-03-05'")
        if name in ("agent_positions", "delivery_events"):
            df = df.filter("event_date between '1998-01-01' and '1998-04-01'")
        df = df.withColumn("event_date", F.lit("2024-01-01").cast("date")).withColumn(
            "is_valid_location", F.lit(True))
        df.coalesce(1).write.partitionBy("event_date").parquet(f"{root}/bronze/{name}")
    return root


def test_daily_run_twice_leaves_one_copy(spark, bronze_root):
    assert daily.processing_date("2024-01-02") == "2024-01-01"
    report = daily.run_daily(spark, bronze_root, "2024-01-01", "2024-01-02 00:00:00")
    row = report.first()
    assert row["total_checks"] == 31 and row["overall_success"]
    counts = {n: spark.read.parquet(f"{bronze_root}/{p}").count()
              for n, p in tables.SILVER_PATHS.items()}
    assert all(counts.values())
    daily.run_trips(spark, bronze_root, "2024-01-01")
    daily.run_journeys(spark, bronze_root, "2024-01-01")
    daily.run_shifts(spark, bronze_root, "2024-01-01")
    again = {n: spark.read.parquet(f"{bronze_root}/{p}").count()
             for n, p in tables.SILVER_PATHS.items()}
    assert counts == again
    tests = spark.read.parquet(f"{bronze_root}/quality/model_tests")
    assert tests.count() == 59
    assert [tuple(r) for r in tests.filter("failures > 0").collect()] == []
    gold = spark.read.parquet(f"{bronze_root}/gold/fct_trips")
    assert "dbt_loaded_at" in gold.columns
    assert len(os.listdir(f"{bronze_root}/quality/reports")) > 0


def test_dry_run_writes_nothing(spark, bronze_root, tmp_path):
    before = set(os.listdir(bronze_root))
    assert daily.run_trips(spark, bronze_root, "2024-01-01", write_output=False).count() > 0
    assert set(os.listdir(bronze_root)) == before
    none = daily.run_trips(spark, bronze_root, "1999-01-01", write_output=False)
    assert none.isEmpty() and "trip_id" in none.columns


def test_partition_filter_reaches_the_scan(spark, bronze_root):
    df = tables.read_bronze(spark, bronze_root, "vehicle_positions", "2024-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def lines(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def position(i, minute, **extra):
    ts = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    return {"event_id": f"e{i}", "vehicle_id": "V1", "timestamp": ts.isoformat(),
            "latitude": 20.0, "longitude": 77.0, "speed_kmh": 50.0, **extra}


def ingest_once(spark, folder, out, **kw):
    ingest.ingest(spark, "vehicle_positions", out, f"{out}/ck", fmt="text", path=folder,
                  available_now=True, **kw).awaitTermination()
    return spark.read.parquet(f"{out}/bronze/vehicle_positions")


def test_broken_rows_survive_and_restart_adds_nothing(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines(folder, "1.json", [position(1, 0), "{broken", position(2, 1, timestamp="soon"),
                             position(3, 2, latitude=51.5, speed_kmh=None)])
    df = ingest_once(spark, folder, out)
    assert df.count() == 4
    assert df.filter("event_id is null").count() == 1
    assert df.filter("event_id = 'e2'").first()["event_timestamp"] is None
    row = df.filter("event_id = 'e3'").first()
    assert row["is_valid_location"] is False and row["is_valid_speed"] is True
    assert ingest_once(spark, folder, out).count() == 4  # restart: nothing new
    lines(folder, "2.json", [position(4, 3)])
    assert ingest_once(spark, folder, out).count() == 5


def test_dedup_across_batches_and_late_rows(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines(folder, "1.json", [position(1, 0), position(1, 0), position(2, 500)])
    assert ingest_once(spark, folder, out, dedup_delay="1 hour").count() == 2
    # a repeat within the watermark and a row far behind it
    lines(folder, "2.json", [position(2, 500), position(3, 501), position(9, 10)])
    got = ingest_once(spark, folder, out, dedup_delay="1 hour")
    assert sorted(r["event_id"] for r in got.collect()) == ["e1", "e2", "e3"]


def test_batch_size_does_not_change_stream_results(spark, tmp_path):
    """One micro-batch and many give the batch answer, for driving events and geofences."""
    positions = feeds.vehicle_positions(spark, ROOT)
    fences = feeds.geofences(spark, ROOT)
    source = str(tmp_path / "src")
    positions.repartitionByRange(5, "event_timestamp").sortWithinPartitions("event_timestamp") \
        .write.parquet(source)
    schema = spark.read.parquet(source).schema
    files = sorted(f for f in os.listdir(source) if f.endswith(".parquet"))
    for age, name in enumerate(files):  # arrival order = time order
        os.utime(os.path.join(source, name), (1_700_000_000 + age, 1_700_000_000 + age))
    expected = sorted(map(tuple, fleet.detect_driving_events(positions).collect()))
    crossings = alerting.geofence_events(positions, fences)
    for per_batch in (1, 100):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch) \
            .parquet(source)
        out = str(tmp_path / f"driving{per_batch}")
        detect.stream_driving_events(stream, out, f"{out}/ck", True).awaitTermination()
        got = spark.read.parquet(f"{out}/events").drop("batch")
        assert sorted(map(tuple, got.collect())) == expected
        out = str(tmp_path / f"fence{per_batch}")
        detect.stream_geofence(stream, fences, out, f"{out}/ck", True).awaitTermination()
        got = detect.read_geofence_events(spark, out).select(*crossings.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, crossings.collect()))


def test_topic_selection(spark, tmp_path):
    for topic in ("alerts", "delivery_events"):
        folder = str(tmp_path / "topics" / topic)
        feed = feeds.alerts(spark, ROOT) if topic == "alerts" else feeds.delivery_events(spark, ROOT)
        encoded(feed, topic, "event_id").select("value").coalesce(1).write.text(folder)
    out = str(tmp_path / "lake")
    queries = ingest.run_streams(spark, out, f"{out}/ck", ("alerts", "delivery_events"),
                                 folder=str(tmp_path / "topics"), fmt="text", available_now=True)
    assert len(queries) == 2
    assert spark.read.parquet(f"{out}/bronze/alerts").count() == feeds.alerts(spark, ROOT).count()
    assert "is_valid_location" in spark.read.parquet(f"{out}/bronze/delivery_events").columns
    with pytest.raises(ValueError):
        ingest.run_streams(spark, out, out, ("nope",))
    ingest.stop_streams(spark)
    assert not spark.streams.active


def test_messages_are_json(spark):
    rows = detect.as_messages(alerting.delivery_failure_records(
        feeds.delivery_events(spark, ROOT))).limit(1).collect()
    assert json.loads(rows[0]["value"])["alert_type"] == "DELIVERY_FAILED"
