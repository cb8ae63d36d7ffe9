"""Points that arrive out of order over many micro-batches give the batch answer."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from routeline.operators import alerting, fleet
from routeline.sources import feeds
from routeline.streaming import detect

ROOT = "/root/testdata/sf0.001"


def in_files(spark, frames, folder):
    """One file per frame, to be read one per micro-batch in the given order."""
    os.makedirs(folder)
    for n, df in enumerate(frames):
        df.coalesce(1).write.parquet(f"{folder}-{n}")
        part = next(f for f in os.listdir(f"{folder}-{n}") if f.endswith(".parquet"))
        os.link(f"{folder}-{n}/{part}", f"{folder}/{n:03d}.parquet")
        os.utime(f"{folder}/{n:03d}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_a_point_between_two_known_ones(spark, tmp_path):
    base = feeds.vehicle_positions(spark, ROOT).limit(1)
    at = lambda s, speed: base.withColumns({
        "event_id": F.lit(f"p{s:02d}"), "vehicle_id": F.lit("V1"), "speed_kmh": F.lit(float(speed)),
        "event_timestamp": F.lit(dt.datetime(2024, 1, 1, 0, 0, s))})
    known = at(0, 70).unionByName(at(10, 10))
    stream = in_files(spark, [known, at(8, 70)], str(tmp_path / "src"))
    expected = rows(fleet.detect_driving_events(known.unionByName(at(8, 70))))
    assert any("HARSH_BRAKING" in r for r in expected)
    out = str(tmp_path / "out")
    detect.stream_driving_events(stream, out, f"{out}/ck", True).awaitTermination()
    assert rows(spark.read.parquet(f"{out}/events").drop("batch")) == expected


@pytest.mark.parametrize("lateness", ["1 hour", "3650 days"])
def test_shuffled_files(spark, tmp_path, lateness):
    """Some points later than the bound, and all points within it."""
    positions, fences = feeds.vehicle_positions(spark, ROOT).cache(), feeds.geofences(spark, ROOT)
    parts = [positions.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k) for k in range(4)]
    random.Random(5).shuffle(parts)
    stream = in_files(spark, parts, str(tmp_path / "src"))
    out = str(tmp_path / "driving")
    detect.stream_driving_events(stream, out, f"{out}/ck", True, lateness).awaitTermination()
    assert rows(spark.read.parquet(f"{out}/events").drop("batch")) == rows(
        fleet.detect_driving_events(positions))
    crossings = alerting.geofence_events(positions, fences)
    out = str(tmp_path / "fence")
    detect.stream_geofence(stream, fences, out, f"{out}/ck", True, lateness).awaitTermination()
    assert rows(detect.read_geofence_events(spark, out).select(*crossings.columns)) == rows(crossings)
