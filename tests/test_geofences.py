"""Geofences of any size and number against a plain walk along every vehicle."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from routeline.operators import alerting
from routeline.operators.timeline import Timeline

T0 = dt.datetime(2024, 1, 1)
POINTS = "event_id string, vehicle_id string, event_timestamp timestamp, latitude double, longitude double"
FENCES = "geofence_id string, geofence_type string, center_lat double, center_lng double, radius_km double"


def km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def walked(points, fences):
    out = []
    for vehicle in {p[1] for p in points}:
        was, since = set(), {}
        line = sorted((p for p in points if p[1] == vehicle and p[3] is not None), key=lambda p: (p[2], p[0]))
        for e, _, at, lat, lng in line:
            now = {f[:2] for f in fences if km(lat, lng, f[2], f[3]) <= f[4]}
            for fence in now - was:
                since[fence] = at
                out.append((e, vehicle, *fence, "ENTRY", at, None))
            for fence in was - now:
                out.append((e, vehicle, *fence, "EXIT", at, (at - since[fence]).total_seconds()))
            was = now
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(
        "event_id", "vehicle_id", "geofence_id", "geofence_type", "event_type", "event_timestamp",
        "dwell_time_seconds").collect()), key=repr)


def test_small_and_continental_fences(spark):
    rnd = random.Random(3)
    points, place = [], {v: [20.0, 77.0] for v in ("a", "b", None)}
    for i in range(600):
        v = rnd.choice(["a", "a", "b", None])
        place[v] = [x + rnd.uniform(-0.4, 0.4) for x in place[v]]
        points.append((f"e{i:04d}", v, T0 + dt.timedelta(minutes=i), *(place[v] if i % 40 else (None, None))))
    fences = [("big", "CITY", 20.5, 77.5, 500.0), ("mid", "HUB", 20.0, 77.0, 60.0), ("polar", "HUB", 84.0, 10.0, 300.0),
              *[(f"f{i}", "TOLL", 20 + rnd.uniform(-2, 2), 77 + rnd.uniform(-2, 2), rnd.choice([0.2, 5.0, 30.0]))
                for i in range(80)]]
    p, f = spark.createDataFrame(points, POINTS), spark.createDataFrame(fences, FENCES)
    want = walked(points, fences)
    assert len(want) > 50 and any(r[2] == "big" for r in want)
    for slices in (1, 20):
        assert found(alerting.geofence_events(p, f, Timeline(("vehicle_id",), slices=slices))) == want
    assert alerting.geofence_events(p, f.limit(0)).count() == alerting.geofence_events(p.limit(0), f).count() == 0


def test_ten_thousand_fences_in_one_cell(spark):
    fences = spark.range(10_000).select(
        F.format_string("f%05d", "id").alias("geofence_id"), F.lit("HUB").alias("geofence_type"),
        (F.lit(20.001) + F.col("id") * 1e-7).alias("center_lat"), F.lit(77.001).alias("center_lng"), F.lit(0.05).alias("radius_km"))
    cells = alerting.fence_cells(fences)
    assert cells.count() <= 40_000 and "collect_list" not in cells._jdf.queryExecution().toString()
    points = spark.createDataFrame([("e1", "v", T0, 20.0015, 77.001), ("e2", "v", T0 + dt.timedelta(minutes=1), 21.0, 78.0)], POINTS)
    got = alerting.geofence_events(points, fences).groupBy("event_type").count().collect()
    inside = fences.filter(F.abs(F.col("center_lat") - 20.0015) * 111.195 <= 0.05).count()
    assert {r["event_type"]: r["count"] for r in got} == {"ENTRY": inside, "EXIT": inside} and inside > 5000


def test_a_fence_is_a_few_rows_whatever_its_radius(spark):
    sizes = [0.001, 0.5, 3.0, 40.0, 500.0, 4000.0]
    fences = spark.createDataFrame([(str(r), "HUB", 30.0, 77.0, r) for r in sizes], FENCES)
    assert alerting.fence_cells(fences).groupBy("geofence_id").count().agg(F.max("count")).first()[0] <= 4


@pytest.mark.parametrize("block", [2, 3, 7])
def test_visits_over_the_edges_of_blocks(spark, block):
    rnd = random.Random(block)
    points = [(f"e{i:03d}", rnd.choice(["a", "b", None]), T0 + dt.timedelta(minutes=i), 20.0 + rnd.choice([0, 0, 0, 1]),
               77.0 + rnd.choice([0.0, 0.05])) for i in range(150)]
    fences = [("wide", "CITY", 20.0, 77.0, 30.0), ("spot", "HUB", 20.0, 77.05, 0.5), ("none", "HUB", 40.0, 40.0, 1.0),
              *[(f"f{i}", "TOLL", 20.0, 77.0, 1.0) for i in range(4)]]
    p, f = spark.createDataFrame(points, POINTS), spark.createDataFrame(fences, FENCES)
    assert found(alerting.geofence_events(p, f, block=block)) == walked(points, fences)


def test_a_point_moves_once_however_many_fences_hold_it(spark):
    fences = spark.range(200).select(
        F.format_string("f%03d", "id").alias("geofence_id"), F.lit("HUB").alias("geofence_type"),
        F.lit(20.005).alias("center_lat"), F.lit(77.005).alias("center_lng"), F.lit(0.5).alias("radius_km"))
    at = [("e1", "v", T0, 20.005, 77.005), ("e2", "v", T0 + dt.timedelta(seconds=60), 21.0, 78.0),
          ("e3", "v", T0 + dt.timedelta(seconds=90), 21.0, 78.0)]
    points = spark.createDataFrame(at, POINTS)
    around = alerting.fences_around(points, fences, F.col("geofence_id")).collect()
    assert [(r["event_id"], len(set(r["fences"]))) for r in around] == [("e1", 200)]
    linked = points.withColumns({"prev_lat": F.when(F.col("event_id") == "e2", 20.005), "prev_lng": F.when(F.col("event_id") == "e2", 77.005)})
    moves = alerting.crossings(linked, fences)
    assert sorted((r["event_id"], len(r["entered"]), len(r["left"])) for r in moves.collect()) == [("e1", 200, 0), ("e2", 0, 200)]
    for slices in (1, 30):
        got = alerting.with_dwell(moves, Timeline(("vehicle_id",), slices=slices))
        assert got.groupBy("event_type", "dwell_time_seconds").count().orderBy("event_type").collect() == [
            ("ENTRY", None, 200), ("EXIT", 60.0, 200)]


def test_dwell_of_a_vehicle_with_several_ranges(spark):
    """A stay longer than a range is paired with its ENTRY."""
    fence = lambda name: [(name, "HUB")]
    rows = [("e000", "v", T0, 1.0, 1.0, fence("long"), [])]
    for i in range(1, 400):
        rows.append((f"e{i:03d}", "v", T0 + dt.timedelta(seconds=i), 1.0, 1.0, *((fence("f"), []) if i % 2 else ([], fence("f")))))
    rows.append(("e400", "v", T0 + dt.timedelta(seconds=400), 1.0, 1.0, [], fence("long")))
    listed = "array<struct<geofence_id:string,geofence_type:string>>"
    moves = spark.createDataFrame(rows, f"{POINTS}, entered {listed}, left {listed}")
    for slices in (1, 10):
        got = alerting.with_dwell(moves, Timeline(("vehicle_id",), slices=slices)).filter("event_type = 'EXIT'")
        assert sorted((r["geofence_id"], r["dwell_time_seconds"]) for r in got.collect()) == [("f", 1.0)] * 199 + [("long", 400.0)]
