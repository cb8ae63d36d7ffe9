"""Cutting series into ranges must not change any result, and no task holds a whole large key."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from routeline.operators import alerting, delivery, fleet, shipments
from routeline.operators.timeline import (
    Timeline, _Ranges, with_islands, with_last_seen, with_neighbours,
)
from routeline.sources import feeds

ROOT = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    """One key holds most rows; ties, NULL keys and NULL times included."""
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        key = "hot" if i % 3 else rnd.choice(["a", "b", None])
        ts = None if i % 50 == 0 else T0 + dt.timedelta(minutes=rnd.randrange(0, 600))
        rows.append((key, ts, f"e{i:04d}", rnd.choice(["x", "y", None])))
    return spark.createDataFrame(
        rows, "key string, event_timestamp timestamp, event_id string, state string").cache()


def lines():
    """From whole series to ranges of a few rows."""
    return [Timeline(keys=("key",), slices=n) for n in (1, 4, 30)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_neighbours_equal_plain_window(series):
    w = Window.partitionBy("key").orderBy("event_timestamp", "event_id")
    expected = series.withColumns({
        "p": F.lag("state").over(w), "n": F.lead("event_id").over(w),
        "i": F.row_number().over(w).cast("long")})
    for line in lines():
        got = with_neighbours(series, line, previous={"p": "state"}, following={"n": "event_id"},
                              sequence="i").select(*expected.columns)
        assert rows_of(got) == rows_of(expected)


def test_islands_equal_plain_window(series):
    w = Window.partitionBy("key").orderBy("event_timestamp", "event_id")
    changed = F.row_number().over(w) == 1
    changed = changed | ~F.lag("state").over(w).eqNullSafe(F.col("state"))
    expected = series.withColumn("c", changed).withColumn(
        "run", F.sum(F.col("c").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    for line in lines():
        got = with_islands(series, line, lambda p, c: ~p("state").eqNullSafe(c("state")),
                           uses=("state",), island="run", flag="c").select(*expected.columns)
        assert rows_of(got) == rows_of(expected)


def test_last_seen_equals_plain_window(series):
    w = Window.partitionBy("key").orderBy("event_timestamp", "event_id")
    value = F.when(F.col("state") == "x", F.col("event_id"))
    expected = series.withColumn("v", F.last(value, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    for line in lines():
        assert rows_of(with_last_seen(series, line, value, "v")) == rows_of(expected)


def test_domain_operators_do_not_depend_on_the_split(spark):
    positions = feeds.vehicle_positions(spark, ROOT)
    scans, agents = feeds.shipment_events(spark, ROOT), feeds.agent_positions(spark, ROOT)
    fences = feeds.geofences(spark, ROOT)

    def split(*keys):
        return Timeline(keys=keys, slices=500)

    def plain(*keys):
        return Timeline(keys=keys, slices=1)

    cases = [
        lambda t: fleet.reconstruct_trips(positions, line=t("vehicle_id")),
        lambda t: fleet.detect_driving_events(positions, t("vehicle_id")),
        lambda t: fleet.detect_idle(positions, line=t("vehicle_id")),
        lambda t: alerting.geofence_events(positions, fences, line=t("vehicle_id")),
        lambda t: shipments.journeys(scans, line=t("shipment_id")),
        lambda t: shipments.validate_sequence(scans, t("shipment_id")),
        lambda t: delivery.detect_stops(agents, line=t("agent_id")),
        lambda t: delivery.agent_distance(agents, t("agent_id", "event_date")),
    ]
    for case in cases:
        a, b = case(plain), case(split)
        rounded = [F.round(c, 6).alias(c) if d == "double" else F.col(c) for c, d in a.dtypes]
        assert rows_of(a.select(*rounded)) == rows_of(b.select(*rounded))


def largest(df, line, **kind):
    """(rows of the largest window group, rows of the largest key, guests)."""
    rows = _Ranges(df, line, **kind).rows
    group = rows.groupBy("_k0", "_range").count().agg(F.max("count")).first()[0]
    return group, df.groupBy("key").count().agg(F.max("count")).first()[0], rows.filter("_guest").count()


def event(key, seconds):
    return [key.alias("key"), seconds.alias("event_timestamp"), F.col("id").cast("string").alias("event_id")]


def test_one_vehicle_with_most_rows_is_spread(spark):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60)
    df = spark.range(20_000).select(*event(F.when(F.col("id") % 50 == 0, "cold").otherwise("hot"), at))
    group, whole, guests = largest(df, Timeline(keys=("key",), slices=40), before=True)
    assert group < 4 * whole / 40 and guests <= 40


def test_five_thousand_large_keys_are_spread(spark):
    at = F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("id") / 5000))
    df = spark.range(200_000).select(*event((F.col("id") % 5000).cast("string"), at))
    line = Timeline(keys=("key",), slices=400)
    tasks = _Ranges(df, line).rows.groupBy("_range").count().agg(F.max("count"), F.count("*")).first()
    assert tasks[0] < 4 * 200_000 / 400 and tasks[1] > 390


@pytest.mark.parametrize("at", [None, T0])
def test_a_burst_without_or_at_one_time_is_spread(spark, at):
    df = spark.range(20_000).select(*event(F.lit("hot"), F.lit(at).cast("timestamp")))
    group, whole, guests = largest(df, Timeline(keys=("key",), slices=40), before=True, after=True)
    assert group < 4 * whole / 40 and guests < whole / 8
    got = with_neighbours(df, Timeline(keys=("key",), slices=40), sequence="i", previous={"p": "event_id"},
                          following={"n": "event_id"})
    ordered = sorted(map(str, range(20_000)))
    assert [(r.event_id, r.p, r.n) for r in got.orderBy("i").collect()] == list(
        zip(ordered, [None, *ordered], [*ordered[1:], None], strict=False))


def test_every_table_is_read_once(spark):
    """The cuts come from subqueries over the order columns; the rows themselves have one scan a table."""
    scans = feeds.shipment_events(spark, ROOT)
    leaves = lambda df: df._jdf.queryExecution().sparkPlan().collectLeaves().mkString("\n").count("FileScan")
    for build in (shipments.journeys, shipments.stuck_shipments, shipments.journeys_risk_view):
        assert leaves(build(scans)) == leaves(scans)
    positions = feeds.vehicle_positions(spark, ROOT)
    assert leaves(fleet.detect_driving_events(positions)) == leaves(positions)


def test_a_row_is_searched_for_once_a_pass(spark):
    """The condition on cut keys must not bring further copies of the search below the carried values."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id"))
    df = spark.range(2_000).select(*event((F.col("id") % 3).cast("string"), at))
    got = with_last_seen(df, Timeline(keys=("key",), slices=40), F.col("event_id"), "v")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reduce(") == 2  # the rows, and the ranges that carry
    w = Window.partitionBy("key").orderBy("event_timestamp", "event_id")
    assert rows_of(got) == rows_of(df.withColumn("v", F.last("event_id", ignorenulls=True).over(w)))


def test_rows_of_keys_without_cuts_carry_none(spark):
    """A small key is one range of its own, and guests come from cut keys alone."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id"))
    key = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string"))
    rows = _Ranges(spark.range(20_000).select(*event(key, at)), Timeline(keys=("key",), slices=40),
                   before=True, after=True).rows
    assert rows.filter("key = 'hot'").select("_range").distinct().count() > 10
    cold = rows.filter("key != 'hot' and not _cut")
    assert cold.filter("_guest").count() == 0
    assert cold.select("_range").distinct().count() == 40  # by hash, not by place
