"""Versioned tables: copy-on-write merges, folded generations, retries, vacuum."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from routeline.operators import alerting
from routeline.operators.shipments import current_status
from routeline.plans import daily
from routeline.sources import feeds
from routeline.sources.versions import Generations, KeyedTable, VersionConflict, Versions
from routeline.streaming import detect, status

ROOT = "/root/testdata/sf0.001"
SCHEMA = "id string, day date, v int"


def day(n):
    return dt.date(2024, 1, n)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(state):
    return dict(state["folders"])


def test_merge_writes_touched_partitions_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), "day")
    make = lambda data: spark.createDataFrame(data, SCHEMA)
    assert table.read() is None and table.partitions() == []
    first = table.merge(make([("a", day(1), 1), ("b", day(2), 2), ("c", day(3), 3), (None, None, 4)]))
    assert table.partitions() == ["2024-01-01", "2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__"]
    # a change, an insert, and rows that stay as they are
    second = table.merge(make([("b", day(2), 20), ("d", day(2), 5), ("c", day(3), 3), (None, None, 4)]))
    assert rows(table.read()) == sorted([("a", day(1), 1), ("b", day(2), 20), ("c", day(3), 3), ("d", day(2), 5),
                                         (None, None, 4)], key=repr)
    changed = {p for p in files(second) if files(second)[p] != files(first).get(p)}
    assert changed == {"2024-01-02"} and second["version"] == 1
    # a rerun changes nothing
    assert table.merge(make([("b", day(2), 20), ("d", day(2), 5)])) == second
    # a key that moves to another partition leaves the old one, which is then empty
    third = table.merge(make([("a", day(3), 9)]))
    assert "2024-01-01" not in files(third) and files(third)["2024-01-02"] == files(second)["2024-01-02"]
    assert rows(table.read(lambda p: p == "2024-01-03")) == [("a", day(3), 9), ("c", day(3), 3)]
    assert table.vacuum(keep=1) > 0 and len(rows(table.read())) == 5
    assert rows(KeyedTable(spark, str(tmp_path / "t"), ("id",), "day").read()) == rows(table.read())


def test_merge_with_a_rule_and_an_empty_batch(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), "day")
    largest = lambda df: df.groupBy("id").agg(F.max_by(F.struct("day", "v"), "v").alias("b")).select("id", "b.*")
    make = lambda data: spark.createDataFrame(data, SCHEMA)
    table.merge(make([("a", day(1), 5)]))
    assert table.merge(make([("a", day(2), 3)]), largest)["version"] == 0
    assert table.merge(make([]), largest)["version"] == 0
    table.merge(make([("a", day(2), 8)]), largest)
    assert rows(table.read()) == [("a", day(2), 8)]


def test_one_of_two_writers_fails(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))
    versions.publish({"version": 0})
    with pytest.raises(VersionConflict):
        versions.publish({"version": 0})
    assert versions.numbers() == [0]


def test_generations_stay_few_and_batches_count_once(spark, tmp_path):
    total = lambda df: df.groupBy("id").agg(F.max("v").alias("v"))
    table = Generations(spark, str(tmp_path / "g"), "id", total, fan=4, buckets=2)
    rnd, best = random.Random(1), {}
    for batch in range(50):
        data = [(f"k{rnd.randrange(9)}", rnd.randrange(1000)) for _ in range(3)]
        for k, v in data:
            best[k] = max(v, best.get(k, -1))
        frame = spark.createDataFrame(data, "id string, v int").coalesce(1)
        table.add(frame, batch)
        if batch % 10 == 0:
            table.add(frame.withColumn("v", F.col("v") + 5000), batch)  # a retry of a published batch
        table.vacuum()
        assert len(table.live()) <= 3 * 3
    assert {r.id: r.v for r in table.read().collect()} == best
    assert [(r.id, r.v) for r in table.read("k3").collect()] == [("k3", best["k3"])]
    assert len(os.listdir(tmp_path / "g" / "data")) <= 9 + 5  # folded and superseded folders are gone


def test_status_ignores_late_events_and_retries(spark, tmp_path):
    scans = feeds.shipment_events(spark, ROOT).cache()
    store = status.upsert_status(str(tmp_path / "status"), fan=2)
    newest = scans.orderBy(F.desc("event_timestamp"), F.desc("event_id")).limit(500).cache()
    store(newest, 0)          # the latest events arrive first
    rest = scans.join(newest, "event_id", "left_anti")
    store(rest, 1)
    store(rest, 1)            # a retried batch
    store(rest.limit(0), 2)   # and an empty one
    expected = current_status(scans)
    got = status.read_status(spark, str(tmp_path / "status"))
    assert rows(got.select(*expected.columns)) == rows(expected)
    one = rows(expected)[7]
    assert rows(status.read_status(spark, str(tmp_path / "status"), one[0]).select(*expected.columns)) == [one]


@pytest.mark.parametrize("seed", [1, 2])
def test_alerts_keep_the_worst_in_any_order(spark, tmp_path, seed):
    at = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    data = [("FLEET", "SPEEDING", s, "VEHICLE", v, t) for s in ("INFO", "WARNING", "HIGH", "CRITICAL")
            for v in ("v1", "v2", None) for t in at if (s, v) != ("CRITICAL", "v2")]
    random.Random(seed).shuffle(data)
    schema = "module string, alert_type string, severity string, entity_type string, entity_id string, alert_timestamp timestamp"
    folder = str(tmp_path / "in")
    for i in range(4):
        spark.createDataFrame(data[i::4], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    detect.stream_alerts(stream, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True).awaitTermination()
    want = alerting.unify_alerts(spark.read.parquet(folder))
    assert rows(detect.read_alerts(spark, str(tmp_path / "out"))) == rows(want) and want.count() == 9


def test_sla_merge(spark, tmp_path):
    scans, definitions = feeds.shipment_events(spark, ROOT).cache(), feeds.sla_definitions(spark, ROOT)
    table = daily.sla_table(spark, str(tmp_path / "sla"))
    daily.merge_sla(table, scans.filter("event_date <= date'2001-06-30'"), definitions)
    before = table.versions.load()
    newest = table.read().agg(F.max("created_date")).first()[0]
    after = daily.merge_sla(table, scans, definitions)
    assert daily.merge_sla(table, scans, definitions) == after  # a rerun changes nothing
    since = newest - dt.timedelta(days=3)
    old = [p for p in files(before) if p < since.replace(day=1).isoformat()]
    assert old and all(files(before)[p] == files(after)[p] for p in old)
    from routeline.operators.shipments import sla_tracking
    full = sla_tracking(scans, definitions).filter(F.col("created_date") >= since)
    got = table.read().drop("created_month")
    assert rows(got.filter(F.col("created_date") >= since)) == rows(full)
    assert got.count() == got.select("shipment_id").distinct().count()


def test_a_generation_is_written_by_more_tasks_than_buckets(spark, tmp_path):
    """One task a bucket would sort an eighth of a table of any size."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a stream
    try:
        table = Generations(spark, str(tmp_path / "g"), "k", lambda d: d.groupBy("k").agg(F.max("v").alias("v")),
                            buckets=2)
        rows = spark.range(2_000).select((F.col("id") % 1_000).cast("string").alias("k"), F.col("id").alias("v"))
        table.add(rows, 0)
        files = spark.read.parquet(f"{tmp_path}/g/{table.live()[0]['folder']}").select(F.input_file_name()).distinct()
        assert files.count() > 10
        assert table.read().agg(F.count("k"), F.sum("v")).first()[:] == (1_000, sum(range(1_000, 2_000)))
        assert table.read("7").first()["v"] == 1_007
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
