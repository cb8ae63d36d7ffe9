"""Quality checks, model tests, figures, previews and sources."""

import json

import pytest
from pyspark.sql import functions as F

from routeline.operators import quality as q
from routeline.operators import serving
from routeline.sources import sinks, tables


@pytest.fixture(scope="module")
def frame(spark):
    rows = [("a", 1.0, "X"), ("b", None, "Y"), ("b", 5.0, None), (None, 9.0, "Z")]
    return spark.createDataFrame(rows, "id string, v double, kind string")


def by_check(results):
    return {(r["check"], r["column"]): r for r in results.collect()}


def test_checks(frame):
    got = by_check(q.run_table_checks(frame, "t", [
        q.row_count(4), q.not_null("id"), q.not_null("v", 0.75), q.unique("id"),
        q.value_range("v", 0, 5, 0.5), q.value_range("v", low=2.0, threshold=0.9),
        q.accepted_values("kind", ["X", "Y"], 0.5), q.expression("v < 6", "v")]))
    assert got[("row_count", None)]["success"]
    assert not got[("not_null", "id")]["success"]
    assert got[("not_null", "id")]["actual_ratio"] == 0.75
    assert got[("not_null", "v")]["success"]
    row = got[("unique", "id")]  # a, b, NULL
    assert (row["success"], row["total_rows"], row["passing_rows"]) == (False, 4, 3)
    assert got[("accepted_values", "kind")]["invalid_values_sample"] == []  # it passed
    assert got[("expression_is_true", "v")]["passing_rows"] == 3


def test_range_figures_and_one_sided(frame):
    rows = q.run_table_checks(frame, "t", [q.value_range("v", 0, 5), q.value_range(
        "v", low=2.0, threshold=0.5)]).collect()
    two, one = rows
    assert (two["success"], two["actual_ratio"], two["actual_max"], two["actual_avg"]) == (
        False, 0.6667, 9.0, 5.0)
    assert one["success"] and one["passing_rows"] == 2


def test_invalid_samples_are_listed_only_on_failure_and_at_most_ten(spark):
    df = spark.range(40).select(F.format_string("v%02d", "id").alias("kind"))
    row = q.run_table_checks(df, "t", [q.accepted_values("kind", ["v00"])]).first()
    assert row["invalid_values_sample"] == [f"v{i:02d}" for i in range(1, 11)]


@pytest.mark.parametrize("check, words", [
    (q.not_null("id", 1.5), "threshold must be between 0 and 1"),
    (q.value_range("v", 5, 1), "min_value cannot be greater than max_value"),
    (q.accepted_values("kind", []), "accepted_values cannot be empty"),
    (q.row_count(-1), "min_count must be a non-negative integer"),
    (q.not_null("nope"), "column not found"),
])
def test_errors_become_failed_results(frame, check, words):
    row = q.run_table_checks(frame, "t", [check]).first()
    assert row["success"] is False and words in row["error"]


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "id string, kind string")
    got = by_check(q.run_table_checks(empty, "t", [
        q.not_null("id"), q.accepted_values("kind", ["X"]), q.row_count(1)]))
    assert got[("not_null", "id")]["success"] and got[("accepted_values", "kind")]["success"]
    assert got[("accepted_values", "kind")]["message"] == "No data to check"
    assert not got[("row_count", None)]["success"]
    nulls = spark.createDataFrame([(None,)], "kind string")
    assert q.run_table_checks(nulls, "t", [q.accepted_values("kind", ["X"])]).first()["success"]


def test_missing_table_and_report(spark, frame, tmp_path):
    suite = {"t": [q.row_count()], "gone": [q.row_count()]}
    results = q.run_suite(spark, suite, {"t": frame})
    report = q.quality_report(results, "all", "2024-01-01 00:00:00")
    row = report.first()
    assert (row["total_checks"], row["passed"], row["failed"], row["pass_rate"]) == (2, 1, 1, 50.0)
    assert not row["overall_success"]
    assert q.failed_checks(results).first()["reason"] == "Path not found: gone"
    sinks.write_report(report, str(tmp_path / "reports"))
    sinks.write_report(q.quality_report(results, "all", "2024-01-02 00:00:00"),
                       str(tmp_path / "reports"))
    stored = sinks.read_reports(spark, str(tmp_path / "reports"), report.schema)
    assert stored.count() == 2
    assert str(q.latest_report(stored).first()["run_time"]) == "2024-01-02 00:00:00"
    line = spark.read.text(str(tmp_path / "reports")).first()[0]
    assert json.loads(line)["checks"][0]["check"] in ("table_exists", "row_count")
    with pytest.raises(ValueError):
        q.run_checks(spark, "gold", {})


def test_suites_have_the_declared_checks():
    assert sum(map(len, q.BRONZE_SUITE.values())) == 22
    assert sum(map(len, q.SILVER_SUITE.values())) == 9
    assert sum(map(len, q.MODEL_TESTS.values())) == 59


def test_checks_of_a_table_take_one_scan(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v")) \
        .write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = q.run_table_checks(df, "t", [q.row_count(), q.not_null("id"), q.unique("id"),
                                        q.value_range("v", 0, 50)])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("parquet") == 1


def test_model_tests_and_failing_rows(frame):
    got = {(r["column"], r["test"]): r["failures"] for r in q.run_model_tests(
        {"m": frame}, {"m": [q.unique("id"), q.not_null("id"),
                             q.accepted_values("kind", ["X", "Y"])]}).collect()}
    assert got == {("id", "unique"): 1, ("id", "not_null"): 1, ("kind", "accepted_values"): 1}
    assert [tuple(r) for r in q.failing_rows(frame, q.unique("id")).collect()] == [("b", 2)]
    assert q.failing_rows(frame, q.not_null("v")).count() == 1
    assert q.failing_rows(frame, q.accepted_values("kind", ["X", "Y"])).first()[0] == "Z"


def test_quantiles_match_percentile(spark):
    """Whatever the distribution: many equal values, and one outlier in a million times the spread."""
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (
        F.pmod(F.hash("id"), F.lit(1000)) / 10.0).alias("v")).unionByName(
        spark.range(3000).select(F.lit(0).cast("long").alias("g"), F.lit(42.0).alias("v"))).unionByName(
        spark.createDataFrame([(1, 1e12), (None, 3.0), (2, None)], "g bigint, v double"))
    expected = df.filter("v is not null").groupBy("g").agg(
        F.count("v").alias("count"), F.min("v").alias("min"),
        *[F.percentile("v", p).alias(f"p{round(p * 100)}") for p in (0.25, 0.5, 0.75)],
        F.max("v").alias("max"))
    for slices in (1, 7, 300):
        got = serving.quantiles(df, "g", "v", slices=slices)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_an_outlier_leaves_no_task_with_a_group(spark):
    from routeline.operators.timeline import Timeline, _Ranges
    df = spark.range(20_000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v")).unionByName(
        spark.createDataFrame([("a", 1e18)], "g string, v double"))
    largest = _Ranges(df, Timeline(("g",), ("v",), 40)).rows.groupBy("_range").count().agg(F.max("count")).first()[0]
    assert largest < 4 * 20_000 / 40


def test_a_runtime_error_fails_one_check(spark):
    frame = spark.createDataFrame([("1", 1), ("x", None)], "v string, n int")
    checks = [q.not_null("n", 0.5), q.expression("cast(v as int) > 0", "v"), q.row_count(1)]
    with pytest.raises(Exception):
        q.run_table_checks(frame, "t", checks).collect()
    got = {r["check"]: r for r in q.run_suite(spark, {"t": checks}, {"t": frame}, now=True).collect()}
    assert got["not_null"]["success"] and got["row_count"]["success"]
    assert not got["expression_is_true"]["success"] and "CAST_INVALID_INPUT" in got["expression_is_true"]["error"]
    broken = q.uncastable_values(frame, {"v": "int", "n": "int"}).collect()
    assert [(r["column"], r["value"], r["row"]["v"]) for r in broken] == [("v", "x", "x")]


def test_failing_rows_are_stored_and_missing_models_are_errors(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    tests = {"m": [q.unique("k"), q.not_null("v"), q.not_null("k")], "gone": [q.not_null("k")]}
    results = q.run_model_tests({"m": frame}, tests)
    assert {(r["model"], r["test"], r["column"]): r["status"] for r in results.collect()} == {
        ("m", "unique", "k"): "warn", ("m", "not_null", "v"): "warn", ("m", "not_null", "k"): "pass",
        ("gone", "not_null", "k"): "error"}
    folders = q.store_failing_rows({"m": frame}, results, str(tmp_path), tests)
    assert [f.rsplit("/", 1)[1] for f in folders] == ["unique_m_k", "not_null_m_v"]
    assert [tuple(r) for r in spark.read.parquet(folders[0]).collect()] == [("a", 2)]
    assert [tuple(r) for r in spark.read.parquet(folders[1]).collect()] == [("a", None)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "v double")
    got = [(r["bin"], r["count"]) for r in serving.histogram(df, "v", 4).orderBy("bin").collect()]
    assert got == [(0, 1), (1, 0), (2, 1), (3, 1)]
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert serving.histogram(same, "v", 3).filter("count > 0").first()["count"] == 2
    with pytest.raises(ValueError):
        serving.histogram(df, "v", 0)


def test_preview_sample_manifest(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("event_id"))
    df.createOrReplaceTempView("known")
    assert serving.preview(spark, "known", ["known"], 5).count() == 5
    with pytest.raises(ValueError):
        serving.preview(spark, "x; drop", ["known"])
    a, b = serving.sample_positions(df, 10), serving.sample_positions(df, 10)
    assert a.collect() == b.collect() and a.count() == 10
    assert a.collect() != serving.sample_positions(df, 10, seed=7).collect()
    assert serving.manifest({"known": df}).first()["columns"] == ["event_id"]


def test_sources(spark, tmp_path):
    root, other = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).withColumn("x", F.lit("1")).coalesce(1).write.parquet(f"{root}/bronze/alerts")
    spark.range(2).withColumn("y", F.lit(2)).coalesce(1).write.mode("append").parquet(
        f"{root}/bronze/alerts")
    spark.range(1).write.parquet(f"{root}/silver/fleet/trips")
    spark.range(1).write.parquet(f"{other}/bronze/alerts")
    assert tables.resolve_root(spark, [other, root]) == root
    assert tables.resolve_root(spark, [other, str(tmp_path / "none")]) == other
    assert tables.register_sources(spark, root) == ["alerts", "trips"]
    assert set(spark.table("alerts").columns) == {"id", "x", "y"}
    assert spark.table("alerts").count() == 5
    assert tables.data_root(spark, root, "sample") == "sample"
    assert tables.data_root(spark, root, "sample", "live") == root
    with pytest.raises(FileNotFoundError):
        tables.read_parquet_tree(spark, f"{root}/nothing")
    with tables.ScanCache(spark) as cache:
        first = cache.get(f"{root}/bronze/alerts")
        assert cache.get(f"{root}/bronze/alerts") is first and first.is_cached
    assert not first.is_cached
