"""Declarative quality checks, evaluated in one aggregate pass per table.

A suite lists checks per table. All checks of a table compile to the expressions of a single
``agg``, so a table is scanned once whatever the number of its checks. Samples of invalid values
take one more pass that keeps at most ten values per check and task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routeline import contracts as C
from routeline.functions.values import (
    count_when, require_non_negative_int, require_ratio, rounded,
)

RESULT_SCHEMA = (
    "check string, table string, column string, success boolean, threshold double, "
    "actual_ratio double, total_rows long, passing_rows long, actual_min double, "
    "actual_max double, actual_avg double, invalid_values_sample array<string>, "
    "message string, error string"
)
SAMPLE_SIZE = 10


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    threshold: float | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = field(default=())
    min_count: int = 1
    expression: str | None = None


def not_null(column: str, threshold: float = 1.0) -> Check:
    return Check("not_null", column, threshold)


def unique(column: str) -> Check:
    return Check("unique", column)


def value_range(column: str, low: float | None = None, high: float | None = None,
                threshold: float = 0.98) -> Check:
    return Check("value_range", column, threshold, low, high)


def accepted_values(column: str, values, threshold: float = 1.0) -> Check:
    return Check("accepted_values", column, threshold, values=tuple(values))


def row_count(min_count: int = 1) -> Check:
    return Check("row_count", min_count=min_count)


def expression(sql: str, column: str | None = None) -> Check:
    """Every row satisfies the SQL condition; a NULL outcome counts as satisfied."""
    return Check("expression_is_true", column, 1.0, expression=sql)


def _problem(check: Check, columns: list[str]) -> str | None:
    """Why a check cannot run, found before any job starts."""
    try:
        if check.threshold is not None:
            require_ratio(check.threshold, "threshold")
        if check.kind == "row_count":
            require_non_negative_int(check.min_count, "min_count")
        if check.kind == "value_range" and None not in (check.low, check.high) \
                and check.low > check.high:
            raise ValueError("min_value cannot be greater than max_value")
        if check.kind == "accepted_values" and not check.values:
            raise ValueError("accepted_values cannot be empty")
        if check.column and check.kind != "expression_is_true" and check.column not in columns:
            raise ValueError(f"column not found: {check.column}")
    except ValueError as error:
        return str(error)
    return None


def _figures(check: Check) -> dict[str, Column]:
    """The aggregates a check needs: rows considered, rows passing, value statistics."""
    c = F.col(check.column) if check.column else None
    if check.kind == "row_count":
        return {"total": F.count(F.lit(1)), "passing": F.count(F.lit(1))}
    if check.kind == "not_null":
        return {"total": F.count(F.lit(1)), "passing": F.count(c)}
    if check.kind == "unique":
        # NULL counts as one value
        some_null = F.max(F.when(c.isNull(), 1).otherwise(0))
        return {"total": F.count(F.lit(1)),
                "passing": F.countDistinct(c) + F.coalesce(some_null, F.lit(0))}
    if check.kind == "value_range":
        inside = c.isNotNull()
        inside = inside if check.low is None else inside & (c >= check.low)
        inside = inside if check.high is None else inside & (c <= check.high)
        return {"total": F.count(c), "passing": count_when(inside),
                "low": F.min(c).cast("double"), "high": F.max(c).cast("double"),
                "mean": F.avg(c)}
    if check.kind == "accepted_values":
        return {"total": F.count(c), "passing": count_when(c.isin(*check.values))}
    if check.kind == "expression_is_true":
        return {"total": F.count(F.lit(1)),
                "passing": count_when(F.coalesce(F.expr(check.expression), F.lit(True)))}
    raise ValueError(f"unknown check: {check.kind}")


def _error_row(spark: SparkSession, check: str, table: str, column: str | None,
               error: str) -> DataFrame:
    row = {"check": check, "table": table, "column": column, "success": False, "error": error}
    return spark.createDataFrame([row], RESULT_SCHEMA)


def _samples(df: DataFrame, checks: dict[int, Check]) -> DataFrame:
    """Up to ten smallest distinct invalid values per check, as one sorted list each."""
    invalid = F.explode(F.array_compact(F.array(*[
        F.when(F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values),
               F.struct(F.lit(i).alias("id"), F.col(c.column).cast("string").alias("value")))
        for i, c in checks.items()])))
    distinct = df.select(invalid.alias("s")).select("s.*").distinct()
    # rank <= 10 is pushed below the shuffle, so each task forwards ten values per check
    rank = F.row_number().over(Window.partitionBy("id").orderBy("value"))
    return distinct.withColumn("r", rank).filter(F.col("r") <= SAMPLE_SIZE) \
        .groupBy("id").agg(F.sort_array(F.collect_list("value")).alias("sample"))


def run_table_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """One result row per check."""
    spark = df.sparkSession
    listed = list(enumerate(checks))
    problems = {i: _problem(c, df.columns) for i, c in listed}
    parts = [_error_row(spark, c.kind, table, c.column, problems[i])
             for i, c in listed if problems[i]]
    good = {i: c for i, c in listed if not problems[i]}
    if good:
        figures = {(i, name): expr for i, c in good.items()
                   for name, expr in _figures(c).items()}
        totals = df.agg(*[e.alias(f"c{i}_{name}") for (i, name), e in figures.items()])

        def got(i: int, name: str, kind: str) -> Column:
            if (i, name) in figures:
                return F.col(f"c{i}_{name}").cast(kind)
            return F.lit(None).cast(kind)

        rows = F.explode(F.array(*[
            F.struct(
                F.lit(i).alias("id"), F.lit(c.kind).alias("check"),
                F.lit(c.column).cast("string").alias("column"),
                F.lit(c.threshold).cast("double").alias("threshold"),
                F.lit(c.min_count).alias("min_count"),
                got(i, "total", "long").alias("total"), got(i, "passing", "long").alias("passing"),
                got(i, "low", "double").alias("low"), got(i, "high", "double").alias("high"),
                got(i, "mean", "double").alias("mean"))
            for i, c in good.items()]))
        r = totals.select(rows.alias("r")).select("r.*")
        listed_values = {i: c for i, c in good.items() if c.kind == "accepted_values"}
        none = F.lit(None).cast("array<string>")
        if listed_values:
            r = r.join(_samples(df, listed_values), "id", "left")
        else:
            r = r.withColumn("sample", none)
        parts.append(r.select(*_result_columns(table)))
    return reduce(DataFrame.unionByName, parts)


def run_table_checks_now(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """Results of a table's checks, computed here in one pass.

    If a value makes that pass fail (a cast in an expression, say), every check runs alone; one that fails
    by itself is a failed check with the error, and the others keep their results.
    """
    spark, rows = df.sparkSession, []
    try:
        rows = run_table_checks(df, table, checks).collect()
    except PySparkException:
        for check in checks:
            try:
                rows += run_table_checks(df, table, [check]).collect()
            except PySparkException as error:
                rows += _error_row(spark, check.kind, table, check.column, str(error).splitlines()[0]).collect()
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def uncastable_values(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The rows with a value that does not fit the type its column should have: one row per such value, with
    the column, the raw value, the error and the whole row, so that the rest can be cast safely."""
    def broken(column: str, kind: str) -> Column:
        raw = F.col(column)
        return F.when(raw.isNotNull() & raw.try_cast(kind).isNull(), F.struct(
            F.lit(column).alias("column"), raw.cast("string").alias("value"),
            F.lit(f"not a valid {kind}").alias("error")))

    found = F.array_compact(F.array(*[broken(c, k) for c, k in types.items()]))
    return df.select(F.struct("*").alias("row"), F.explode(found).alias("b")).select("b.*", "row")


def _result_columns(table: str) -> list[Column]:
    kind, total, passing = F.col("check"), F.col("total"), F.col("passing")
    empty = (total == 0) & ~kind.isin("row_count", "unique")
    ratio = F.when(total > 0, passing / total)
    success = (
        F.when(kind == "row_count", total >= F.col("min_count"))
        .when(kind == "unique", total == passing)
        .when(empty, F.lit(True)).otherwise(ratio >= F.col("threshold"))
    )
    no_list = F.array().cast("array<string>")
    sample = F.when(kind == "accepted_values",
                    F.when(success, no_list).otherwise(F.coalesce("sample", no_list)))
    graded = F.col("threshold").isNotNull() & ~empty
    return [
        kind.alias("check"), F.lit(table).alias("table"), "column", success.alias("success"),
        "threshold", F.when(graded, rounded(ratio, 4)).alias("actual_ratio"),
        total.alias("total_rows"), passing.alias("passing_rows"), F.col("low").alias("actual_min"),
        F.col("high").alias("actual_max"), F.col("mean").alias("actual_avg"),
        sample.alias("invalid_values_sample"),
        F.when(empty, F.lit("No data to check")).alias("message"),
        F.lit(None).cast("string").alias("error"),
    ]


# ---- suites ---------------------------------------------------------------------------------

_B = C.BOUNDS
BRONZE_SUITE: dict[str, list[Check]] = {
    "vehicle_positions": [
        row_count(), not_null("event_id"), not_null("vehicle_id"), not_null("latitude"),
        not_null("longitude"), value_range("latitude", _B.lat_min, _B.lat_max),
        value_range("longitude", _B.lng_min, _B.lng_max),
        value_range("speed_kmh", 0, 200, threshold=0.99),
    ],
    "shipment_events": [
        row_count(), not_null("event_id"), not_null("shipment_id"), not_null("event_type"),
        accepted_values("event_type", C.SHIPMENT_EVENT_TYPES),
    ],
    "agent_positions": [
        row_count(), not_null("agent_id"), value_range("latitude", _B.lat_min, _B.lat_max),
        value_range("longitude", _B.lng_min, _B.lng_max),
    ],
    "delivery_events": [
        row_count(), not_null("event_id"), not_null("agent_id"),
        accepted_values("event_type", C.DELIVERY_EVENT_TYPES),
        value_range("customer_rating", 1, 5, threshold=1.0),
    ],
}
SILVER_SUITE: dict[str, list[Check]] = {
    "trips": [
        row_count(), not_null("trip_id"), unique("trip_id"),
        value_range("total_distance_km", 0, 2000, threshold=0.99),
    ],
    "journeys": [row_count(), not_null("shipment_id"), unique("shipment_id")],
    "agent_shifts": [row_count(), not_null("agent_id")],
}


def run_suite(spark: SparkSession, suite: dict[str, list[Check]],
              tables: dict[str, DataFrame], now: bool = False) -> DataFrame:
    """Results of a suite; a table that is missing fails its ``table_exists`` check. With ``now`` the checks
    are computed here, and errors of single checks are results."""
    run = run_table_checks_now if now else run_table_checks
    parts = []
    for table, checks in suite.items():
        if tables.get(table) is None:
            parts.append(_error_row(spark, "table_exists", table, None,
                                    f"Path not found: {table}"))
        else:
            parts.append(run(tables[table], table, checks))
    return reduce(DataFrame.unionByName, parts)


def bronze_suite(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return run_suite(spark, BRONZE_SUITE, tables)


def silver_suite(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return run_suite(spark, SILVER_SUITE, tables)


def run_checks(spark: SparkSession, layer: str, tables: dict[str, DataFrame],
               now: bool = False) -> DataFrame:
    suites = {"bronze": BRONZE_SUITE, "silver": SILVER_SUITE, "all": {**BRONZE_SUITE, **SILVER_SUITE}}
    if layer not in suites:
        raise ValueError("layer must be one of: bronze, silver, all")
    return run_suite(spark, suites[layer], tables, now)


def quality_report(results: DataFrame, layer: str = "all",
                   run_time: str | None = None) -> DataFrame:
    """One-row summary: totals, pass rate and the list of checks. The rows are check results,
    as many as the suites declare."""
    passed = count_when(F.col("success"))
    total = F.count(F.lit(1))
    at = F.lit(run_time).cast("timestamp") if run_time else F.current_timestamp()
    details = F.struct("table", "check", "column", "success", "threshold", "actual_ratio",
                       "total_rows", "passing_rows", "actual_min", "actual_max", "actual_avg",
                       "invalid_values_sample", "message", "error")
    return results.agg(
        total.alias("total_checks"), passed.alias("passed"), (total - passed).alias("failed"),
        F.sort_array(F.collect_list(details)).alias("checks"),
    ).select(
        F.lit(layer).alias("layer"), at.alias("run_time"),
        (F.col("failed") == 0).alias("overall_success"),
        "total_checks", "passed", "failed",
        F.when(F.col("total_checks") > 0,
               rounded(F.col("passed") * 100.0 / F.col("total_checks"), 2))
        .otherwise(0.0).alias("pass_rate"), "checks")


def failed_checks(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success")).select("table", "column", "check", F.coalesce(
        "error", F.lit("Check failed")).alias("reason"))


def latest_report(reports: DataFrame) -> DataFrame:
    """The most recent report of each layer."""
    names = [c for c in reports.columns if c != "layer"]
    return reports.groupBy("layer").agg(
        F.max_by(F.struct(*names), "run_time").alias("r")).select("layer", "r.*")


# ---- model contracts ------------------------------------------------------------------------

def _keyed(*columns: str) -> list[Check]:
    return [c for column in columns for c in (unique(column), not_null(column))]


MODEL_TESTS: dict[str, list[Check]] = {
    "stg_vehicle_positions": [
        *_keyed("event_id"), not_null("vehicle_id"), not_null("latitude"), not_null("longitude"),
        accepted_values("vehicle_state", C.VEHICLE_STATES)],
    "stg_vehicle_telemetry": [
        *_keyed("event_id"), not_null("vehicle_id"),
        accepted_values("engine_temp_status", ("NORMAL", "OVERHEATING", "COLD_RUNNING"))],
    "stg_alerts": [
        *_keyed("event_id"), not_null("alert_type"), accepted_values("alert_type", C.ALERT_TYPES),
        accepted_values("severity", C.SEVERITIES)],
    "stg_shipment_events": [
        *_keyed("event_id"), not_null("shipment_id"), not_null("event_type"),
        accepted_values("event_type", C.SHIPMENT_EVENT_TYPES),
        accepted_values("journey_stage",
                        ("FIRST_MILE", "MID_MILE", "LAST_MILE", "EXCEPTION", "OTHER"))],
    "stg_agent_positions": [
        *_keyed("event_id"), not_null("agent_id"), not_null("latitude"), not_null("longitude"),
        accepted_values("agent_status", C.AGENT_STATUSES)],
    "stg_delivery_events": [
        *_keyed("event_id"), not_null("agent_id"), not_null("order_id"), not_null("event_type"),
        accepted_values("event_type", C.DELIVERY_EVENT_TYPES),
        accepted_values("delivery_outcome", ("SUCCESS", "FAILED", "ATTEMPTED", "OTHER")),
        accepted_values("customer_rating", (1, 2, 3, 4, 5))],
    "dim_time": _keyed("date_key"),
    "dim_hubs": [*_keyed("hub_id"),
                 accepted_values("hub_type", ("MEGA", "REGIONAL", "LOCAL"))],
    "fct_trips": [*_keyed("trip_key"), not_null("trip_id")],
    "fct_driver_performance": _keyed("performance_key"),
    "fct_shipments": [
        *_keyed("shipment_key"), not_null("shipment_id"),
        accepted_values("sla_status", ("MET", "BREACHED", "FAILED", "IN_PROGRESS")),
        accepted_values("journey_outcome",
                        ("DELIVERED", "FAILED", "RETURNED", "STUCK", "IN_TRANSIT"))],
    "fct_hub_daily": [*_keyed("hub_daily_key"),
                      accepted_values("efficiency_rating", ("HIGH", "MEDIUM", "LOW"))],
    "fct_agent_daily": [
        *_keyed("agent_daily_key"),
        accepted_values("performance_tier",
                        ("TOP_PERFORMER", "GOOD", "AVERAGE", "BELOW_AVERAGE"))],
    "fct_zone_daily": [
        *_keyed("zone_daily_key"),
        accepted_values("zone_performance_tier",
                        ("EXCELLENT", "GOOD", "AVERAGE", "NEEDS_IMPROVEMENT"))],
}


def run_model_tests(models: dict[str, DataFrame],
                    tests: dict[str, list[Check]] | None = None) -> DataFrame:
    """Contract tests of staging views and marts: failures per test, severity ``warn``. NULLs
    satisfy ``accepted_values`` and are ignored by ``unique``. One pass per model; the tests of a model
    that is missing have status ``error``."""
    parts, absent = [], []
    for model, checks in (MODEL_TESTS if tests is None else tests).items():
        if model not in models:
            absent += [(model, c.column, c.kind, None) for c in checks]
            continue
        failures = {}
        for i, c in enumerate(checks):
            col = F.col(c.column)
            if c.kind == "unique":
                failures[i] = F.count(col) - F.countDistinct(col)
            elif c.kind == "not_null":
                failures[i] = count_when(col.isNull())
            elif c.kind == "accepted_values":
                failures[i] = count_when(col.isNotNull() & ~col.isin(*c.values))
            else:
                failures[i] = count_when(~F.expr(c.expression))
        totals = models[model].agg(*[e.alias(f"f{i}") for i, e in failures.items()])
        rows = F.explode(F.array(*[
            F.struct(F.lit(checks[i].column).alias("column"), F.lit(checks[i].kind).alias("test"),
                     F.coalesce(F.col(f"f{i}"), F.lit(0)).alias("failures"))
            for i in failures]))
        parts.append(totals.select(F.lit(model).alias("model"), rows.alias("r"))
                     .select("model", "r.*"))
    if absent:
        spark = SparkSession.active()
        parts.append(spark.createDataFrame(absent, "model string, column string, test string, failures long"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").when(
        F.col("failures") > 0, "warn").otherwise("error"))


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The evidence behind a failed test: repeated values with their counts, or the rows."""
    col = F.col(check.column) if check.column else None
    if check.kind == "unique":
        return df.filter(col.isNotNull()).groupBy(col.alias("unique_field")).agg(
            F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    if check.kind == "not_null":
        return df.filter(col.isNull())
    if check.kind == "accepted_values":
        return df.filter(col.isNotNull() & ~col.isin(*check.values)).groupBy(
            col.alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return df.filter(~F.expr(check.expression))


def store_failing_rows(models: dict[str, DataFrame], results: DataFrame, path: str,
                       tests: dict[str, list[Check]] | None = None) -> list[str]:
    """Write the evidence behind every failed model test to a folder of its own; the folders written."""
    failed = {(r["model"], r["column"], r["test"]) for r in results.filter("failures > 0").collect()}
    folders = []
    for model, checks in (MODEL_TESTS if tests is None else tests).items():
        for check in checks:
            if (model, check.column, check.kind) in failed:
                folders.append(f"{path}/{check.kind}_{model}_{check.column}")
                failing_rows(models[model], check).write.mode("overwrite").parquet(folders[-1])
    return folders


def check_relationship(child: DataFrame, parent: DataFrame, key: str,
                       parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent and how often they occur; the keys are counted first, so a
    frequent orphan is one row in the join."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_records"))
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return keys.join(known, key, "left_anti")


def check_expression(df: DataFrame, condition: str) -> DataFrame:
    """Rows in total and rows that violate a condition."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  count_when(~F.expr(condition)).alias("failures")).withColumn(
        "success", F.col("failures") == 0)


