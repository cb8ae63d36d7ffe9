"""Readers of topics, bronze tables and dataset trees."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeline.contracts import CONTRACTS

# Dataset layout below a data root
BRONZE_PATHS = {topic: f"bronze/{topic}" for topic in CONTRACTS}
SILVER_PATHS = {
    "trips": "silver/fleet/trips",
    "journeys": "silver/shipment/journeys",
    "agent_shifts": "silver/delivery/agent_shifts",
    "zone_performance": "silver/delivery/zone_performance",
}
DATASET_PATHS = {**BRONZE_PATHS, **SILVER_PATHS}
CORE_DATASETS = ("vehicle_positions", "shipment_events", "delivery_events", "trips", "journeys",
                 "agent_shifts")


def read_topic(spark: SparkSession, topic: str, fmt: str = "kafka", **options: str) -> DataFrame:
    """An unbounded topic as (key, value) rows.

    ``kafka`` reads from the earliest offset and tolerates expired data; ``text`` reads a folder
    of JSON lines, oldest file first; ``parquet`` reads a folder of (key, value) files.
    """
    reader = spark.readStream
    if fmt == "kafka":
        settings = {"subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false",
                    **options}
        return reader.format("kafka").options(**settings).load()
    path = options.pop("path")
    if fmt == "text":
        return reader.format("text").options(**options).load(path)
    if fmt == "parquet":
        return reader.schema("key string, value string").options(**options).parquet(path)
    raise ValueError("fmt must be kafka, text or parquet")


def read_bronze(spark: SparkSession, root: str, table: str, date: str | None = None,
                lookback_days: int = 0) -> DataFrame:
    """A bronze table with its late rows, or one day of it (plus earlier days); the filter prunes
    partitions."""
    df = spark.read.parquet(f"{root}/bronze/{table}")
    if has_data(spark, f"{root}/bronze_late/{table}"):
        df = df.unionByName(spark.read.parquet(f"{root}/bronze_late/{table}"))
    if date is None:
        return df
    day = F.lit(date).cast("date")
    return df.filter(F.col("event_date").between(F.date_sub(day, lookback_days), day))


def read_parquet_tree(spark: SparkSession, path: str) -> DataFrame:
    """All parquet files below a folder; partition columns are kept where the folder has them."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"No parquet files found under: {path}") from error


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds parquet files (a metadata look-up, no scan)."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def dataset(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A dataset below ``root``, columns matched by name across files, bronze with its late rows; None if absent."""
    paths = [DATASET_PATHS[name], *([f"bronze_late/{name}"] if name in BRONZE_PATHS else [])]
    found = None
    for path in paths:
        try:
            rows = read_parquet_tree(spark, f"{root}/{path}")
        except FileNotFoundError:
            continue
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found


def register_sources(spark: SparkSession, root: str) -> list[str]:
    """Register every dataset below ``root`` as a temporary view; absent datasets are skipped. Returns the
    registered names."""
    names = []
    for name in DATASET_PATHS:
        rows = dataset(spark, root, name)
        if rows is not None:
            rows.createOrReplaceTempView(name)
            names.append(name)
    return names


def resolve_root(spark: SparkSession, candidates: Iterable[str]) -> str:
    """The candidate with the most datasets; the first one wins a tie."""
    roots = list(candidates)
    return max(roots, key=lambda r: (sum(has_data(spark, f"{r}/{p}")
                                         for p in DATASET_PATHS.values()), -roots.index(r)))


def data_root(spark: SparkSession, live: str, sample: str, mode: str = "auto") -> str:
    """The live root when asked for, or in auto mode when all its core datasets are there."""
    if mode == "live":
        return live
    ready = mode == "auto" and all(
        has_data(spark, f"{live}/{DATASET_PATHS[name]}") for name in CORE_DATASETS)
    return live if ready else sample


class ScanCache:
    """Scans shared by several consumers, cached once per path and released together."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._scans: dict[str, DataFrame] = {}

    def get(self, path: str) -> DataFrame:
        if path not in self._scans:
            self._scans[path] = read_parquet_tree(self._spark, path).cache()
        return self._scans[path]

    def close(self) -> None:
        for scan in self._scans.values():
            scan.unpersist()
        self._scans.clear()

    def __enter__(self) -> ScanCache:
        return self

    def __exit__(self, *_) -> None:
        self.close()
