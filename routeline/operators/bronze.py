"""Decode and validate raw events. Every function works on batch and streaming input."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeline import contracts as C


def parse_events(df: DataFrame, schema: T.StructType, as_of: Column | None = None) -> DataFrame:
    """Decode the JSON ``value`` of a topic into contract columns.

    Malformed payloads become rows of NULLs and unparseable times become NULL, so nothing is
    lost before the quality checks see it.
    """
    key = F.col("key").cast("string") if "key" in df.columns else F.lit(None).cast("string")
    payload = F.from_json(F.col("value").cast("string"), schema)
    return (
        df.select(key.alias("kafka_key"), payload.alias("data"))
        .select("kafka_key", "data.*")
        .withColumns({
            "event_timestamp": F.try_to_timestamp(F.col("timestamp")),
            "ingestion_timestamp": as_of if as_of is not None else F.current_timestamp(),
        })
        .withColumn("event_date", F.to_date("event_timestamp"))
    )


def in_service_area(lat: Column, lng: Column, bounds: C.Bounds = C.BOUNDS) -> Column:
    return lat.between(bounds.lat_min, bounds.lat_max) \
        & lng.between(bounds.lng_min, bounds.lng_max)


def with_valid_location(df: DataFrame, lat: str = "latitude", lng: str = "longitude",
                        bounds: C.Bounds = C.BOUNDS) -> DataFrame:
    """Flag points inside the service area; NULL coordinates give a NULL flag."""
    return df.withColumn("is_valid_location", in_service_area(F.col(lat), F.col(lng), bounds))


def with_valid_speed(df: DataFrame, null_ok: bool = True,
                     limit: float = C.LIMITS.max_speed_kmh) -> DataFrame:
    """Flag speeds in 0..limit; a missing speed counts as ``null_ok``."""
    ok = F.coalesce(F.col("speed_kmh").between(0, limit), F.lit(null_ok))
    return df.withColumn("is_valid_speed", ok)


def with_valid_event_type(df: DataFrame,
                          allowed: Iterable[str] = C.SHIPMENT_EVENT_TYPES) -> DataFrame:
    return df.withColumn("is_valid_event_type", F.col("event_type").isin(*allowed))


def valid_positions(df: DataFrame) -> DataFrame:
    """Points with both coordinates inside the service area. The predicate on the coordinates
    is explicit, so it reaches the file scan even where the flag is computed."""
    known = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    flag = F.col("is_valid_location") if "is_valid_location" in df.columns \
        else in_service_area(F.col("latitude"), F.col("longitude"))
    return df.filter(known & flag)


def stamp(df: DataFrame, column: str, as_of: Column | str | None = None) -> DataFrame:
    """Run-metadata timestamp; pass ``as_of`` to make reruns reproducible."""
    if as_of is None:
        return df.withColumn(column, F.current_timestamp())
    value = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return df.withColumn(column, value)


def dedup_events(df: DataFrame) -> DataFrame:
    """One row per ``event_id``; rows without an id are not repeats of each other."""
    return df.filter("event_id is not null").dropDuplicates(["event_id"]) \
        .unionByName(df.filter("event_id is null"))


def with_event_watermark(df: DataFrame, delay: str = "5 minutes") -> DataFrame:
    return df.withWatermark("event_timestamp", delay)


def alias_columns(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Backfill each canonical column from the first candidate the frame has."""
    added = {}
    for name, candidates in aliases.items():
        source = next((c for c in candidates if c in df.columns), None)
        if name not in df.columns and source:
            added[name] = F.col(source)
    return df.withColumns(added) if added else df


TRIP_ALIASES = {"distance_km": ["total_distance_km"],
                "duration_minutes": ["trip_duration_minutes"]}
