"""Dimensions: hubs, calendar, cells, parties, and slowly changing history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routeline import contracts as C
from routeline.functions import clock, geo, labels
from routeline.functions.values import count_when, rounded, safe_div, surrogate_key


def dim_hubs(spark: SparkSession) -> DataFrame:
    """The ten master hubs with tier and region code."""
    hubs = spark.createDataFrame([tuple(h) for h in C.HUBS], C.HUB_SCHEMA)
    kind, region = F.col("hub_type"), F.col("region")
    tier = labels.first_match([(kind == "MEGA", 1), (kind == "REGIONAL", 2),
                               (kind == "LOCAL", 3)], 4)
    code = F.when(region.isin("North", "South", "East", "West"),
                  F.concat(F.lit("IN-"), F.substring(region, 1, 1))).otherwise("IN-OT")
    return hubs.withColumns({"hub_tier": tier, "region_code": code})


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                      F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def calendar(days: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes for a frame of days."""
    d = F.col(day)
    return days.select(d.alias("date_key"), d.alias("full_date"),
                       *[c.alias(name) for name, c in clock.date_parts(d).items()])


def dim_time(spark: SparkSession, start: str = "2024-01-01", end: str = "2026-12-31") -> DataFrame:
    return calendar(date_spine(spark, start, end))


def event_calendar(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Calendar of the days an event table touches."""
    return calendar(events.select(F.to_date(ts).alias("date_day")).distinct())


def hour_attributes(hours: DataFrame, ts: str = "hour_start") -> DataFrame:
    """Hour-grain time dimension over a frame of hour starts."""
    t, hour = F.col(ts), F.hour(ts)
    dow = clock.day_of_week(t)
    return hours.select(
        F.date_format(t, "yyyyMMddHH").cast("int").alias("time_key"),
        F.to_date(t).alias("full_date"), F.year(t).alias("year"), F.quarter(t).alias("quarter"),
        F.month(t).alias("month"), F.date_format(t, "MMMM").alias("month_name"),
        F.weekofyear(t).alias("week_of_year"), F.dayofmonth(t).alias("day_of_month"),
        (F.weekday(t) + 1).alias("day_of_week"), F.date_format(t, "EEEE").alias("day_name"),
        hour.alias("hour"), (F.pmod(hour + 11, F.lit(12)) + 1).alias("hour_12"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        labels.time_band(hour).alias("time_band"), dow.isin(0, 6).alias("is_weekend"),
        labels.is_peak_hour(hour).alias("is_peak_hour"),
        (hour.between(9, 17) & ~dow.isin(0, 6)).alias("is_business_hour"),
    )


def dim_time_hourly(spark: SparkSession, start: str, end: str) -> DataFrame:
    days = date_spine(spark, start, end)
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)),
                        lambda h: F.timestamp_add("HOUR", h, F.col("date_day").cast("timestamp")))
    return hour_attributes(days.select(F.explode(hours).alias("hour_start")))


def event_hours(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Hour-grain dimension of the hours an event table touches."""
    return hour_attributes(events.select(F.date_trunc("hour", ts).alias("hour_start")).distinct())


def dim_geography(deliveries: DataFrame) -> DataFrame:
    """Delivery cells with their centre, coarser parents and delivery record."""
    lat, lng = F.col("delivery_lat"), F.col("delivery_lng")
    cells = deliveries.filter(lat.isNotNull() & lng.isNotNull()).groupBy(
        rounded(lat, 2).alias("center_latitude"), rounded(lng, 2).alias("center_longitude")).agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        count_when(F.col("event_type") == "DELIVERED").alias("successful_deliveries"),
        F.avg("time_at_location_seconds").alias("avg_seconds_at_stop"))
    lat, lng = F.col("center_latitude"), F.col("center_longitude")
    return cells.select(
        geo.geo_cell(lat, lng, 9).alias("geo_key"),
        geo.geo_cell(rounded(lat, 1), rounded(lng, 1), 7).alias("geo_key_coarse"),
        "center_latitude", "center_longitude", "total_deliveries",
        safe_div(F.col("successful_deliveries") * 100.0, F.col("total_deliveries"))
        .alias("avg_delivery_success_rate"),
        (F.col("avg_seconds_at_stop") / 60.0).alias("avg_delivery_time_minutes"),
        labels.at_least(F.col("total_deliveries"), ((100, "HIGH"), (20, "MEDIUM")), "LOW")
        .alias("order_density_category"),
    )


def _shipment_orders(events: DataFrame) -> DataFrame:
    """One row per shipment with the attributes the party dimensions need."""
    at = F.struct("event_timestamp", "event_id")
    return events.groupBy("shipment_id").agg(
        F.max_by(F.struct("customer_id", "seller_id", "cod_amount", "weight_kg", "origin_hub"),
                 at).alias("s"),
        F.min("event_timestamp").alias("first_time"),
        F.max((F.col("event_type") == "DELIVERED").cast("int")).alias("delivered"),
    ).select("s.*", F.to_date("first_time").alias("order_date"), "delivered")


def dim_customers(events: DataFrame) -> DataFrame:
    return _shipment_orders(events).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.avg("cod_amount").alias("avg_order_value"),
        (F.avg("delivered") * 100.0).alias("delivery_success_rate"),
    ).withColumn("customer_key", surrogate_key(F.col("customer_id")))


def dim_sellers(events: DataFrame) -> DataFrame:
    """Sellers with volumes; the primary hub is the most used origin (ties: smallest id)."""
    per_hub = _shipment_orders(events).groupBy("seller_id", "origin_hub", "order_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight_kg").alias("kg"))
    by_hub = per_hub.groupBy("seller_id", "origin_hub").agg(
        F.sum("n").alias("n"), F.sum("kg").alias("kg"))
    days = per_hub.groupBy("seller_id").agg(F.countDistinct("order_date").alias("days"))
    return by_hub.groupBy("seller_id").agg(
        F.sum("n").alias("total_shipments"), F.sum("kg").alias("_kg"),
        F.min_by("origin_hub", F.struct(-F.col("n"), "origin_hub")).alias("primary_hub_id"),
    ).join(days, "seller_id").select(
        surrogate_key(F.col("seller_id")).alias("seller_key"), "seller_id", "primary_hub_id",
        "total_shipments",
        (F.col("total_shipments") / F.col("days")).alias("avg_daily_shipments"),
        (F.col("_kg") / F.col("total_shipments")).alias("avg_weight_kg"),
    )


def scd2_merge(current: DataFrame, incoming: DataFrame, key: str, as_of: str) -> DataFrame:
    """Next state of a type-2 dimension.

    ``current`` holds all versions (``effective_from``, ``effective_to``, ``is_current``);
    ``incoming`` holds one row per key. A changed or vanished key closes its open version at
    ``as_of``; a changed or new key opens one. Unchanged rows pass through, so merging the same
    input twice changes nothing.
    """
    attributes = [c for c in incoming.columns if c != key]
    day = F.lit(as_of).cast("date")
    closed = current.filter(~F.col("is_current"))
    live = current.filter("is_current").withColumn("_old", F.xxhash64(*attributes))
    fresh = incoming.withColumn("_new", F.xxhash64(*attributes))
    both = live.alias("c").join(fresh.alias("n"), key, "full_outer")
    known, seen = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    # hash first, then the values themselves: a collision must not hide a change
    same = (F.col("_old") == F.col("_new")) & F.struct(
        *[F.col(f"c.{a}") for a in attributes]).eqNullSafe(
        F.struct(*[F.col(f"n.{a}") for a in attributes]))
    stays = known & seen & same
    versions = F.array_compact(F.array(
        F.when(known, F.struct(
            *[F.col(f"c.{a}").alias(a) for a in attributes], F.col("effective_from"),
            F.when(stays, F.col("effective_to")).otherwise(day).alias("effective_to"),
            stays.alias("is_current"))),
        F.when(seen & ~F.coalesce(stays, F.lit(False)), F.struct(
            *[F.col(f"n.{a}").alias(a) for a in attributes], day.alias("effective_from"),
            F.lit(None).cast("date").alias("effective_to"), F.lit(True).alias("is_current"))),
    ))
    merged = both.select(key, F.explode(versions).alias("v")).select(key, "v.*")
    return closed.select(merged.columns).unionByName(merged)


def scd2_history(changes: DataFrame, key: str, ts: str, attributes: list[str]) -> DataFrame:
    """Type-2 history of a change log that has at most one row per key and day: rows that repeat
    the previous attributes are folded away."""
    order = Window.partitionBy(key).orderBy(ts)
    state = F.struct(*attributes)
    kept = changes.withColumn("_same", F.lag(state).over(order).eqNullSafe(state)) \
        .filter(~F.col("_same"))
    until = F.lead(ts).over(order)
    return kept.select(key, *attributes, F.col(ts).alias("effective_from"),
                       until.alias("effective_to"), until.isNull().alias("is_current"))
