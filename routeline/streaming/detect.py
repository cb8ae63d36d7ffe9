"""Detection on unbounded positions: speeding, harsh driving, stops, failures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from routeline import contracts as C
from routeline.functions.clock import elapsed
from routeline.operators import alerting, fleet
from routeline.operators.bronze import with_event_watermark
from routeline.operators.timeline import Timeline, with_neighbours
from routeline.sources.versions import Generations


def stream_speeding(positions: DataFrame, limit: float = C.LIMITS.speeding_kmh,
                    delay: str = "1 minute") -> DataFrame:
    """Graded speeding alerts as a stream."""
    return alerting.speeding_alerts(with_event_watermark(positions, delay), limit)


def stream_failure_alerts(deliveries: DataFrame) -> DataFrame:
    return alerting.delivery_failure_records(deliveries)


def _alert_table(spark: SparkSession, path: str) -> Generations:
    return Generations(spark, path, "entity_id", alerting.worst_alerts)


def stream_alerts(alerts: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Unify alert records into a table that keeps the worst of each (module, type, entity, time).

    The state is the table itself, so a repeat is known however late it comes: a worse one corrects the row,
    a lesser one changes nothing. ``read_alerts`` gives the batch answer over all records so far.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        table = _alert_table(batch.sparkSession, path)
        table.add(batch.select(*alerting.ALERT_COLUMNS), batch_id)
        table.vacuum()

    writer = alerts.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return alerting.with_alert_ids(_alert_table(spark, path).read())


def as_messages(df: DataFrame) -> DataFrame:
    """One JSON ``value`` per row, for a message sink."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


_POINT = ("event_id", "vehicle_id", "driver_id", "vehicle_type", "event_timestamp", "latitude",
          "longitude", "speed_kmh")
_BEFORE = {"prev_timestamp": "event_timestamp", "prev_speed": "speed_kmh",
           "prev_lat": "latitude", "prev_lng": "longitude"}


def link_points(points: DataFrame, line: Timeline = fleet.BY_VEHICLE) -> DataFrame:
    """Points with the point before each; a hot vehicle is split like in a batch table."""
    return with_neighbours(points, line, previous=_BEFORE)


def _with_closed(points: DataFrame, seen: DataFrame, lateness: str) -> DataFrame:
    """Flag the points earlier than ``lateness`` before the newest point of their vehicle in
    ``seen``. Points without a time come first in a series, so they are closed with any point."""
    cuts = seen.groupBy(F.col("vehicle_id").alias("_vehicle")).agg(
        (F.max("event_timestamp") - F.expr(f"interval '{lateness}'")).alias("_cut"))
    time, cut = F.col("event_timestamp"), F.col("_cut")
    closed = F.coalesce(cut.isNotNull() & (time.isNull() | (time < cut)), F.lit(False))
    return points.join(cuts, F.col("vehicle_id").eqNullSafe(F.col("_vehicle")), "left") \
        .withColumn("_closed", closed).drop("_vehicle", "_cut")


def stream_linked(positions: DataFrame, detect: Callable[[DataFrame], DataFrame], path: str,
                  checkpoint: str, available_now: bool = False,
                  lateness: str = "1 hour") -> StreamingQuery:
    """Run ``detect`` over linked points; the rows below ``path/events`` are the batch answer over
    the points so far, in whatever order they arrived.

    A vehicle's time is closed up to ``lateness`` before its newest point. Rows of closed time are
    appended in a folder per batch; those of open time are in the folder ``batch=-1``, which every
    batch replaces. The open points and the last closed one of each vehicle are held in two
    alternating folders: a batch reads the one its predecessor wrote and writes the other, so a
    retried batch finds its input unchanged and replaces its output. Closed points are kept below
    ``path/points``: a point that comes later than ``lateness`` has all of them linked anew and the
    events replaced, so ``lateness`` bounds the work, not the result.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        points = batch.select(*_POINT, F.lit(False).alias("_known"))
        again = False
        if batch_id:
            held = spark.read.parquet(f"{path}/held/{(batch_id - 1) % 2}")
            again = not _with_closed(batch, held, lateness).filter("_closed").isEmpty()
            if again:  # every closed point is linked anew
                past = spark.read.parquet(f"{path}/points").filter(F.col("batch") < batch_id)
                held = held.filter("not _known").unionByName(
                    past.select(*_POINT, F.lit(True).alias("_known")))
            points = points.unionByName(held)
        points = _with_closed(points, points, lateness).persist()
        linked = link_points(points).persist()
        closed = linked.filter("_closed" if again else "_closed and not _known")
        if again:
            detect(closed).withColumn("batch", F.lit(batch_id)).write.mode("overwrite") \
                .option("partitionOverwriteMode", "static").partitionBy("batch") \
                .parquet(f"{path}/events")
        else:
            detect(closed).write.mode("overwrite").parquet(f"{path}/events/batch={batch_id}")
        detect(linked.filter("not _closed")).write.mode("overwrite").parquet(
            f"{path}/events/batch=-1")
        points.filter("_closed and not _known").select(*_POINT).write.mode("overwrite").parquet(
            f"{path}/points/batch={batch_id}")
        newest = F.max_by(F.struct(*_POINT), F.struct("event_timestamp", "event_id"))
        last = points.filter("_closed").groupBy("vehicle_id").agg(newest.alias("p")).select(
            "p.*", F.lit(True).alias("_known"))
        points.filter("not _closed").select(*_POINT, F.lit(False).alias("_known")) \
            .unionByName(last).write.mode("overwrite").parquet(f"{path}/held/{batch_id % 2}")
        for kept in (linked, points, batch):
            kept.unpersist()

    writer = positions.select(*_POINT).writeStream.foreachBatch(store) \
        .option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def driving_events_of(linked: DataFrame) -> DataFrame:
    """Speeding, harsh braking and harsh acceleration between linked points."""
    seconds = elapsed(F.col("prev_timestamp"), F.col("event_timestamp"), "seconds")
    event = fleet.driving_event(F.coalesce("prev_speed", "speed_kmh"), F.col("speed_kmh"),
                                seconds, F.col("vehicle_type"))
    return linked.select(
        "event_id", "vehicle_id", "driver_id", "event_timestamp", "latitude", "longitude",
        *[c.alias(n) for n, c in event.items()]).filter("event_type is not null")


def stream_driving_events(positions: DataFrame, path: str, checkpoint: str,
                          available_now: bool = False,
                          lateness: str = "1 hour") -> StreamingQuery:
    return stream_linked(positions, driving_events_of, path, checkpoint, available_now, lateness)


def stream_geofence(positions: DataFrame, fences: DataFrame, path: str, checkpoint: str,
                    available_now: bool = False, lateness: str = "1 hour") -> StreamingQuery:
    located = positions.filter("latitude is not null and longitude is not null")
    return stream_linked(located, lambda linked: alerting.crossings(linked, fences), path, checkpoint,
                         available_now, lateness)


def read_geofence_events(spark: SparkSession, path: str) -> DataFrame:
    """The crossings found so far, exits with the dwell time: ENTRY and EXIT of a visit may come from batches far
    apart and in any order, so they are paired when read. Stored are points with the fences entered and left there."""
    return alerting.with_dwell(spark.read.parquet(f"{path}/events").drop("batch"))


def stream_stops(positions: DataFrame, gap: str = "5 minutes", delay: str = "10 minutes",
                 max_speed_kmh: float = C.LIMITS.stop_speed_kmh,
                 min_seconds: float = C.LIMITS.stop_seconds) -> DataFrame:
    """Stops as session windows over slow points; a session closes behind the watermark."""
    slow = positions.filter(F.col("speed_kmh") < max_speed_kmh) \
        .withWatermark("event_timestamp", delay)
    sessions = slow.groupBy("agent_id", F.session_window("event_timestamp", gap).alias("w")).agg(
        F.min("event_timestamp").alias("stop_start"), F.max("event_timestamp").alias("stop_end"),
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"),
        F.count(F.lit(1)).alias("position_count"))
    seconds = elapsed(F.col("stop_start"), F.col("stop_end"), "seconds")
    return sessions.withColumn("stop_seconds", seconds).drop("w") \
        .filter(F.col("stop_seconds") >= min_seconds)
