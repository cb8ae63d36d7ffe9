"""Bronze ingest: topic -> decode -> flags -> date-partitioned append table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from routeline.contracts import CONTRACTS, contract
from routeline.operators import bronze
from routeline.sources.tables import has_data, read_topic

FLAGS = {
    "vehicle_positions": lambda df: bronze.with_valid_speed(bronze.with_valid_location(df)),
    "vehicle_telemetry": lambda df: df,
    "shipment_events": lambda df: bronze.with_valid_event_type(bronze.with_valid_location(df)),
    "agent_positions": bronze.with_valid_location,
    "delivery_events": lambda df: bronze.with_valid_location(df, "delivery_lat", "delivery_lng"),
    "alerts": lambda df: df,
}


def bronze_rows(raw: DataFrame, topic: str, as_of: Column | None = None) -> DataFrame:
    """Decoded and flagged rows of a topic."""
    return FLAGS[topic](bronze.parse_events(raw, contract(topic), as_of))


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 32  # folders a task writes to at a time


@contextmanager
def open_writers(spark: SparkSession, files: int = OPEN_FILES) -> Iterator[None]:
    """Within, a task writes rows to the folders of a partitioned table as they come, up to ``files`` at a time.

    Otherwise it sorts all its rows by folder first and spills them. Rows of further folders are still sorted. A value
    set by the user stays. The setting is the session's and read by every batch, so wait for the stream within.
    """
    if int(spark.conf.get(WRITERS)) > 0:
        yield
        return
    spark.conf.set(WRITERS, str(files))
    try:
        yield
    finally:
        spark.conf.unset(WRITERS)


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 partition_cols: tuple[str, ...] = ("event_date",),
                 available_now: bool = False, name: str | None = None) -> StreamingQuery:
    """Append a stream to a partitioned table with its own checkpoint; see ``open_writers``."""
    writer = df.writeStream.format(fmt).outputMode("append") \
        .option("checkpointLocation", checkpoint)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def write_deduplicated(df: DataFrame, path: str, late_path: str, checkpoint: str, delay: str,
                       fmt: str = "parquet", available_now: bool = False) -> StreamingQuery:
    """Append the first delivery of every event; repeats are looked up in the stored days.

    A stored event is a repeat if its day is within ``delay`` of the batch's times. First
    deliveries more than ``delay`` behind the newest stored time go to ``late_path``, which
    ``read_bronze`` merges. A retried batch adds nothing, but rows without an id may repeat.
    """
    spark, span = df.sparkSession, F.expr(f"interval '{delay}'")
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{path} was written by a file sink, whose log hides other files")

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch.persist()
        rows = bronze.dedup_events(batch)
        first, last = batch.agg(F.to_date(F.min("event_timestamp") - span),
                               F.to_date(F.max("event_timestamp") + span)).first()
        newest = None
        for known in (path, late_path):
            if not has_data(session, known):
                continue
            stored = session.read.schema(batch.schema).format(fmt).load(known)
            if known == path:
                day = stored.agg(F.max("event_date")).first()[0]
                newest = stored.filter(F.col("event_date") == F.lit(day)).agg(
                    F.max("event_timestamp")).first()[0]
            near = F.col("event_date").isNull()
            if first is not None:
                near = near | F.col("event_date").between(first, last)
            rows = rows.join(stored.filter(near).select("event_id"), "event_id", "left_anti")
        rows = rows.select(*batch.columns).persist()
        late = F.coalesce(F.col("event_timestamp") < F.lit(newest).cast("timestamp") - span, F.lit(False))
        for part, target in ((rows.filter(~late), path), (rows.filter(late), late_path)):
            if target == path or not part.isEmpty():
                part.hint("rebalance", "event_date").write.format(fmt).mode("append") \
                    .partitionBy("event_date").save(target)
        rows.unpersist()
        batch.unpersist()

    writer = df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest(spark: SparkSession, topic: str, root: str, checkpoints: str, fmt: str = "kafka",
           dedup_delay: str | None = None, available_now: bool = False, sink: str = "parquet",
           **options: str) -> StreamingQuery:
    raw = read_topic(spark, topic, fmt, **options)
    rows, path = bronze_rows(raw, topic), f"{root}/bronze/{topic}"
    if dedup_delay:
        return write_deduplicated(rows, path, f"{root}/bronze_late/{topic}",
                                  f"{checkpoints}/{topic}", dedup_delay, sink, available_now)
    return write_stream(rows, path, f"{checkpoints}/{topic}", sink, available_now=available_now)


def run_streams(spark: SparkSession, root: str, checkpoints: str,
                topics: tuple[str, ...] = tuple(CONTRACTS), await_termination: bool = True,
                folder: str | None = None, **options: str) -> list[StreamingQuery]:
    """Start the selected ingests. ``folder`` holds one sub-folder per topic where the source is
    files instead of a broker."""
    unknown = set(topics) - set(CONTRACTS)
    if unknown:
        raise ValueError(f"unknown topics: {sorted(unknown)}")
    with open_writers(spark) if await_termination else nullcontext():
        queries = [
            ingest(spark, topic, root, checkpoints,
                   **(options | ({"path": f"{folder}/{topic}"} if folder else {})))
            for topic in topics]
        if await_termination:
            for running in queries:
                running.awaitTermination()
    return queries


def stop_streams(spark: SparkSession) -> None:
    for running in spark.streams.active:
        running.stop()
