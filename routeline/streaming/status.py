"""Current shipment status, kept up to date by a stream.

A micro-batch adds one generation with a row per shipment that it touched, so its cost depends on the batch
alone; generations are folded level by level (``sources.versions.Generations``), so a reader merges few of
them however long the stream has run. Rows are merged by event time: an older event that arrives late
never wins. A retried batch is known by its number and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from routeline.operators.shipments import current_status
from routeline.sources.versions import Generations

_KEPT = ("current_status", "current_hub_id", "last_event_id", "last_event_type",
         "last_event_timestamp", "current_latitude", "current_longitude")


def merge_status(rows: DataFrame) -> DataFrame:
    """One row per shipment out of several status rows."""
    newest = F.max_by(F.struct(*_KEPT), F.struct("last_event_timestamp", "last_event_id"))
    return rows.groupBy("shipment_id").agg(
        newest.alias("s"), F.min("created_at").alias("created_at")).select(
        "shipment_id", "s.*", "created_at")


def status_table(spark: SparkSession, path: str, fan: int = 4) -> Generations:
    return Generations(spark, path, "shipment_id", merge_status, fan)


def upsert_status(path: str, fan: int = 4):
    """A ``foreachBatch`` function that stores the status rows of a batch."""
    def store(batch: DataFrame, batch_id: int) -> None:
        table = status_table(batch.sparkSession, path, fan)
        table.add(current_status(batch), batch_id)
        table.vacuum()
    return store


def stream_status(events: DataFrame, path: str, checkpoint: str,
                  available_now: bool = False) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(upsert_status(path)) \
        .option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_status(spark: SparkSession, path: str, shipment_id: str | None = None) -> DataFrame:
    """The current status of every shipment, or of one, for which one bucket is opened."""
    return status_table(spark, path).read(shipment_id)
