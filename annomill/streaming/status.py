"""Latest status per batch from a stream of status events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .epochs import compact, read_epochs, write_epoch

FINISHED = ("completed", "failed")


def latest_status(events: DataFrame) -> DataFrame:
    """``batch_id, status, ts, event_id`` of every batch's latest event.

    Rows that it gave before may be among ``batch_id, status, ts, event_id`` again.
    A late event loses to a newer one.
    """
    return events.groupBy("batch_id").agg(
        F.max(F.struct("ts", "event_id", "status")).alias("_last")
    ).select("batch_id", "_last.status", "_last.ts", "_last.event_id")


def pending(statuses: DataFrame, finished: tuple[str, ...] = FINISHED) -> DataFrame:
    """Batches still to be watched."""
    return statuses.filter(~F.col("status").isin(*finished))


def stream_status(
    events: DataFrame, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps ``table`` (a folder) up to date; read it with ``read_status``.

    Every micro-batch writes the latest event of each of its batches; readers take
    the latest of these, so the stream has no state.  A table belongs to one
    checkpoint; ``compact_status`` keeps it short.
    """
    def save(landed: DataFrame, epoch: int) -> None:
        write_epoch(latest_status(landed), table, epoch)

    return (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(save)
        .start()
    )


def read_status(spark: SparkSession, table: str) -> DataFrame:
    """The current status of every batch."""
    return latest_status(read_epochs(spark, table))


def compact_status(spark: SparkSession, table: str) -> None:
    """Leaves one row per batch; to be run now and then, not beside the stream's own writes."""
    compact(spark, table, latest_status)
