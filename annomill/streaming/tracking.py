"""Watching jobs until none is pending.

The stream keeps the latest event of every batch as its state, one row each.  After
every micro-batch the table of all batches is written to a folder of its own, and
the batches that are still pending are counted in the same write.  When a
micro-batch that leaves none is done, or the stream idles with none left, a listener
lets the stream end.  Nothing polls, and micro-batches are never cut off.

A stream that is started again on its checkpoint goes on from its state; micro-batches
that are repeated overwrite their folder.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .epochs import drop_epochs_before, newest_epoch, write_epoch
from .status import FINISHED, latest_status


class _Ending(StreamingQueryListener):
    """Says when the micro-batch that left nothing pending is done."""

    def __init__(self):
        self.run_id: str | None = None
        self.empty_from: int | None = None
        self.may_end = threading.Event()
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._done(str(event.progress.runId), event.progress.batchId)

    def onQueryIdle(self, event) -> None:
        self._done(str(event.runId), None)

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.ended.set()
            self.may_end.set()

    def _done(self, run_id: str, epoch: int | None) -> None:
        if run_id == self.run_id and self.empty_from is not None and (epoch is None or epoch >= self.empty_from):
            self.may_end.set()


def expected_with(statuses: DataFrame, expected: DataFrame | None) -> DataFrame:
    """The status of every batch that is expected or known; NULL until it has an event."""
    if expected is None:
        return statuses
    ids = expected.select("batch_id").where("batch_id IS NOT NULL").distinct()
    return ids.join(statuses, "batch_id", "full_outer")


def _still(finished: Sequence[str]):
    return F.coalesce(~F.col("status").isin(*finished), F.lit(True))


def track_status(
    events: DataFrame,
    table: str,
    checkpoint: str,
    expected: DataFrame | None = None,
    interval: str = "10 seconds",
    finished: Sequence[str] = FINISHED,
) -> StreamingQuery:
    """Keeps ``table`` at the current status of all batches; ends when none is pending.

    ``events`` is a stream of ``batch_id, status, ts, event_id``; the latest of a batch
    counts, however late it comes.  ``expected`` has the ``batch_id`` of the batches that
    were launched, which count as pending before their first event; without it the
    batches that have an event are those to watch.  A stream that has seen no batch
    goes on.  Read the table with ``read_tracked``.

    The query is one of processing time.  ``awaitTermination`` returns when it has ended.
    """
    spark = events.sparkSession
    ending = _Ending()

    def save(statuses: DataFrame, epoch: int) -> None:
        seen = Observation()
        current = expected_with(statuses, expected).observe(
            seen, F.count_if(_still(finished)).alias("pending"), F.count(F.lit(1)).alias("batches"))
        write_epoch(current, table, epoch)
        found = seen.get
        ending.empty_from = epoch if found.get("batches") and not found.get("pending") else None
        # One epoch holds everything; the one before stays for whoever reads it.
        drop_epochs_before(spark, table, epoch - 1)

    last = newest_epoch(spark, table)
    if last is not None:
        known = read_tracked(spark, table)
        counts = known.agg(F.count_if(_still(finished)).alias("pending"), F.count(F.lit(1)).alias("batches")).first()
        # Idle at once: all that was known before has finished.
        ending.empty_from = last if counts["batches"] and not counts["pending"] else None
    spark.streams.addListener(ending)
    try:
        query = (
            latest_status(events).writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).foreachBatch(save).start()
        )
    except BaseException:
        spark.streams.removeListener(ending)
        raise
    ending.run_id = str(query.runId)
    if not query.isActive:
        ending.may_end.set()

    def end() -> None:
        ending.may_end.wait()
        if query.isActive:
            query.stop()
        spark.streams.removeListener(ending)

    threading.Thread(target=end, name=f"ends-{query.runId}", daemon=True).start()
    return query


def read_tracked(spark: SparkSession, table: str) -> DataFrame:
    """``batch_id, status, ts, event_id`` of every batch, as of the newest micro-batch."""
    last = newest_epoch(spark, table)
    if last is None:
        raise FileNotFoundError(f"nothing was written to {table} yet")
    return spark.read.parquet(f"{table}/epoch={last}")


def still_pending(spark: SparkSession, table: str, finished: tuple[str, ...] = FINISHED) -> DataFrame:
    """Batches of the table that are to be watched further, those without an event too."""
    return read_tracked(spark, table).filter(_still(finished))
