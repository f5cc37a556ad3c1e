"""Usage per part, kept current while output files land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.usage import add_partials, merge_usage, usage_partials
from .epochs import compact, read_epochs, write_epoch


def stream_usage(
    outputs: DataFrame, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Writes each micro-batch's partial sums to its own folder of ``table``.

    The sums add up however the files of a part are spread over micro-batches,
    a repeated micro-batch overwrites its folder, and there is no state.  A
    table belongs to one checkpoint.
    """
    def save(landed: DataFrame, epoch: int) -> None:
        numbered = landed.withColumn("file_pos", F.monotonically_increasing_id())
        write_epoch(usage_partials(numbered), table, epoch)

    return (
        outputs.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(save)
        .start()
    )


def read_usage(spark: SparkSession, table: str) -> DataFrame:
    """Current usage per part, as ``batch_usage`` gives it for a finished run."""
    return merge_usage(read_epochs(spark, table))


def compact_usage(spark: SparkSession, table: str) -> None:
    """Leaves one row per run, part and model; to be run now and then, not beside the stream's own writes."""
    compact(spark, table, add_partials)
