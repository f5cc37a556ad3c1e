"""Annotations from output files as they land."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.annotate import annotate_marked
from ..session import files_open_together
from ..sinks.layout import write_by_id
from ..sources.outputs import flatten_outputs
from ..sources.prompts import only_prompts, prompt_map


def landing_outputs(
    spark: SparkSession,
    base: str,
    file_glob: str = "output.jsonl",
    max_files: int | None = None,
    content: bool = True,
) -> DataFrame:
    """A stream of flat output rows; each file is taken in once.

    A usage stream needs no ``content``.
    """
    reader = (
        spark.readStream.schema(schemas.output(content))
        .option("recursiveFileLookup", True).option("pathGlobFilter", file_glob)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return flatten_outputs(reader.json(base), position=False, content=content)


def prompts_by_id(prompts: DataFrame, table: str, path: str, buckets: int, order_by: Column | None = None) -> DataFrame:
    """A table of prompts that ``stream_outputs`` joins without moving it; ``order_by`` is that of ``attach_prompts``.

    It needs at least as many buckets as shuffles have partitions: Spark moves both sides to
    the larger number.
    """
    least = int(prompts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if buckets < least:
        raise ValueError(f"{buckets} buckets are fewer than the {least} partitions of a shuffle: the prompts would move")
    source = only_prompts(prompts) if order_by is None else prompt_map(prompts, order_by)
    return write_by_id(source.where("custom_id IS NOT NULL"), table, path, buckets)


def stream_outputs(
    outputs: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    prompts: DataFrame | None = None, **annotate,
) -> StreamingQuery:
    """Appends long annotations and bad lines to a Parquet folder, exactly once.

    Read them with ``read_annotations`` and ``read_quarantine``; they lie in folders
    of their own.  ``annotate`` are the options of ``annotate_marked``; with
    ``keep=("run",)`` the annotations say which run they belong to.

    ``prompts`` is a table of ``prompts_by_id``.  A micro-batch then moves its own
    annotations to the buckets of the prompts, which are read where they lie; an
    unknown id gets ``""``.
    """
    rows = annotate_marked(outputs, **annotate)
    if prompts is not None:
        # The size of a micro-batch is not known beforehand, and the prompts' is no reason to send them around.
        known = prompts.select("custom_id", "prompt").hint("merge")
        joined = rows.join(known, "custom_id", "left")
        prompt = F.when(~F.col("quarantined"), F.coalesce("prompt", F.lit("")))
        rows = joined.select(*rows.columns, prompt.alias("prompt"))
    # The stream keeps the setting it starts with: good and bad lines are written side by side, unsorted.
    with files_open_together(outputs.sparkSession, 2):
        return (
            rows.writeStream.format("parquet").outputMode("append")
            .partitionBy("quarantined").options(path=path, checkpointLocation=checkpoint, compression="zstd")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """The annotations of a stream's folder."""
    return spark.read.parquet(path).where("quarantined = 'false'").drop("quarantined", "part", "file_path", "corrupt_record")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The bad lines of a stream's folder, with where they came from."""
    rows = spark.read.parquet(path).where("quarantined = 'true'")
    reason = [name for name in ("finish_reason",) if name in rows.columns]
    return rows.select("file_path", "demand", "part", "custom_id", *reason, "corrupt_record")
