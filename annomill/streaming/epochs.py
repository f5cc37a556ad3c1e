"""Tables of one folder per micro-batch, and their compaction.

A repeated micro-batch overwrites its folder.  Compaction writes the merged rows of
all folders so far to ``upto=<last epoch>``; readers take the newest complete one
and the epochs after it, so a compaction that breaks off changes nothing, and what
it replaced is taken away only after it is complete.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_epoch(rows: DataFrame, table: str, epoch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{table}/epoch={epoch}", compression="zstd")


def _files(spark: SparkSession, table: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, table: str) -> tuple[list[int], list[int]]:
    """Epochs and ends of compactions that are complete."""
    place, files = _files(spark, table)
    found: dict[str, list[int]] = {"epoch": [], "upto": []}
    for status in files.listStatus(place) if files.exists(place) else []:
        kind, _, number = status.getPath().getName().partition("=")
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if kind in found and files.exists(done):
            found[kind].append(int(number))
    return sorted(found["epoch"]), sorted(found["upto"])


def newest_epoch(spark: SparkSession, table: str) -> int | None:
    """The last micro-batch whose folder is complete."""
    epochs, _ = folders(spark, table)
    return epochs[-1] if epochs else None


def drop_epochs_before(spark: SparkSession, table: str, epoch: int) -> None:
    """For tables whose every epoch holds all rows."""
    epochs, _ = folders(spark, table)
    _, files = _files(spark, table)
    for old in epochs:
        if old < epoch:
            files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/epoch={old}"), True)


def read_epochs(spark: SparkSession, table: str, schema: StructType | str | None = None) -> DataFrame:
    """The rows of the newest compaction and of the epochs after it."""
    epochs, compacted = folders(spark, table)
    last = compacted[-1] if compacted else -1
    paths = [f"{table}/upto={last}"] * bool(compacted) + [f"{table}/epoch={e}" for e in epochs if e > last]
    if not paths:
        raise FileNotFoundError(f"nothing was written to {table} yet")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_folders(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*paths)


def remove_folders(spark: SparkSession, table: str, epochs: list[int], compacted: list[int]) -> None:
    """Takes away micro-batches, and compactions before a newer one."""
    _, files = _files(spark, table)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in [f"epoch={e}" for e in epochs] + [f"upto={u}" for u in compacted]:
        files.delete(path(f"{table}/{name}"), True)


def compact(spark: SparkSession, table: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merges all epochs so far.  ``merge`` must give rows of the table's form that stand for the merged ones."""
    epochs, compacted = folders(spark, table)
    if not epochs or compacted and compacted[-1] >= epochs[-1]:
        return
    merge(read_epochs(spark, table)).write.mode("overwrite").parquet(f"{table}/upto={epochs[-1]}")
    remove_folders(spark, table, epochs, compacted)
