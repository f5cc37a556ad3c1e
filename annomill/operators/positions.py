"""Numbering rows without sorting them all in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

# Where a row of a file scan comes from.  ``file_pos`` grows along a split.
POSITION = ("file_path", "file_block", "file_pos")

# monotonically_increasing_id() puts the row's place in the low 33 bits.
_PLACE_BITS = 33


def position_columns():
    """``POSITION`` for a file scan that has not been shuffled or filtered.

    Positions order the rows of one scan.  Another scan of the same files may
    be cut differently (the cluster may have grown), so whatever is compared
    with them must come from the same scan: see ``stored``.
    """
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("file_pos"),
    ]


def split_offsets(rows: DataFrame, per_file: bool) -> DataFrame:
    """Rows before each split: ``file_path, file_block, first, before, n_rows``.

    Counted over the split's file, or over all files by name.  ``rows`` must
    be a stored table.  One row per split comes out, so the running sum is
    over a short table; it is stored as well, so that Spark knows its size.
    """
    first, last = F.min("file_pos"), F.max("file_pos")
    gap = F.raise_error(F.lit("rows are missing between positions; order them by a column instead"))
    splits = rows.groupBy("file_path", "file_block").agg(
        F.when(last - first + 1 == F.count("*"), F.count("*")).otherwise(gap).alias("n"),
        first.alias("first"),
    )
    if per_file:
        whole, order = Window.partitionBy("file_path"), ["file_block"]
    else:
        whole, order = Window.partitionBy(), ["file_path", "file_block"]
    earlier = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return stored(splits.select(
        "file_path", "file_block", "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("n_rows"),
    ), "split-offsets")


def index_in_files(rows: DataFrame, per_file: bool = False) -> DataFrame:
    """Adds ``row_index`` and ``n_rows`` to a stored table with ``POSITION``."""
    columns = [name for name in rows.columns if name not in POSITION]
    if per_file:
        columns.append("file_path")
    offsets = split_offsets(rows, per_file)
    return rows.join(offsets, ["file_path", "file_block"]).select(
        *columns, (F.col("before") + F.col("file_pos") - F.col("first")).alias("row_index"), "n_rows"
    )


def with_file_index(rows: DataFrame) -> DataFrame:
    """Adds ``row_index`` (0-based, in the order of the files) and ``n_rows``.

    ``rows`` are a file scan with its ``POSITION`` columns, which are dropped.
    The scan is stored once and joined with one row per split; nothing is
    sorted.
    """
    return index_in_files(stored(rows, "row-index"))


def with_row_index(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """Adds ``row_index`` (0-based, by ``order_by``) and ``n_rows``.

    Rows are range-partitioned, numbered inside each partition and stored
    once; only the partitions' sizes are added up globally.  Equal keys are
    told apart by their place in the input, so many copies of one key still
    spread over partitions.
    """
    place = F.monotonically_increasing_id()
    placed = stored(
        rows.withColumn("_tie", place)
        .repartitionByRange(*order_by, "_tie")
        .sortWithinPartitions(*order_by, "_tie")
        .drop("_tie")
        .withColumn("_place", place),
        "row-index",
    )
    number = F.shiftright("_place", _PLACE_BITS)
    whole = Window.partitionBy()
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition.
    ranges = (
        placed.groupBy(number.alias("_range")).agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
                F.sum("_n").over(whole).alias("n_rows"))
    )
    within = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return placed.withColumn("_range", number).join(F.broadcast(ranges), "_range").select(
        *rows.columns, (F.col("_start") + within).alias("row_index"), "n_rows"
    )
