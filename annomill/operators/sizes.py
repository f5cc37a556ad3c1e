"""Size checks and skew-proof joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import POSITION

# A dimension is held in every task only if it measures at most this much.
IN_MEMORY_BYTES = 16 * 1024 * 1024

# A join key with more rows than this is cut into slices of at most as many.
SLICE_ROWS = 200_000

# Rows that match nothing because their key is NULL get slices of their own.
_NULL_SLICES = (1 << 31) - 1


def fits_in_memory(frame: DataFrame, limit: int = IN_MEMORY_BYTES) -> bool:
    """Measures a dimension's bytes as JSON.  Runs a job."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    return (frame.agg(size.alias("size")).first()["size"] or 0) <= limit


def hot_slices(frame: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Keys with many rows and the number of slices each needs: ``key, slices``.

    At most one row in ``slice_rows`` comes back, however large the input is.
    """
    # Without NULLs, which join nothing, this is the plan the join will ask for
    # as well, so the keys are counted once.
    counts = frame.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > slice_rows).select(
        key, F.ceil(F.col("n") / slice_rows).cast("int").alias("slices")
    )


def sliced_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    slice_rows: int = SLICE_ROWS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on one key whose rows on the left may be very unevenly spread.

    Rows of a hot key are dealt over slices by their place in the input; the
    right side repeats that key's rows once per slice.  Other keys have one
    slice.  The result is that of the plain join.  Spark decides by its size how
    the table of hot keys is joined.

    The place must not change when a lost task runs again.  It is taken from
    the ``POSITION`` columns if ``left`` has them; else ``left`` should be a
    scan or a table, not the result of a shuffle.  ``keys`` are the rows whose
    keys are counted, if there is a cheaper frame than ``left`` that has at
    least the same.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot slice a {how} join")
    counted = left if keys is None else keys
    hot = hot_slices(counted.select(key), key, slice_rows)
    placed = all(name in left.columns for name in POSITION)
    place = F.xxhash64(*POSITION) if placed else F.monotonically_increasing_id()
    slices = F.when(F.col(key).isNull(), _NULL_SLICES).otherwise(F.coalesce("slices", F.lit(1)))
    dealt = (
        left.withColumn("_place", place)
        .join(hot, key, "left")
        .withColumn("_slice", F.pmod("_place", slices).cast("int"))
        .drop("_place", "slices")
    )
    repeated = (
        right.join(hot, key, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
        .drop("slices")
    )
    return dealt.join(repeated, [key, "_slice"], how).drop("_slice")
