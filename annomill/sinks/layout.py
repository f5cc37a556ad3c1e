"""Tables laid out by prompt id, so that what is joined or grouped by id needs no shuffle.

A table is cut into buckets by the hash of ``custom_id``, one file each.  Every later
join with a table of as many buckets, and every grouping by id, reads bucket by bucket
where it lies.

A bucket is one task's work, so the layout is for ids of bounded frequency: prompts, with
one row an id, and annotations, with as many as there are demands and repeats.  An id
beyond ``MOST_ROWS`` is refused; plain frames and ``attach_prompts`` with its slices are
for such tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizes import SLICE_ROWS

MOST_ROWS = SLICE_ROWS


def write_by_id(rows: DataFrame, table: str, path: str, buckets: int, key: str = "custom_id") -> DataFrame:
    """Writes ``rows`` as the table ``table`` at ``path`` and returns it; replaces a table of that name."""
    spark = rows.sparkSession
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max(F.struct("n", key)).alias("most")).first()["most"]
    if most is not None and most["n"] > MOST_ROWS:
        raise ValueError(f"{key} {most[key]} has {most['n']} rows: too many for a table by id")
    (
        rows.repartition(buckets, key).write.mode("overwrite").format("parquet").options(path=path, compression="zstd")
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )
    return spark.table(table)
