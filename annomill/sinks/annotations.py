"""Annotations to JSON lines, CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staged import staged

FORMATS = ("jsonl", "csv", "parquet")

#: Answers may hold line breaks, so a reader takes a CSV file in one task: a file has at most so many rows.
CSV_FILE_ROWS = 50_000


def write_annotations(
    annotations: DataFrame, path: str, format: str = "jsonl", split_by_demand: bool = False
) -> None:
    """Writes long or wide annotations as they are, in place of what ``path`` held before.

    ``split_by_demand`` gives one folder ``demand=<demand>`` per demand; it
    needs the long form.  Each task writes its own rows, so nothing is
    shuffled and a large demand is written by many tasks.  The annotations are
    computed once; that there are none shows only then, and is an error.  After any
    error ``path`` holds what it held before: see ``staged``.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}")
    fields = {field.name: field.dataType for field in annotations.schema.fields}
    if split_by_demand and not ("level" in fields and isinstance(fields.get("demand"), T.StringType)):
        raise ValueError("only the long form can be split by demand")
    nested = any(isinstance(kind, (T.MapType, T.StructType, T.ArrayType)) for kind in fields.values())
    if format == "csv" and nested:
        raise ValueError("nested annotations cannot be written as CSV")

    with staged(annotations.sparkSession, path) as place:
        written = Observation()
        observed = annotations.observe(written, F.count(F.lit(1)).alias("rows"))
        writer = observed.write.mode("overwrite")
        if split_by_demand:
            writer = writer.partitionBy("demand")
        if format == "jsonl":
            writer.json(place)
        elif format == "parquet":
            writer.parquet(place)
        else:
            # Answers may hold line breaks, quotes and leading blanks.
            writer.options(
                header=True, escape='"', quoteAll=False, maxRecordsPerFile=CSV_FILE_ROWS,
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            ).csv(place)
        if not written.get.get("rows"):
            raise ValueError("no annotations to write")
