"""Prompt tables from JSON lines, CSV or Parquet: ``custom_id``, ``prompt``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.positions import POSITION, position_columns
from .csv_records import read_csv_records

_CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"'}


def _require(frame: DataFrame, columns: list[str], place: str) -> None:
    missing = [name for name in columns if name not in frame.columns]
    if missing:
        raise KeyError(f"no column {', '.join(missing)} in {place}")


def _apply_mode(
    frame: DataFrame, columns: list[str], mode: str, position: bool, broken=None, placed: bool = False
) -> DataFrame:
    """``strict`` fails the job on the first bad row, ``quarantine`` drops bad
    rows (``validate_prompts`` lists them).  ``placed`` rows have their position already."""
    if mode not in ("strict", "quarantine"):
        raise ValueError("mode must be 'strict' or 'quarantine'")
    if position and mode != "strict":
        raise ValueError("positions are those of complete files: use mode 'strict'")
    bad = F.lit(False) if broken is None else broken
    for name in columns:
        bad = bad | F.col(name).isNull()
    if mode == "quarantine":
        return frame.filter(~bad).select(*columns)
    complaint = F.raise_error(F.concat(
        F.lit(f"a row lacks {' or '.join(columns)} in "), F.col("file_path" if placed else "_metadata.file_path"),
        F.lit(", custom_id "), F.coalesce(F.col("custom_id"), F.lit("(none)"))
        if "custom_id" in columns else F.lit("(not read)"),
    ))
    checked = [F.when(bad, complaint).otherwise(F.col(name)).alias(name) for name in columns]
    places = POSITION if placed else position_columns()
    return frame.select(*checked, *(places if position else []))


def _read_jsonl(spark, path, columns, mode, position):
    schema = T.StructType([f for f in schemas.PROMPT if f.name in columns]
                          + [T.StructField("_corrupt_record", T.StringType())])
    raw = spark.read.schema(schema).json(path)
    return _apply_mode(raw, columns, mode, position, F.col("_corrupt_record").isNotNull())


def _read_csv(spark, path, columns, mode, position, multiline):
    # Without inference every CSV column is a string.  The first file's header names
    # the columns; a file whose header differs fails the job instead of being misread.
    options = {**_CSV_OPTIONS, "multiLine": bool(multiline), "enforceSchema": False}
    raw = spark.read.options(**options).csv(path)
    _require(raw, columns, path if isinstance(path, str) else ", ".join(path))
    if multiline == "parallel":
        return _apply_mode(read_csv_records(spark, path, raw.columns), columns, mode, position, placed=True)
    return _apply_mode(raw, columns, mode, position)


def _read_parquet(spark, path, columns, mode, position):
    paths = [path] if isinstance(path, str) else path
    raw = spark.read.parquet(*paths)
    _require(raw, columns, ", ".join(paths))
    for name in columns:
        raw = raw.withColumn(name, F.col(name).cast("string"))
    return _apply_mode(raw, columns, mode, position)


def _read(spark, path, columns, format, mode, multiline, position=False):
    if format == "jsonl":
        return _read_jsonl(spark, path, columns, mode, position)
    if format == "csv":
        return _read_csv(spark, path, columns, mode, position, multiline)
    if format == "parquet":
        return _read_parquet(spark, path, columns, mode, position)
    raise ValueError("format must be 'jsonl', 'csv' or 'parquet'")


def read_prompts(
    spark: SparkSession,
    path: str | list[str],
    format: str = "jsonl",
    mode: str = "strict",
    multiline: bool | str = True,
    position: bool = False,
) -> DataFrame:
    """The two prompt columns; any others are never read.

    ``position`` adds the columns that say where in the files a row is.

    CSV prompts may hold line breaks, which keeps Spark from splitting a CSV
    file.  For huge CSV files pass ``multiline="parallel"``: see ``csv_records``, whose
    rules for quotes are stricter.  Without any line breaks in quotes ``multiline=False`` will do.
    """
    return _read(spark, path, ["custom_id", "prompt"], format, mode, multiline, position)


def prompts_only(
    spark: SparkSession,
    path: str | list[str],
    format: str = "jsonl",
    mode: str = "strict",
    multiline: bool | str = True,
) -> DataFrame:
    """The prompt column alone; ``custom_id`` need not exist."""
    return _read(spark, path, ["prompt"], format, mode, multiline)


def only_prompts(prompts: DataFrame) -> DataFrame:
    """The prompt of every ``custom_id``; an id with several rows is an error."""
    several = F.raise_error(F.concat(F.lit("several prompts for "), F.col("custom_id")))
    counted = prompts.groupBy("custom_id").agg(F.min("prompt").alias("prompt"), F.count("*").alias("n"))
    return counted.select("custom_id", F.when(F.col("n") > 1, several).otherwise(F.col("prompt")).alias("prompt"))


def prompt_map(prompts: DataFrame, order_by) -> DataFrame:
    """One prompt per ``custom_id``: the one with the greatest ``order_by``.

    The aggregate combines map-side, so a ``custom_id`` that fills a large
    share of the table shrinks to one row per task before the shuffle.
    """
    return prompts.groupBy("custom_id").agg(F.max_by("prompt", order_by).alias("prompt"))
