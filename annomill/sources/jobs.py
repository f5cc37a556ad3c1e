"""Tables that sit beside the outputs: errors, batch metadata, job ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.paths import demand_of_part, demand_of_path, part_of_path, run_of_path
from ..sinks.staged import staged


def read_errors(
    spark: SparkSession, base: str | list[str], file_glob: str = "errors.jsonl"
) -> DataFrame:
    """Failed requests: ``run, demand, part, custom_id, error, response, corrupt_record``.

    ``error`` and ``response`` are JSON text; a line that is no JSON is kept as it is.
    """
    path = F.col("_metadata.file_path")
    return (
        spark.read.schema(schemas.ERROR)
        .option("recursiveFileLookup", True).option("pathGlobFilter", file_glob)
        .json(base)
        .select(run_of_path(path).alias("run"), demand_of_path(path).alias("demand"), part_of_path(path).alias("part"),
                "custom_id", "error", "response", F.col("_corrupt_record").alias("corrupt_record"))
    )


def read_error_details(
    spark: SparkSession, base: str | list[str], file_glob: str = "errors.jsonl"
) -> DataFrame:
    """What failed requests say, whatever their shape: ``run, demand, part, custom_id, status_code, code, message,
    details, corrupt_record``.

    A line is parsed once, to a VARIANT, which stays as ``details``; the columns are looked
    up in it.  The error may be an object or a text, at the top or in the response's
    body; a code may be a number, and where there is none the type counts.  What is not there, or
    has another type, is NULL.  A line that is no JSON object is kept as ``corrupt_record``.
    """
    path = F.col("_metadata.file_path")
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", file_glob).text(base)
        .select(run_of_path(path).alias("run"), demand_of_path(path).alias("demand"), part_of_path(path).alias("part"),
                "value", F.try_parse_json("value").alias("details"))
        .where(F.trim("value") != "")
    )
    details = F.col("details")
    is_object = F.coalesce(F.schema_of_variant(details).startswith("OBJECT<"), F.lit(False))

    def found(kind: str, *paths: str):
        return F.coalesce(*[F.try_variant_get(details, place, kind) for place in paths])

    def as_text(place: str):
        # An object is no text, though it can be shown as one.
        kind = F.schema_of_variant(F.try_variant_get(details, place, "variant"))
        return F.when(kind == "STRING", F.try_variant_get(details, place, "string"))

    errors = ("$.error", "$.response.body.error", "$.response.error")
    return lines.select(
        "run", "demand", "part",
        F.when(is_object, found("string", "$.custom_id")).alias("custom_id"),
        F.when(is_object, found("int", "$.response.status_code", "$.status_code", "$.error.status_code")).alias("status_code"),
        F.when(is_object, found("string", *[f"{e}.code" for e in errors], *[f"{e}.type" for e in errors])).alias("code"),
        F.when(is_object, F.coalesce(found("string", *[f"{e}.message" for e in errors]), *[as_text(e) for e in errors]))
        .alias("message"),
        F.when(is_object, details).alias("details"),
        F.when(~is_object, F.col("value")).alias("corrupt_record"),
    )


def shape_of_errors(details: DataFrame, *by: str) -> DataFrame:
    """One schema that all ``details`` fit, ``shape``, per group of ``by``; merged map-side."""
    return details.groupBy(*by).agg(F.schema_of_variant_agg("details").alias("shape"))


def read_batch_metadata(
    spark: SparkSession, base: str | list[str], file_glob: str = "batch_metadata.json",
    multiline: bool = True,
) -> DataFrame:
    """One row per batch metadata document, with its ``run``, ``demand`` and ``part``.

    ``multiline=False`` reads files of one document per line, which split.
    """
    path = F.col("_metadata.file_path")
    return (
        spark.read.schema(schemas.BATCH_METADATA)
        .option("recursiveFileLookup", True).option("pathGlobFilter", file_glob)
        .option("multiLine", multiline)
        .json(base)
        .select(run_of_path(path).alias("run"), demand_of_path(path).alias("demand"),
                part_of_path(path).alias("part"), "*")
    )


def read_job_ledger(spark: SparkSession, path: str | list[str], format: str = "table") -> DataFrame:
    """``demand, part, batch_id``.

    ``table`` reads JSON lines of those columns; ``map`` reads a JSON object
    ``{"<folder>": "<batch id>"}``.
    """
    if format == "table":
        return spark.read.schema(schemas.LEDGER).json(path)
    if format != "map":
        raise ValueError("format must be 'table' or 'map'")
    entries = F.from_json("value", "map<string,string>")
    part = F.substring_index(F.col("folder"), "/", -1)
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(entries).alias("folder", "batch_id"))
        .select(demand_of_part(part).alias("demand"), part.alias("part"), "batch_id")
    )


def launched_demands(ledger: DataFrame) -> DataFrame:
    """Parts that have a batch."""
    return ledger.select("demand", "part").distinct()


def write_job_ledger(ledger: DataFrame, path: str) -> None:
    """Replaces the ledger at ``path``, which may be what ``ledger`` was read from."""
    with staged(ledger.sparkSession, path) as place:
        ledger.select("demand", "part", "batch_id").write.json(place)
