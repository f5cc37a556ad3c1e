"""Model answers (``output.jsonl``) as flat rows, and the files they are in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.paths import demand_of_path, part_of_path, run_of_path
from ..operators.positions import POSITION, position_columns


def flatten_outputs(raw: DataFrame, position: bool = True, content: bool = True) -> DataFrame:
    """One flat row per output line.

    ``file_path, file_block, file_pos`` order the lines of all files as a
    reader going through the files by name would meet them: a split's rows are
    numbered in order, and splits of a file are ordered by where they start.
    Streams cannot number rows, so there ``file_pos`` is left out.
    """
    choice = F.try_element_at(F.col("response.body.choices"), F.lit(1))
    path = F.col("_metadata.file_path")
    return raw.select(
        "custom_id",
        demand_of_path(path).alias("demand"),
        part_of_path(path).alias("part"),
        run_of_path(path).alias("run"),
        F.col("response.body.model").alias("model"),
        choice.isNotNull().alias("has_choice"),
        choice["finish_reason"].alias("finish_reason"),
        *([choice["message"]["content"].alias("content")] if content else []),
        F.col("response.body.usage.prompt_tokens").alias("prompt_tokens"),
        F.col("response.body.usage.completion_tokens").alias("completion_tokens"),
        F.col("_corrupt_record").alias("corrupt_record"),
        *(position_columns() if position else position_columns()[:2]),
    )


def line_order():
    """Orders output rows as their files are read; later lines are greater."""
    return F.struct(*POSITION)


def read_outputs(
    spark: SparkSession, base: str | list[str], file_glob: str = "output.jsonl", content: bool = True
) -> DataFrame:
    """Every output line below ``base``, at any depth, in one scan.

    ``content=False`` leaves the answers' texts out, which is all that token,
    cost and finish reason summaries need and about twice as fast.
    """
    raw = (
        spark.read.schema(schemas.output(content))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_glob)
        .json(base)
    )
    return flatten_outputs(raw, content=content)


def union_outputs(*frames: DataFrame) -> DataFrame:
    """Rows of several output frames together; columns are matched by name."""
    if not frames:
        raise ValueError("nothing to unite")
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame)
    return united


def part_inventory(
    spark: SparkSession, base: str | list[str], file_glob: str = "{input,output}.jsonl"
) -> DataFrame:
    """Lines and bytes of every part: ``run, demand, part, kind, rows, bytes``.

    ``kind`` is the file's stem, or ``inputs``/``outputs`` when the files lie
    below a folder of that name.  Parts whose files are empty do not appear.
    """
    path = F.col("file_path")
    below = F.regexp_extract(path, "/(inputs|outputs)/", 1)
    stem = F.regexp_extract(path, r"([^/.]+)[^/]*$", 1)
    per_file = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", file_glob)
        .text(base)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count("*").alias("rows"), F.sum(F.octet_length("value") + 1).alias("bytes"))
    )
    return (
        per_file.groupBy(
            run_of_path(path).alias("run"),
            demand_of_path(path).alias("demand"),
            part_of_path(path).alias("part"),
            F.when(below != "", below).otherwise(stem).alias("kind"),
        )
        .agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    )
