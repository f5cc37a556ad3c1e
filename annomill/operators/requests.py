"""Scoring requests: every prompt with every rubric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    REQUEST_MAX_TOKENS, REQUEST_METHOD, REQUEST_MODEL, REQUEST_TEMPERATURE, REQUEST_URL,
    SYSTEM_CONTENT,
)
from ..functions.instructions import instruction_prefix, instruction_suffix
from .sizes import IN_MEMORY_BYTES, fits_in_memory


def filter_demands(rubrics: DataFrame, acronyms: str | Sequence[str]) -> DataFrame:
    """Rubrics with exactly these acronyms; none found is an error."""
    wanted = [acronyms] if isinstance(acronyms, str) else list(acronyms)
    found = rubrics.filter(F.col("acronym").isin(wanted))
    if found.isEmpty():
        raise ValueError(f"no rubrics for {', '.join(wanted)}")
    return found


def checked_acronyms(rubrics: DataFrame) -> DataFrame:
    """The rubrics; an acronym that stands twice is an error."""
    twice = rubrics.groupBy("acronym").count().where("count > 1").orderBy("acronym").limit(5).collect()
    if twice:
        raise ValueError("several rubrics are called " + ", ".join(row["acronym"] for row in twice))
    return rubrics


def _named(part: str, name: str, anywhere: bool) -> Column:
    return F.col(part).contains(name) if anywhere else F.col(part).startswith(name)


def filter_demands_prefix(
    rows: DataFrame, names: Sequence[str], part: str = "part", anywhere: bool = False
) -> DataFrame:
    """Rows of the parts whose name starts with (or contains) one of ``names``.

    Plain string predicates, so on partitioned tables only matching folders
    are listed and read.
    """
    matched = F.lit(False)
    for name in names:
        matched = matched | _named(part, name, anywhere)
    return rows.filter(matched)


def unmatched_prefixes(
    rows: DataFrame, names: Sequence[str], part: str = "part", anywhere: bool = False
) -> DataFrame:
    """Those of ``names`` that match no part: one row per name."""
    if not names:
        raise ValueError("no names given")
    hits = rows.agg(*[
        F.coalesce(F.bool_or(_named(part, name, anywhere)), F.lit(False)).alias(f"_{i}")
        for i, name in enumerate(names)
    ])
    pairs = F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(f"_{i}").alias("hit"))
        for i, name in enumerate(names)
    ])
    return hits.select(F.inline(pairs)).filter(~F.col("hit")).select("name")


def pair_with(rows: DataFrame, dimension: DataFrame, limit: int = IN_MEMORY_BYTES) -> DataFrame:
    """Every row with every row of a dimension table.

    A dimension that measures at most ``limit`` bytes becomes one array that
    each task explodes in place: nothing is joined or shuffled.  A larger one
    is cut into chunks and the rows into even blocks; each block meets each
    chunk through an equi-join, so no task sees more than a block and a chunk.
    """
    names = dimension.columns
    if fits_in_memory(dimension, limit):
        held = dimension.agg(F.collect_list(F.struct(*names)).alias("held")).scalar()
        return rows.select("*", F.explode(held).alias("_held")).select(*rows.columns, "_held.*")
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    total = dimension.agg(size.alias("size")).first()["size"]
    chunks = -(-total // limit)
    blocks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = rows.withColumn(
        "_block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")
    ).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = dimension.withColumn(
        "_chunk", F.pmod(F.xxhash64(*names), F.lit(chunks)).cast("int")
    ).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    paired = left.join(right.hint("shuffle_hash"), ["_block", "_chunk"])
    return paired.select(*rows.columns, *names)


def expand_requests(prompts: DataFrame, rubrics: DataFrame) -> DataFrame:
    """Prompts by rubrics: the prompt columns, ``demand``, ``full_name`` and ``content``."""
    dimension = checked_acronyms(rubrics).select(F.col("acronym").alias("demand"), "full_name", "content")
    return pair_with(prompts, dimension)


def request_halves(rubrics: DataFrame) -> DataFrame:
    """Per rubric the scoring text before and after the prompt:
    ``demand, prefix, suffix``."""
    return checked_acronyms(rubrics).select(
        F.col("acronym").alias("demand"),
        instruction_prefix(F.col("full_name"), F.col("content")).alias("prefix"),
        instruction_suffix(F.col("full_name")).alias("suffix"),
    )


def render_requests(prompts: DataFrame, rubrics: DataFrame) -> DataFrame:
    """The scoring text of every pair: ``custom_id, demand, instruction``."""
    pairs = pair_with(prompts.select("custom_id", "prompt"), request_halves(rubrics))
    return pairs.select("custom_id", "demand", F.concat("prefix", "prompt", "suffix").alias("instruction"))


def request_body(
    instruction: Column,
    model: str = REQUEST_MODEL,
    max_tokens: int = REQUEST_MAX_TOKENS,
) -> Column:
    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", F.lit(SYSTEM_CONTENT)), message("user", instruction))
        .alias("messages"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(REQUEST_TEMPERATURE).alias("temperature"),
    )


def request_columns(
    custom_id: Column,
    instruction: Column,
    model: str = REQUEST_MODEL,
    max_tokens: int = REQUEST_MAX_TOKENS,
    url: str = REQUEST_URL,
) -> list[Column]:
    """The fields of one request line, in their order."""
    return [
        custom_id.alias("custom_id"),
        F.lit(REQUEST_METHOD).alias("method"),
        F.lit(url).alias("url"),
        request_body(instruction, model, max_tokens).alias("body"),
    ]


def build_requests(
    prompts: DataFrame,
    rubrics: DataFrame,
    model: str = REQUEST_MODEL,
    max_tokens: int = REQUEST_MAX_TOKENS,
    url: str = REQUEST_URL,
) -> DataFrame:
    """``demand`` and the request fields for every pair."""
    rendered = render_requests(prompts, rubrics)
    fields = request_columns(F.col("custom_id"), F.col("instruction"), model, max_tokens, url)
    return rendered.select("demand", *fields)
