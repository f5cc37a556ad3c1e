"""Joins of annotations and jobs with the tables beside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import MODEL_PRICES
from ..functions.paths import shared_keys
from ..functions.pricing import Prices, price_of
from ..sources.prompts import only_prompts, prompt_map
from .sizes import sliced_join


def attach_prompts(
    annotations: DataFrame,
    prompts: DataFrame,
    order_by: Column | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Adds ``prompt`` by ``custom_id``; an unknown id gets ``""``.

    ``order_by`` decides between several prompts of one id (the greatest
    counts); without it an id with several prompts is an error.  A prompt table
    never multiplies annotations.  Adaptive execution splits the partitions of
    ids with very many annotations; where it is off, ``slice_rows`` cuts such
    ids into slices after counting them.
    """
    source = only_prompts(prompts) if order_by is None else prompt_map(prompts, order_by)
    if slice_rows is None:
        joined = annotations.join(source, "custom_id", "left")
    else:
        joined = sliced_join(annotations, source, "custom_id", "left", slice_rows)
    return joined.select(*annotations.columns, F.coalesce("prompt", F.lit("")).alias("prompt"))


def price_lookup(
    rows: DataFrame, model: str = "model", prices: Prices = MODEL_PRICES, match: str = "first"
) -> DataFrame:
    """Adds ``model_key, input, output, found`` for the model's name."""
    priced = rows.withColumn("_price", price_of(F.col(model), prices, match))
    return priced.select(*rows.columns, "_price.*")


def jobs_in_ledger(
    jobs: DataFrame, ledger: DataFrame | None = None, status: str | None = None
) -> DataFrame:
    """Jobs whose batch is in the ledger, with ``demand`` and ``part``.

    Without a ledger, or with an empty one, all jobs.  ``status`` keeps one
    status.  Both tables may be large: no side is forced into memory.
    """
    if status is not None:
        jobs = jobs.filter(F.col("status") == status)
    if ledger is None or ledger.isEmpty():
        return jobs
    places = ledger.groupBy("batch_id").agg(F.min(F.struct("part", "demand")).alias("_place"))
    joined = jobs.join(places, jobs["id"] == places["batch_id"])
    columns = [name for name in jobs.columns if name not in ("demand", "part")]
    return joined.select(*[jobs[name] for name in columns], "_place.demand", "_place.part")


def completed_jobs(ledger: DataFrame, jobs: DataFrame, status: str = "completed") -> DataFrame:
    """Ledger rows whose batch has that status."""
    done = jobs.filter(F.col("status") == status).select(F.col("id").alias("batch_id"))
    return ledger.join(done.distinct(), "batch_id", "left_semi").select(*ledger.columns)


def completed_by_output(ledger: DataFrame, outputs: DataFrame) -> DataFrame:
    """Ledger rows whose part has output."""
    place = shared_keys(ledger.columns, outputs.columns)
    return ledger.join(outputs.select(*place).distinct(), place, "left_semi").select(*ledger.columns)


def missing_parts(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Parts with input but no output: ``demand, part``, and their run if both tables have it."""
    place = shared_keys(inputs.columns, outputs.columns)
    columns = ["demand", *place]
    return inputs.select(*columns).distinct().join(
        outputs.select(*place).distinct(), place, "left_anti"
    ).select(*columns)


def unknown_demands(names: Sequence[str], rubrics: DataFrame) -> DataFrame:
    """Those of ``names`` that are no rubric's acronym."""
    if not names:
        raise ValueError("no names given")
    known = rubrics.agg(F.collect_set(
        F.when(F.col("acronym").isin(list(names)), F.col("acronym"))
    ).alias("known"))
    given = F.array(*[F.lit(name) for name in names])
    return known.select(F.explode(F.array_except(given, "known")).alias("name"))


def missing_annotations(
    prompts: DataFrame, outputs: DataFrame, demands: Sequence[str]
) -> DataFrame:
    """Prompt and demand pairs without an output row: ``custom_id, demand``.

    The outputs shrink to one short list of demands per id before the join and
    only missing pairs are ever written out, never all pairs.
    """
    wanted = F.array(*[F.lit(demand) for demand in demands])
    answered = (
        outputs.filter(F.col("demand").isin(list(demands)))
        .groupBy("custom_id").agg(F.collect_set("demand").alias("_have"))
    )
    ids = prompts.select("custom_id").distinct()
    have = F.coalesce("_have", F.array().cast("array<string>"))
    return (
        ids.join(answered, "custom_id", "left")
        .select("custom_id", F.explode(F.array_except(wanted, have)).alias("demand"))
    )
