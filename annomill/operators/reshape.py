"""Long annotations to one row per prompt.

Both forms use one conditional aggregate per demand in a single pass grouped
by ``custom_id``: one shuffle, combined map-side, and a state that is bounded
by the number of demands however often an id occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def demands_in(annotations: DataFrame) -> list[str]:
    """The demands that occur, sorted.  Runs a job; pass the list where known."""
    rows = annotations.select("demand").distinct().sort("demand").collect()
    return [row["demand"] for row in rows]


def _last_of(demand: str, value: Column, order: Column) -> Column:
    here = F.col("demand") == demand
    return F.max_by(F.when(here, value), F.when(here, order))


def _alike(name: str | None) -> list[Column]:
    return [] if name is None else [F.xxhash64(F.col(name)).alias("_alike")]


def _alike_bounds(name: str | None) -> list[Column]:
    # Numbers, so that the aggregate stays in hash form.
    return [] if name is None else [F.min("_alike").alias("_least"), F.max("_alike").alias("_most")]


def _one_value(grouped: DataFrame, by: Sequence[str], alike: str | None) -> DataFrame:
    """Fails on a row whose ``alike`` had several values; the keys stay as they are, and with them the partitioning."""
    if alike is None:
        return grouped
    several = F.raise_error(F.concat(F.lit(f"several values of {alike} for "), F.coalesce(by[-1], F.lit("(none)"))))
    return grouped.where(F.when(F.col("_least") == F.col("_most"), F.lit(True)).otherwise(several))


def pivot_wide(
    annotations: DataFrame,
    order_by: Column,
    demands: Sequence[str] | None = None,
    on_duplicate: str = "last",
    failures_as: str = "nan",
    by: Sequence[str] = ("custom_id",),
    alike: str | None = None,
) -> DataFrame:
    """One level column per demand, one row for each ``by``.

    ``order_by`` decides which of several annotations of a prompt and demand
    counts (``last``); with ``on_duplicate="error"`` there may be only one.
    A numeric order keeps the aggregate in hash form.  ``alike`` names a column that
    must be the same within a row, such as the run.
    """
    if on_duplicate not in ("last", "error"):
        raise ValueError("on_duplicate must be 'last' or 'error'")
    if failures_as not in ("nan", "null"):
        raise ValueError("failures_as must be 'nan' or 'null'")
    demands = list(demands) if demands is not None else demands_in(annotations)
    order = F.col("_order")
    cells = [_last_of(demand, F.col("level"), order).alias(demand) for demand in demands]
    if on_duplicate == "error":
        cells += [F.count_if(F.col("demand") == demand).alias(f"_n_{demand}") for demand in demands]
    wide = (
        annotations.select(*by, "demand", "level", order_by.alias("_order"), *_alike(alike))
        .groupBy(*by).agg(*cells, *_alike_bounds(alike))
    )
    wide = _one_value(wide, by, alike)
    columns = []
    for demand in demands:
        cell = F.col(f"`{demand}`")
        if on_duplicate == "error":
            twice = F.concat(F.lit(f"several annotations for {demand} of "), F.col("custom_id"))
            cell = F.when(F.col(f"`_n_{demand}`") > 1, F.raise_error(twice)).otherwise(cell)
        if failures_as == "nan":
            cell = F.coalesce(cell, F.lit(float("nan")))
        columns.append(cell.alias(demand))
    return wide.select(*by, *columns)


def nest_wide(
    annotations: DataFrame,
    order_by: Column,
    demands: Sequence[str] | None = None,
    failures_as: str = "nan",
    by: Sequence[str] = ("custom_id",),
    alike: str | None = None,
) -> DataFrame:
    """``custom_id, demand MAP<demand, STRUCT<level, ...>>[, prompt]``.

    The structs hold whichever of ``level, finish_reason, model_response`` the
    input has.  Later annotations replace earlier ones.  ``by`` and ``alike`` are those
    of ``pivot_wide``.
    """
    if failures_as not in ("nan", "null"):
        raise ValueError("failures_as must be 'nan' or 'null'")
    demands = list(demands) if demands is not None else demands_in(annotations)
    level = F.col("level")
    if failures_as == "nan":
        level = F.coalesce(level, F.lit(float("nan")))
    extras = [name for name in ("finish_reason", "model_response") if name in annotations.columns]
    value = F.struct(level.alias("level"), *extras)
    with_prompt = "prompt" in annotations.columns

    order = F.col("_order")
    cells = [_last_of(demand, F.col("_value"), order).alias(f"_{i}")
             for i, demand in enumerate(demands)]
    if with_prompt:
        cells.append(F.max_by("prompt", order).alias("prompt"))
    grouped = (
        annotations.select(*by, "demand", value.alias("_value"), order_by.alias("_order"), *_alike(alike),
                           *(["prompt"] if with_prompt else []))
        .groupBy(*by).agg(*cells, *_alike_bounds(alike))
    )
    grouped = _one_value(grouped, by, alike)
    entries = F.array(*[
        F.when(F.col(f"_{i}").isNotNull(), F.struct(F.lit(demand).alias("key"),
                                                   F.col(f"_{i}").alias("value")))
        for i, demand in enumerate(demands)
    ])
    nested = F.map_from_entries(F.array_compact(entries)).alias("demand")
    return grouped.select(*by, nested, *(["prompt"] if with_prompt else []))


def unnest_wide(nested: DataFrame) -> DataFrame:
    """Back to one row per prompt and demand."""
    columns = [name for name in nested.columns if name != "demand"]
    return nested.select(*columns, F.explode("demand").alias("demand", "_value")).select(
        *columns, "demand", "_value.*"
    )
