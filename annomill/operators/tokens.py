"""Token totals and cost before anything is sent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    EMPTY_INSTRUCTION, INSTRUCTION_TEMPLATE, MODEL_PRICES, REQUEST_MAX_TOKENS,
)
from ..functions.instructions import render_instruction
from ..functions.pricing import Prices, knows_model, price_of
from ..functions.tokens import DEFAULT_COUNTER, TokenCounter
from .requests import pair_with, request_halves

_NAME_MENTIONS = INSTRUCTION_TEMPLATE.count("{name}")
_BEFORE, _AFTER = INSTRUCTION_TEMPLATE.split("{prompt}")
_PROMPT_BETWEEN_SPACES = _BEFORE[-1:].isspace() and _AFTER[:1].isspace()


def token_count(
    texts: DataFrame, text: str = "prompt", counter: TokenCounter = DEFAULT_COUNTER
) -> DataFrame:
    """Adds ``tokens``."""
    return texts.withColumn("tokens", counter.count(F.col(text)))


def token_total(
    texts: DataFrame, text: str = "prompt", counter: TokenCounter = DEFAULT_COUNTER
) -> DataFrame:
    """One row: ``n`` texts and their ``tokens``."""
    return texts.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(counter.count(F.col(text))), F.lit(0)).alias("tokens"),
    )


def _from_totals(rubrics: DataFrame, prompts: DataFrame, counter: TokenCounter, per_prompt):
    """Tokens of all prompts once, plus a constant per rubric and prompt."""
    totals = token_total(prompts, "prompt", counter).select(F.struct("n", "tokens"))
    return rubrics.withColumn("_t", totals.scalar()).select(
        "demand", F.col("_t.n").alias("n_prompts"),
        (F.col("_t.tokens") + F.col("_t.n") * per_prompt).cast("bigint").alias("input_tokens"),
    )


def rubric_tokens(rubrics: DataFrame, counter: TokenCounter = DEFAULT_COUNTER) -> DataFrame:
    """``demand, name_tokens, rubric_tokens``."""
    return rubrics.select(
        F.col("acronym").alias("demand"),
        counter.count(F.col("full_name")).alias("name_tokens"),
        counter.count(F.col("content")).alias("rubric_tokens"),
    )


def input_tokens_exact(
    prompts: DataFrame, rubrics: DataFrame, counter: TokenCounter = DEFAULT_COUNTER
) -> DataFrame:
    """Tokens of the rendered texts: ``demand, n_prompts, input_tokens``.

    In the rendered text the prompt stands between white space.  For a counter
    that splits there, the total is that of the prompts plus a constant per
    rubric and prompt; nothing is rendered.  For any other counter every pair
    is rendered and counted.
    """
    if counter.splits_at_space and _PROMPT_BETWEEN_SPACES:
        around = counter.count(F.col("prefix")) + counter.count(F.col("suffix"))
        return _from_totals(request_halves(rubrics), prompts, counter, around)
    pairs = pair_with(prompts.select("prompt"), request_halves(rubrics))
    return pairs.groupBy("demand").agg(
        F.count("*").alias("n_prompts"),
        F.sum(counter.count(F.concat("prefix", "prompt", "suffix"))).alias("input_tokens"),
    )


def input_tokens_approx(
    prompts: DataFrame, rubrics: DataFrame, counter: TokenCounter = DEFAULT_COUNTER
) -> DataFrame:
    """Tokens from the pieces alone: ``demand, n_prompts, input_tokens``.

    Prompt tokens, and for each prompt the rubric, its name as often as the
    text mentions it, and the text around an empty rubric.
    """
    name, rubric, prompt = (F.lit(piece) for piece in EMPTY_INSTRUCTION)
    empty = counter.count(render_instruction(name, rubric, prompt))
    per_prompt = F.col("name_tokens") * _NAME_MENTIONS + F.col("rubric_tokens") + empty
    return _from_totals(rubric_tokens(rubrics, counter), prompts, counter, per_prompt)


def estimate_cost(
    prompts: DataFrame,
    rubrics: DataFrame,
    models: str | Sequence[str],
    max_completion_tokens: int = REQUEST_MAX_TOKENS,
    estimation: str = "aprox",
    counters: TokenCounter | Mapping[str, TokenCounter] = DEFAULT_COUNTER,
    prices: Prices = MODEL_PRICES,
    match: str = "first",
) -> DataFrame:
    """Upper bound of the cost, one row per model.

    ``model, input_tokens, output_tokens, input_cost, output_cost, cost``.
    ``counters`` is one counter or one per model; models that share a counter
    share its pass over the prompts.
    """
    models = [models] if isinstance(models, str) else list(models)
    unknown = [model for model in models if not knows_model(model, prices)]
    if unknown:
        raise ValueError(f"no price for {', '.join(unknown)}; "
                         f"known are {', '.join(key for key, _, _ in prices)}")
    if estimation not in ("aprox", "exact"):
        raise ValueError("estimation must be 'aprox' or 'exact'")
    count_input = input_tokens_approx if estimation == "aprox" else input_tokens_exact

    by_counter: dict[TokenCounter, list[str]] = {}
    for model in models:
        counter = counters if isinstance(counters, TokenCounter) else counters[model]
        by_counter.setdefault(counter, []).append(model)

    frames = []
    for counter, group in by_counter.items():
        total = count_input(prompts, rubrics, counter).agg(
            F.coalesce(F.sum("n_prompts"), F.lit(0)).alias("pairs"),
            F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        )
        names = F.explode(F.array(*[F.lit(model) for model in group]))
        frames.append(total.select(names.alias("model"), "pairs", "input_tokens"))
    tokens = frames[0]
    for frame in frames[1:]:
        tokens = tokens.unionByName(frame)
    price = price_of(F.col("model"), prices, match)
    return (
        tokens.withColumn("output_tokens", F.col("pairs") * max_completion_tokens)
        .withColumn("_price", price)
        .select(
            "model", "input_tokens", "output_tokens",
            (F.col("input_tokens") / 1e6 * F.col("_price.input")).alias("input_cost"),
            (F.col("output_tokens") / 1e6 * F.col("_price.output")).alias("output_cost"),
        )
        .withColumn("cost", F.col("input_cost") + F.col("output_cost"))
    )
