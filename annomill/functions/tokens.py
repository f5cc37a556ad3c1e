"""Pluggable token counting."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import TOKEN_PATTERN


@dataclass(frozen=True)
class TokenCounter:
    """Tokens of a text column.

    ``splits_at_space`` says that no token spans or depends on white space.
    Such a counter can be summed over pieces cut at white space, which lets
    totals over all pairs be computed without rendering any pair.
    """

    count: Callable[[Column], Column]
    splits_at_space: bool = False


DEFAULT_COUNTER = TokenCounter(
    lambda text: F.regexp_count(text, F.lit(TOKEN_PATTERN)).cast("bigint"),
    splits_at_space=True,
)


def encoder_counter(load_encoder: Callable[[], object]) -> TokenCounter:
    """A counter around an encoder with an ``encode_ordinary(text)`` method.

    ``load_encoder`` runs once per Python worker; texts arrive in Arrow
    batches.
    """
    loaded = []

    @F.pandas_udf("bigint")
    def count(texts):
        if not loaded:
            loaded.append(load_encoder())
        return texts.map(lambda text: len(loaded[0].encode_ordinary(text)), na_action="ignore")

    return TokenCounter(lambda text: count(text))
