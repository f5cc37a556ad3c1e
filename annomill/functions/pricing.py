"""Model prices.  The price table is configuration, so it becomes one CASE
expression: no join, and it stays inside generated code."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import MODEL_PRICES

Prices = Sequence[tuple[str, float, float]]


def _in_match_order(prices: Prices, match: str) -> list[tuple[str, float, float]]:
    if match == "first":
        return list(prices)
    if match == "longest":
        return sorted(prices, key=lambda price: -len(price[0]))
    raise ValueError("match must be 'first' or 'longest'")


def price_of(model: Column, prices: Prices = MODEL_PRICES, match: str = "first") -> Column:
    """Struct ``(model_key, input, output, found)`` for a model's name.

    ``first`` takes the first key contained in the name; ``longest`` the
    longest one.  An unknown or NULL model costs 0 and is not ``found``.
    """
    def priced(key, input_rate, output_rate, found):
        return F.struct(
            F.lit(key).cast("string").alias("model_key"),
            F.lit(float(input_rate)).alias("input"),
            F.lit(float(output_rate)).alias("output"),
            F.lit(found).alias("found"),
        )

    chain = F
    for key, input_rate, output_rate in _in_match_order(prices, match):
        chain = chain.when(model.contains(key), priced(key, input_rate, output_rate, True))
    return chain.otherwise(priced(None, 0.0, 0.0, False))


def knows_model(model: str, prices: Prices = MODEL_PRICES) -> bool:
    return any(key in model for key, _, _ in prices)
