import pytest
from pyspark.sql import functions as F

from annomill.fixed_values import INSTRUCTION_TEMPLATE
from annomill.functions.tokens import DEFAULT_COUNTER, TokenCounter, encoder_counter
from annomill.operators.tokens import (
    estimate_cost, input_tokens_approx, input_tokens_exact, token_count, token_total,
)
from annomill.plans.derived import rubric_text

PROMPTS = ["a", "two words", "12345 is 5 digits", "é∑, 中文!", ""]


@pytest.fixture(scope="module")
def prompts(spark):
    return spark.createDataFrame([(p,) for p in PROMPTS], "prompt string")


@pytest.fixture(scope="module")
def rubrics(spark):
    return spark.createDataFrame([(a, n, rubric_text(n)) for a, n in (("A", "Alpha One"), ("B", "Beta"))],
                                 "acronym string, full_name string, content string")


def test_default_counts(prompts):
    counts = [row["tokens"] for row in token_count(prompts).collect()]
    assert counts == [1, 2, 5, 4, 0]
    assert tuple(token_total(prompts).first()) == (5, 12)


def test_exact_total_is_that_of_the_rendered_texts(prompts, rubrics, as_rows):
    rendering = TokenCounter(DEFAULT_COUNTER.count, splits_at_space=False)
    assert as_rows(input_tokens_exact(prompts, rubrics)) == as_rows(input_tokens_exact(prompts, rubrics, rendering))


def test_approximation(prompts, rubrics):
    found = {row["demand"]: row["input_tokens"] for row in input_tokens_approx(prompts, rubrics).collect()}

    def tokens(text):
        return prompts.sparkSession.createDataFrame([(text,)], "prompt string").transform(token_count).first()["tokens"]

    empty = tokens(INSTRUCTION_TEMPLATE.format(name="", rubric=" ", prompt=""))
    for demand, name in (("A", "Alpha One"), ("B", "Beta")):
        assert found[demand] == 12 + 5 * (4 * tokens(name) + tokens(rubric_text(name)) + empty)


def test_encoder(spark, prompts, rubrics):
    def load_bytes_encoder():
        import tiktoken

        ranks = {bytes([i]): i for i in range(256)}
        return tiktoken.Encoding("bytes", pat_str=r"\s?\S+|\s+", mergeable_ranks=ranks, special_tokens={})

    counter = encoder_counter(load_bytes_encoder)
    assert [row["tokens"] for row in token_count(prompts, "prompt", counter).collect()] == [
        len(p.encode()) for p in PROMPTS]
    exact = {row["demand"]: row["input_tokens"] for row in input_tokens_exact(prompts, rubrics, counter).collect()}
    for demand, name in (("A", "Alpha One"), ("B", "Beta")):
        texts = [INSTRUCTION_TEMPLATE.format(name=name, rubric=rubric_text(name), prompt=p) for p in PROMPTS]
        assert exact[demand] == sum(len(text.encode()) for text in texts)


def test_cost(prompts, rubrics):
    rows = {r["model"]: r for r in estimate_cost(prompts, rubrics, ["gpt-4o", "o4-mini"], 100).collect()}
    total = input_tokens_approx(prompts, rubrics).agg(F.sum("input_tokens")).first()[0]
    assert rows["gpt-4o"]["input_tokens"] == total and rows["gpt-4o"]["output_tokens"] == 5 * 2 * 100
    assert rows["gpt-4o"]["cost"] == total / 1e6 * 1.25 + 1000 / 1e6 * 5.0
    assert rows["o4-mini"]["output_cost"] == 1000 / 1e6 * 2.2
    letters = TokenCounter(lambda text: F.length(text).cast("bigint"))
    mixed = estimate_cost(prompts, rubrics, ["gpt-4o", "o4-mini"], 100, counters={"gpt-4o": letters, "o4-mini": DEFAULT_COUNTER})
    found = {r["model"]: r["input_tokens"] for r in mixed.collect()}
    assert found["o4-mini"] == total and found["gpt-4o"] > total
    exact = estimate_cost(prompts, rubrics, "gpt-4o", estimation="exact").first()
    assert exact["input_tokens"] == input_tokens_exact(prompts, rubrics).agg(F.sum("input_tokens")).first()[0]
    with pytest.raises(ValueError, match="no price"):
        estimate_cost(prompts, rubrics, ["gpt-4o", "zzz"])
    with pytest.raises(ValueError, match="estimation"):
        estimate_cost(prompts, rubrics, "gpt-4o", estimation="about")
