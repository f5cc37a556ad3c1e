"""Summaries of annotations, batches and jobs.

Numbers come back unrounded.  Percentages are of 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import MODEL_PRICES
from ..functions.paths import shared_keys
from ..functions.pricing import Prices, price_of
from ..functions.times import iso_utc

_FILE = ("file_path", "file_block")
_SUMS = ("n", "prompt_tokens", "completion_tokens", "completion_squares", "stop", "length", "other")


def _place(frame: DataFrame) -> list[str]:
    """What names a part: its run too, if the frame has it."""
    return ["run", "part"] if "run" in frame.columns else ["part"]


def _percent(count: Column, total: Column) -> Column:
    return F.try_divide(count * 100.0, total)


def _percent_of_ratio(count: Column, total: Column) -> Column:
    return F.try_divide(count.cast("double"), total) * 100.0


def _over_all() -> Window:
    # Used on aggregated rows only: one row per group.
    return Window.partitionBy()


# --- Annotations -----------------------------------------------------------

def annotation_summary(annotations: DataFrame, *by: str) -> DataFrame:
    """``total``, and count and percent of successful and failed annotations.

    Over everything, or per group of ``by``.  Over everything, no annotations
    is an error.  Lines that are marked as ``quarantined`` are no annotations;
    where there is such a mark their number is added as ``bad``.
    """
    marked = "quarantined" in annotations.columns
    good = ~F.col("quarantined") if marked else F.lit(True)
    counted = annotations.groupBy(*by).agg(
        F.count_if(good).alias("total"), F.count_if(good & F.col("level").isNotNull()).alias("successful"),
        *([F.count_if(F.col("quarantined")).alias("bad")] if marked else []),
    )
    total = F.col("total")
    if not by:
        total = F.when(total == 0, F.raise_error(F.lit("no annotations"))).otherwise(total)
    failed = total - F.col("successful")
    return counted.select(
        *by, total.alias("total"), "successful",
        _percent(F.col("successful"), total).alias("successful_percent"),
        failed.alias("failed"), _percent(failed, total).alias("failed_percent"), *(["bad"] if marked else []),
    )


def failed_breakdown(annotations: DataFrame) -> DataFrame:
    """Failed annotations by finish reason: ``finish_reason, count, percent``."""
    counts = (
        annotations.filter(F.col("level").isNull())
        .groupBy("finish_reason").agg(F.count("*").alias("count"))
    )
    share = _percent(F.col("count"), F.sum("count").over(_over_all()))
    return counts.select("finish_reason", "count", share.alias("percent"))


# --- Tokens, finish reasons and cost of a part ------------------------------

def usage_partials(outputs: DataFrame) -> DataFrame:
    """Sums per part, model and piece of a file, which add up in any grouping.

    All of them are plain numbers, so the scan aggregates in a hash table; the
    model of a part's last line is settled later, on these few rows.
    """
    reason = F.col("finish_reason")
    completion = F.coalesce("completion_tokens", F.lit(0))
    lines = outputs.filter(F.col("corrupt_record").isNull())
    exact = completion.cast("decimal(19,0)")
    return lines.groupBy(*_place(outputs), "model", *_FILE).agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("prompt_tokens", F.lit(0))).alias("prompt_tokens"),
        F.sum(completion).alias("completion_tokens"),
        F.sum((exact * exact).cast("decimal(28,0)")).alias("completion_squares"),
        F.max(completion).alias("max_completion"),
        F.min(completion).alias("min_completion"),
        F.count_if(reason.eqNullSafe("stop")).alias("stop"),
        F.count_if(reason.eqNullSafe("length")).alias("length"),
        F.count_if(~reason.eqNullSafe("stop") & ~reason.eqNullSafe("length")).alias("other"),
        F.max("file_pos").alias("last_pos"),
    )


def add_partials(partials: DataFrame) -> DataFrame:
    """Partial sums of the same form, one row per part and model; the last line's place is kept."""
    return partials.groupBy(*_place(partials), "model").agg(
        F.max(F.struct(*_FILE, "last_pos")).alias("_last"),
        *[F.sum(name).cast(partials.schema[name].dataType).alias(name) for name in _SUMS],
        F.max("max_completion").alias("max_completion"), F.min("min_completion").alias("min_completion"),
    ).select(*_place(partials), "model", "_last.*", *_SUMS, "max_completion", "min_completion").select(partials.columns)


def merge_usage(partials: DataFrame) -> DataFrame:
    """One row per part from its partial sums.

    The deviation comes from whole numbers, ``n * sum(x * x) - sum(x) ** 2``, so it is
    exact up to its last step however large the mean is.
    """
    place = _place(partials)
    merged = partials.groupBy(*place).agg(
        *[F.sum(name).alias(name) for name in _SUMS],
        F.max("max_completion").alias("max_completion"),
        F.min("min_completion").alias("min_completion"),
        F.max_by("model", F.struct(*_FILE, "last_pos", "model")).alias("model"),
    )
    n, total = F.col("n"), F.col("completion_tokens").cast("double")
    whole = F.col("completion_tokens").cast("decimal(19,0)")
    spread = F.col("completion_squares") * n - whole * whole
    variance = spread.cast("double") / (n * (n - 1)).cast("double")
    return merged.select(
        *place, "model", "n", "prompt_tokens", "completion_tokens",
        (total / n).alias("avg_completion"),
        F.when(n > 1, F.sqrt(variance)).alias("std_completion"),
        "max_completion", "min_completion", "stop", "length", "other",
    )


def batch_usage(outputs: DataFrame) -> DataFrame:
    """Token statistics per part.  The deviation is that of a sample, NULL for
    a single line; missing usage counts as 0."""
    return merge_usage(usage_partials(outputs))


def finish_reason_counts(usage: DataFrame) -> DataFrame:
    return usage.select(*_place(usage), "stop", "length", "other", F.col("n").alias("total"))


def batch_cost(usage: DataFrame, prices: Prices = MODEL_PRICES, match: str = "first") -> DataFrame:
    """Adds ``cost_prompt, cost_completion, cost_total`` in USD."""
    price = price_of(F.col("model"), prices, match)
    priced = usage.withColumn("_price", price)
    return priced.select(
        *usage.columns,
        (F.col("prompt_tokens") / 1e6 * F.col("_price.input")).alias("cost_prompt"),
        (F.col("completion_tokens") / 1e6 * F.col("_price.output")).alias("cost_completion"),
    ).withColumn("cost_total", F.col("cost_prompt") + F.col("cost_completion"))


def batch_summary(
    metadata: DataFrame, usage: DataFrame, prices: Prices = MODEL_PRICES, match: str = "first"
) -> DataFrame:
    """One row per batch: its metadata with the usage and cost of its part.

    A batch without output has zero usage; a running one has no duration.  Usage of
    several runs needs metadata that says which run each batch belongs to.
    """
    if "run" in usage.columns and "run" not in metadata.columns:
        raise ValueError("the usage is per run, but the metadata does not name runs")
    cost = batch_cost(usage, prices, match)
    place = shared_keys(metadata.columns, usage.columns)
    joined = metadata.join(cost, place, "left")
    run = [name for name in ("run",) if name in metadata.columns]

    def zero(name):
        return F.coalesce(name, F.lit(0))

    # An empty object or list is no error.
    failed = F.col("errors").isNotNull() & ~F.btrim("errors").isin("", "{}", "[]", "null", "false", "0", '""')
    return joined.select(
        *run,
        F.col("id").alias("batch_id"), "model", "status",
        iso_utc(F.col("created_at")).alias("created_at"),
        iso_utc(F.col("completed_at")).alias("completed_at"),
        (F.col("completed_at") - F.col("created_at")).alias("duration"),
        F.col("part").alias("subdomain"),
        F.col("request_counts.total").alias("requests_total"),
        F.col("request_counts.completed").alias("requests_completed"),
        F.col("request_counts.failed").alias("requests_failed"),
        zero("stop").alias("finish_stop"),
        zero("length").alias("finish_length"),
        zero("other").alias("finish_other"),
        zero("n").alias("finish_total"),
        zero("prompt_tokens").alias("tokens_prompt"),
        zero("completion_tokens").alias("tokens_completion"),
        F.col("avg_completion").alias("tokens_avg_completion"),
        F.col("std_completion").alias("tokens_std_completion"),
        zero("max_completion").alias("tokens_max_completion"),
        zero("min_completion").alias("tokens_min_completion"),
        (zero("prompt_tokens") + zero("completion_tokens")).alias("tokens_total"),
        F.coalesce("cost_prompt", F.lit(0.0)).alias("cost_prompt"),
        F.coalesce("cost_completion", F.lit(0.0)).alias("cost_completion"),
        F.coalesce("cost_total", F.lit(0.0)).alias("cost_total"),
        F.when(failed, F.col("error_file_id")).alias("error_file_id"),
        "errors",
    )


# --- Over all batches --------------------------------------------------------

def _pooled_sums() -> list[Column]:
    """Sums over batches from which mean and deviation follow, in any grouping and in one pass.

    A mean is cut into its whole number and the rest, so that the large terms, which
    cancel in the end, are sums of whole numbers and exact.
    """
    n, mean = F.col("requests_total"), F.coalesce("tokens_avg_completion", F.lit(0.0))
    std = F.coalesce("tokens_std_completion", F.lit(0.0))
    count, whole = n.cast("decimal(19,0)"), F.floor(mean).cast("decimal(19,0)")
    rest = mean - F.floor(mean)
    weighted = (count * whole).cast("decimal(38,0)")
    return [
        F.coalesce(F.sum("tokens_completion"), F.lit(0)).alias("tokens_completion"),
        F.sum(n).alias("_n"),
        F.sum(weighted).alias("_wholes"),
        F.sum((weighted * whole).cast("decimal(38,0)")).alias("_whole_squares"),
        F.sum(count * rest.cast("decimal(16,16)")).alias("_rests"),
        F.sum(weighted.cast("decimal(22,0)") * rest.cast("decimal(16,16)")).alias("_products"),
        F.sum(n * rest * rest).alias("_rest_squares"),
        # Squares within the batches.
        F.sum((n - 1) * std * std).alias("_within"),
        F.max("tokens_max_completion").alias("_max"),
        F.min("tokens_min_completion").alias("_min"),
    ]


def _pooled_columns() -> list[Column]:
    n, count = F.col("_n"), F.col("_n").cast("decimal(19,0)")
    wholes, rests = F.col("_wholes"), F.col("_rests")
    mean = F.try_divide(wholes.cast("double") + rests.cast("double"), n)
    # n times the squares of the batches' means around the overall one.
    spread = (
        (F.col("_whole_squares") * count - wholes * wholes).cast("double")
        + 2 * (F.col("_products") * count - wholes * rests).cast("double")
        + F.col("_rest_squares") * n - rests.cast("double") * rests.cast("double")
    )
    squares = F.col("_within") + F.try_divide(spread, n)
    deviation = F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1))).otherwise(0.0)

    def or_zero(value, zero):
        return F.when(F.col("tokens_completion") > 0, value).otherwise(F.lit(zero))

    return [
        F.col("tokens_completion"),
        or_zero(mean, 0.0).alias("tokens_avg_completion"),
        or_zero(deviation, 0.0).alias("tokens_std_completion"),
        or_zero(F.col("_max"), 0).alias("tokens_max_completion"),
        or_zero(F.col("_min"), 0).alias("tokens_min_completion"),
    ]


def pooled_token_stats(summaries: DataFrame) -> DataFrame:
    """Completion tokens of all batches from their summaries alone.

    Means and deviations are weighted with ``requests_total``: the variance is
    ``(sum (n-1) s^2 + sum n (m-M)^2) / (N-1)`` with M the overall mean.  The
    summaries are gone through once, however they were made.  All zero if no batch
    has completion tokens.
    """
    return summaries.agg(*_pooled_sums()).select(*_pooled_columns())


def general_summary(summaries: DataFrame) -> DataFrame:
    """One row over all batch summaries.

    ``demands`` and ``models`` list what occurs; both are as short as the
    rubric table and the service's model list.  The parts themselves can be
    many, so they are counted here and listed by ``summary_members``.
    """
    status = F.col("status")
    completed, failed = status.eqNullSafe("completed"), status.eqNullSafe("failed")
    demand = F.substring_index("subdomain", "_", 1)
    sums = ["requests_total", "requests_completed", "requests_failed",
            "finish_stop", "finish_length", "finish_other",
            "tokens_prompt", "tokens_total", "cost_prompt", "cost_completion", "cost_total"]
    finished = F.col("finish_stop") + F.col("finish_length") + F.col("finish_other")
    return summaries.agg(
        F.count("*").alias("batches"),
        F.count_distinct(*[name for name in ("run",) if name in summaries.columns], "subdomain").alias("n_subdomains"),
        F.sort_array(F.collect_set(demand)).alias("demands"),
        F.sort_array(F.collect_set("model")).alias("models"),
        F.avg("duration").alias("duration_mean"),
        F.coalesce(F.stddev_samp("duration"), F.lit(0.0)).alias("duration_std"),
        F.count_if(completed).alias("status_completed"),
        F.count_if(failed).alias("status_failed"),
        F.count_if(~completed & ~failed).alias("status_others"),
        *[F.sum(name).alias(name) for name in sums],
        *_pooled_sums(),
    ).select(
        "batches", "n_subdomains", "demands", "models", "duration_mean", "duration_std",
        "status_completed", "status_failed", "status_others",
        *sums, finished.alias("finish_total"), *_pooled_columns(),
    )


def summary_members(summaries: DataFrame) -> DataFrame:
    """The distinct parts and models: ``kind, name, batches``."""
    pairs = F.array(
        F.struct(F.lit("subdomain").alias("kind"), F.col("subdomain").alias("name")),
        F.struct(F.lit("model").alias("kind"), F.col("model").alias("name")),
    )
    return (
        summaries.select(F.inline(pairs)).groupBy("kind", "name")
        .agg(F.count("*").alias("batches"))
    )


# --- Jobs --------------------------------------------------------------------

def status_histogram(jobs: DataFrame) -> DataFrame:
    """Jobs per status with their percentage; an unknown status is ``error``."""
    counts = jobs.groupBy(F.coalesce("status", F.lit("error")).alias("status")).agg(
        F.count("*").alias("count")
    )
    share = _percent_of_ratio(F.col("count"), F.sum("count").over(_over_all()))
    return counts.select("status", "count", share.alias("percentage"))


def batch_progress(jobs: DataFrame, status: str = "in_progress") -> DataFrame:
    """Completed share of the running batches: ``id, completed, total, percentage``."""
    done, total = F.col("request_counts.completed"), F.col("request_counts.total")
    return jobs.filter(F.col("status") == status).select(
        "id", done.alias("completed"), total.alias("total"),
        _percent_of_ratio(done, total).alias("percentage"),
    )
