"""Request files, one per part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    MAX_PART_BYTES, MAX_PART_LINES, REQUEST_MAX_TOKENS, REQUEST_MODEL, REQUEST_URL,
)
from ..operators.positions import POSITION, with_file_index, with_row_index
from ..operators.requests import pair_with, request_columns, request_halves
from ..operators.sizes import fits_in_memory
from ..operators.splitting import (
    assign_parts, deal_exactly, deal_once, demands_by_parts, exact_cuts, number_parts, part_name, parts_of, request_sizes, split_plan,
    varying_bytes,
)
from ..session import scratch_removed, stored

# A task writes whole parts, one after the other, up to about this many bytes.
TASK_BYTES = 256 * 1024 * 1024


def write_requests(
    prompts: DataFrame,
    rubrics: DataFrame,
    path: str,
    model: str = REQUEST_MODEL,
    max_tokens: int = REQUEST_MAX_TOKENS,
    url: str = REQUEST_URL,
    max_lines: int | None = MAX_PART_LINES,
    max_bytes: int | None = MAX_PART_BYTES,
    order_by: tuple[str, ...] | None = None,
    cuts: str = "even",
    compression: str | None = None,
) -> None:
    """JSON lines below ``path/demand=<demand>/part=<part>/``.

    With a limit, every part is one file with its requests in order: prompts are
    numbered once and moved once for each number of parts that demands are cut
    into, to the task that writes their part of all these demands; demands and the
    long text around the prompts are added only there.  A task writes the parts of
    one cut, or several small ones, so it is bounded as parts are.
    Without any limit there is one part per demand, written by many tasks as
    many files, and no shuffle.

    Requests keep the order of the prompt files if the prompts were read with
    their position; otherwise they are ordered by ``order_by`` or the id.  What is
    stored on the way is taken away in the end.

    ``cuts="even"`` deals equally many lines to the parts, so ``max_bytes`` holds for their
    mean.  ``cuts="exact"`` cuts all demands where no part has more bytes or lines than
    allowed: see ``exact_cuts``.

    ``compression`` names a codec for the files, such as ``gzip``: every request repeats its
    prompt and its rubric.  Limits hold for the lines, not for the compressed files.
    """
    if cuts not in ("even", "exact"):
        raise ValueError("cuts must be 'even' or 'exact'")
    if cuts == "exact" and max_bytes is None:
        raise ValueError("exact cuts need max_bytes")
    with scratch_removed(prompts.sparkSession):
        _write(prompts, rubrics, path, model, max_tokens, url, max_lines, max_bytes, order_by, cuts, compression)


def _write(prompts, rubrics, path, model, max_tokens, url, max_lines, max_bytes, order_by, cuts, compression) -> None:
    halves = request_halves(rubrics)
    # Too many rubrics to hold their texts in every task: the texts then travel
    # with the rows instead of being looked up at the end.
    carry = () if fits_in_memory(halves) else ("prefix", "suffix")
    if max_lines is None and max_bytes is None:
        pairs = pair_with(prompts.select("custom_id", "prompt"), halves.select("demand", *carry))
        placed = pairs.withColumn("part", F.col("demand")).sortWithinPartitions("demand", "part")
    elif cuts == "exact":
        indexed = _number(prompts, order_by)
        parts = stored(exact_cuts(indexed, rubrics, max_lines, max_bytes, model, max_tokens, url), "exact-cuts")
        placed = _place_exactly(indexed, parts, halves, carry)
    else:
        indexed = _number(prompts, order_by)
        sizes = request_sizes(indexed, rubrics, model, max_tokens, url, F.col("varying"))
        plan = stored(number_parts(split_plan(sizes, max_lines, max_bytes)), "split-plan")
        placed = _place(indexed.drop("varying"), plan, halves, carry)

    if carry:
        instruction = F.concat("prefix", "prompt", "suffix")
    else:
        # A lookup in a constant, unlike a join, is sure to keep the rows' order.
        texts = halves.agg(F.map_from_entries(F.collect_list(
            F.struct("demand", F.struct("prefix", "suffix"))
        ))).scalar()
        placed = placed.withColumn("_around", F.element_at(texts, F.col("demand")))
        instruction = F.concat("_around.prefix", "prompt", "_around.suffix")
    fields = request_columns(F.col("custom_id"), instruction, model, max_tokens, url)
    (
        placed.select("demand", "part", *fields).write.mode("overwrite").partitionBy("demand", "part")
        .options(**({"compression": compression, "zlib.compress.level": "BEST_SPEED"} if compression else {})).json(path)
    )


def _number(prompts: DataFrame, order_by: tuple[str, ...] | None) -> DataFrame:
    """``custom_id, prompt, varying, row_index, n_rows``."""
    columns = ["custom_id", "prompt", varying_bytes().alias("varying")]
    if order_by is None and all(name in prompts.columns for name in POSITION):
        return with_file_index(prompts.select(*columns, *POSITION))
    keys = list(order_by or ("custom_id",))
    extra = [key for key in keys if key not in ("custom_id", "prompt")]
    return with_row_index(prompts.select(*columns, *extra), keys).drop(*extra)


def _place_exactly(indexed: DataFrame, parts: DataFrame, halves: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The same for cuts that all demands share: a task takes whole parts, the demands are added there."""
    known = parts.count()
    cores = indexed.sparkSession.sparkContext.defaultParallelism
    varying = indexed.agg(F.sum("varying")).first()[0] or 0
    tasks = min(max(known, 1), max(2 * cores, -(-varying * max(halves.count(), 1) // TASK_BYTES)))
    dealt = deal_exactly(indexed.drop("n_rows"), parts).drop("row_index", "varying", "part_rows")
    dealt = dealt.withColumn("_task", F.pmod(F.col("part_no") - 1, F.lit(tasks)).cast("int")).repartitionById(tasks, "_task")
    paired = pair_with(dealt, halves.select("demand", *carry))
    name = part_name("demand", "_several", F.col("part_no"))
    return (
        paired.withColumn("_several", F.lit(known > 1)).withColumn("part", name).drop("_several", "part_no", "_task")
        .sortWithinPartitions("demand", "part", "part_row")
    )


def _place(indexed: DataFrame, plan: DataFrame, halves: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Rows in the task and order in which they are written."""
    total = plan.agg(F.sum(parts_of(plan)).alias("parts"), F.sum("n_bytes").alias("bytes")).first()
    cores = indexed.sparkSession.sparkContext.defaultParallelism
    wanted = max(2 * cores, -(-(total["bytes"] or 0) // TASK_BYTES))
    if not carry:
        cuts = plan.select(parts_of(plan).alias("p")).distinct().agg(F.sum("p")).first()[0]
        tasks = int(min(max(cuts or 0, 1), wanted))
        dealt = (
            deal_once(indexed, plan)
            .withColumn("_task", F.pmod(F.col("part_no") - 1 + F.xxhash64("_parts") % 1_000_003, F.lit(tasks)).cast("int"))
            .drop("row_index", "n_rows").repartitionById(tasks, "_task")
        )
        demand = F.explode(F.element_at(demands_by_parts(plan), F.col("_parts")))
        return (
            dealt.withColumn("_d", demand).withColumn("demand", F.col("_d.demand"))
            .withColumn("part", part_name("_d.demand", "_d.need_split", F.col("part_no")))
            .drop("_d", "_parts").sortWithinPartitions("demand", "part", "part_row")
        )
    parts = max(total["parts"] or 0, 1)
    tasks = min(parts, wanted)
    texts = plan.join(halves, "demand")
    assigned = assign_parts(indexed, texts, ("first_part", *carry))
    number = F.col("first_part") + F.col("part_no") - 1
    return (
        assigned.withColumn("_task", F.floor(number * tasks / parts).cast("int"))
        .drop("row_index", "n_rows", "part_no", "part_rows", "first_part")
        .repartitionById(tasks, "_task")
        .sortWithinPartitions("demand", "part", "part_row")
    )
