"""Dealing the requests of a demand into parts of bounded size.

Everything here works on narrow rows.  Sizes are sums over prompts plus a
constant per rubric, so no request is rendered to learn how big it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import REQUEST_MAX_TOKENS, REQUEST_MODEL, REQUEST_URL
from .requests import pair_with, request_columns, request_halves


def _json_bytes(text: Column) -> Column:
    """Bytes of a string as JSON, without its quotes.

    Escaping works character by character, so these add up over the pieces of
    a text.
    """
    return F.octet_length(F.to_json(F.struct(text.alias("v")))) - len('{"v":""}')


def varying_bytes() -> Column:
    """What ``custom_id`` and ``prompt`` add to the bytes of a request line."""
    return _json_bytes(F.col("custom_id")) + _json_bytes(F.col("prompt"))


def _constant_bytes(model: str, max_tokens: int, url: str) -> Column:
    """Bytes of a rubric's request line with its line break, less ``varying_bytes``."""
    empty = request_columns(F.lit(""), F.concat("prefix", "suffix"), model, max_tokens, url)
    return F.octet_length(F.to_json(F.struct(*empty))) + 1


def request_sizes(
    prompts: DataFrame,
    rubrics: DataFrame,
    model: str = REQUEST_MODEL,
    max_tokens: int = REQUEST_MAX_TOKENS,
    url: str = REQUEST_URL,
    varying: Column | None = None,
) -> DataFrame:
    """Lines and bytes of every demand's requests: ``demand, n_lines, n_bytes``.

    Exactly the bytes of the JSON lines, from one pass over the prompts.
    ``varying`` is a column that already holds ``varying_bytes()``.
    """
    varying = varying_bytes() if varying is None else varying
    totals = prompts.agg(F.struct(
        F.count("*").alias("n"), F.coalesce(F.sum(varying), F.lit(0)).alias("varying")
    ).alias("totals"))
    constant = _constant_bytes(model, max_tokens, url)
    return request_halves(rubrics).withColumn("_t", totals.scalar()).select(
        "demand", F.col("_t.n").alias("n_lines"),
        (F.col("_t.varying") + F.col("_t.n") * constant).cast("bigint").alias("n_bytes"),
    )


def need_split(sizes: DataFrame, max_lines: int | None, max_bytes: int | None) -> DataFrame:
    """Adds ``need_split``: more lines or bytes than allowed; None allows all."""
    needed = F.lit(False)
    if max_lines is not None:
        needed = needed | (F.col("n_lines") > max_lines)
    if max_bytes is not None:
        needed = needed | (F.col("n_bytes") > max_bytes)
    return sizes.withColumn("need_split", needed)


def _div(value: Column, by: Column | int) -> Column:
    """Whole-number division, exact for any BIGINT."""
    return F.call_function("div", value, F.lit(by) if isinstance(by, int) else by)


def _ceil_div(value: Column, by: int) -> Column:
    return _div(value + (by - 1), by)


def split_plan(sizes: DataFrame, max_lines: int | None, max_bytes: int | None) -> DataFrame:
    """Adds ``num_parts`` and ``need_split`` to ``demand, n_lines, n_bytes``.

    By bytes first; if that leaves ``max_lines`` or more in a part, by lines.
    """
    if max_lines is None and max_bytes is None:
        raise ValueError("give max_lines, max_bytes or both")
    n = F.col("n_lines")
    by_lines = _ceil_div(n, max_lines) if max_lines is not None else None
    if max_bytes is None:
        parts = by_lines
    else:
        parts = F.greatest(_ceil_div(F.col("n_bytes"), max_bytes), F.lit(1))
        if max_lines is not None:
            parts = F.when(_div(n, parts) >= max_lines, by_lines).otherwise(parts)
    checked = need_split(sizes, max_lines, max_bytes)
    return checked.withColumn("num_parts", F.greatest(parts, F.lit(1)).cast("bigint"))


def parts_of(plan: DataFrame) -> Column:
    """Parts a demand really gets: one unless it needs a split."""
    return F.when(plan["need_split"], plan["num_parts"]).otherwise(1)


def number_parts(plan: DataFrame) -> DataFrame:
    """Adds ``first_part``: parts of the demands before this one.  The plan has
    one row per rubric, so a running sum over it is short."""
    earlier = Window.partitionBy().orderBy("demand").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(parts_of(plan)).over(earlier), F.lit(0))
    return plan.withColumn("first_part", before.cast("bigint"))


def _deal(index: Column, n: Column, parts: Column) -> tuple[Column, Column, Column]:
    """Part number (1-based), row within the part and rows of the part, when
    ``n`` rows are dealt in order and the first ``n % parts`` parts get one more."""
    least = _div(n, parts)
    extra = n % parts
    in_long_parts = extra * (least + 1)
    is_long = index < in_long_parts
    # ``least`` is 0 only when every row lies in a long part.
    short = F.greatest(least, F.lit(1))
    beyond = index - in_long_parts
    number = F.when(is_long, _div(index, least + 1)).otherwise(extra + _div(beyond, short)) + 1
    row = F.when(is_long, index % (least + 1)).otherwise(beyond % short)
    size = F.when(is_long, least + 1).otherwise(least)
    return number.cast("bigint"), row.cast("bigint"), size.cast("bigint")


def part_name(demand: str, need_split: str, number: Column) -> Column:
    """A demand that needs no split is one part named after it."""
    name = F.when(F.col(need_split), F.concat(demand, F.lit("_part"), number.cast("string")))
    return F.coalesce(name, demand)


def deal_once(indexed: DataFrame, plan: DataFrame) -> DataFrame:
    """Every indexed prompt once for each number of parts that demands are cut into.

    Adds ``_parts, part_no, part_row``.  Demands with equally many parts are cut at
    the same prompts, so there are few of these numbers, often one.
    """
    cuts = plan.select(parts_of(plan).cast("bigint").alias("_parts")).distinct()
    number, row, _ = _deal(F.col("row_index"), F.col("n_rows"), F.col("_parts"))
    return pair_with(indexed, cuts).withColumns({"part_no": number, "part_row": row})


def demands_by_parts(plan: DataFrame) -> Column:
    """``_parts`` to the demands with so many parts, as one constant map."""
    cut = plan.select(parts_of(plan).cast("bigint").alias("_parts"), F.struct("demand", "need_split").alias("d"))
    grouped = cut.groupBy("_parts").agg(F.collect_list("d").alias("ds"))
    return grouped.agg(F.map_from_entries(F.collect_list(F.struct("_parts", "ds")))).scalar()


def assign_parts(indexed: DataFrame, plan: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every indexed prompt with every demand of the plan, and its part.

    Adds ``demand, part, part_no, part_row, part_rows`` and the plan's
    ``carry`` columns to those of ``indexed``.  A demand that needs no split
    is one part named after it.  Parts without rows do not appear.
    """
    dimension = plan.select("demand", parts_of(plan).alias("_parts"), "need_split", *carry)
    pairs = pair_with(indexed, dimension)
    number, row, size = _deal(F.col("row_index"), F.col("n_rows"), F.col("_parts"))
    return pairs.select(
        *indexed.columns, "demand", part_name("demand", "need_split", number).alias("part"),
        number.alias("part_no"), row.alias("part_row"), size.alias("part_rows"), *carry,
    )


def halve_part(rows: DataFrame, index: str = "part_row", size: str = "part_rows") -> DataFrame:
    """Adds ``half``: 1 for the first ``floor(size / 2)`` rows, else 2."""
    return rows.withColumn(
        "half", F.when(F.col(index) < _div(F.col(size), 2), 1).otherwise(2)
    )


# --- Cuts that hold for every single part ------------------------------------

#: Rows whose running sums are taken together, by their number.
BLOCK_ROWS = 1 << 16


def exact_cuts(
    indexed: DataFrame,
    rubrics: DataFrame,
    max_lines: int | None,
    max_bytes: int,
    model: str = REQUEST_MODEL,
    max_tokens: int = REQUEST_MAX_TOKENS,
    url: str = REQUEST_URL,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Parts none of which is larger than allowed: ``part_no, first_index, part_rows``.

    ``indexed`` has ``row_index`` and ``varying``.  All demands are cut at the same
    prompts, by the lines of the rubric with the longest text.  With ``longest`` the longest
    of these lines, a part holds the lines that begin within ``max_bytes - longest + 1``
    bytes of each other; the last one may reach ``longest`` further, so a part has
    at most ``max_bytes`` whatever its lines are like.  Parts with too many lines are cut again.

    Where a line begins is a sum over all lines before it: sums of blocks of rows, summed
    up over the blocks, and then within each block.  Only numbers move.  A line that is
    longer than a part may be is an error.
    """
    constant = request_halves(rubrics).agg(F.max(_constant_bytes(model, max_tokens, url)).alias("c")).first()["c"] or 0
    lines = indexed.select("row_index", (F.col("varying") + constant).cast("bigint").alias("bytes")).withColumn(
        "block", _div(F.col("row_index"), block_rows))
    longest = lines.agg(F.max("bytes").alias("longest")).first()["longest"] or 0
    if longest > max_bytes:
        raise ValueError(f"a request line has {longest} bytes, more than the {max_bytes} of a part")
    width = max_bytes - longest + 1
    # One row for each block.
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("block").agg(F.sum("bytes").alias("sum")).select(
        "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("block").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.col("before") + F.coalesce(F.sum("bytes").over(within), F.lit(0))
    placed = lines.join(blocks, "block").select("row_index", _div(begins, width).alias("stretch"))
    # One row for each part.
    parts = placed.groupBy("stretch").agg(F.min("row_index").alias("first_index"), F.count("*").alias("part_rows"))
    if max_lines is not None:
        again = F.explode(F.sequence(F.lit(0), _ceil_div(F.col("part_rows"), max_lines) - 1)).alias("i")
        parts = parts.select("first_index", "part_rows", again).select(
            (F.col("first_index") + F.col("i") * max_lines).alias("first_index"),
            F.least(F.lit(max_lines), F.col("part_rows") - F.col("i") * max_lines).alias("part_rows"))
    number = F.row_number().over(Window.orderBy("first_index")).cast("bigint")
    return parts.select(number.alias("part_no"), "first_index", F.col("part_rows").cast("bigint").alias("part_rows"))


def deal_exactly(indexed: DataFrame, parts: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``part_no, part_row, part_rows`` by the parts of ``exact_cuts``.

    The parts that meet a block of row numbers are few, so each row looks at the few of its block.
    """
    last = F.col("first_index") + F.col("part_rows") - 1
    block = F.explode(F.sequence(_div(F.col("first_index"), block_rows), _div(last, block_rows))).alias("_block")
    by_block = parts.select(block, F.struct("first_index", "part_no", "part_rows").alias("p")).groupBy("_block").agg(
        F.array_sort(F.collect_list("p")).alias("_parts"))
    own = F.element_at(F.filter("_parts", lambda p: p.first_index <= F.col("row_index")), -1)
    return (
        indexed.withColumn("_block", _div(F.col("row_index"), block_rows)).join(by_block, "_block")
        .withColumn("_own", own)
        .withColumns({"part_no": F.col("_own.part_no"), "part_rows": F.col("_own.part_rows"),
                      "part_row": F.col("row_index") - F.col("_own.first_index")})
        .drop("_block", "_parts", "_own")
    )
