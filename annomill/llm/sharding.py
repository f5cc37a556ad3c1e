"""Consistent hashing with bounded loads.

The ring is cut into ``cells`` equal cells.  Every shard owns ``points`` places
on it; a row's key hashes to a cell, and the row belongs to the first point from
there clockwise.  Rows are taken cell by cell from the ring's start, within a
cell in hash order; a row whose shard is full goes on clockwise to the next
point of a shard with room.

* ``slack=0``: shards hold the same number of rows, at most one apart.
* ``slack=x``: a shard holds at most ``1 + x`` times its share; fewer rows move
  when a shard is added.
* ``slack=None``: no bound; the key and the number of shards alone decide, and
  one more shard takes rows only into itself.

What is collected and broadcast is one count per cell, so ``cells`` rows at most
however many rows there are.  Rows are numbered within their cell, which is the
only shuffle.

Defined cases: a NULL key is a key like others; equal rows lie next to each
other; an empty table gives an empty table; other columns are carried along
unless they are called as the result's are.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POINTS = 128
CELL_BITS = 14


def ring(spark: SparkSession, shards: int, points: int, bits: int) -> tuple[list[int], list[int]]:
    """Cells and shards of all points in ring order.

    A shard's places do not depend on how many other shards there are.
    """
    made = spark.range(shards).selectExpr("id AS shard", f"explode(sequence(0, {points - 1})) AS point")
    placed = made.selectExpr("xxhash64('ring', shard, point) AS place", "shard").collect()
    order = sorted((row.place % (1 << 62), row.shard) for row in placed)
    return [place >> (62 - bits) for place, _ in order], [shard for _, shard in order]


def quotas(total: int, shards: int, slack: float | None) -> list[int]:
    """Most rows of each shard; without slack they add up to the total."""
    if slack is None:
        return [total] * shards
    if slack:
        return [int(-(-total * (1 + slack) // shards))] * shards
    return [total // shards + (shard < total % shards) for shard in range(shards)]


def runs(sizes: list[tuple[int, int]], at: list[int], owner: list[int], quota: list[int]) -> list[tuple]:
    """``(cell, [(first rank, shard, its slot)])`` for each ``(cell, rows)``."""
    out, held = [], [0] * len(quota)
    for cell, size in sorted(sizes):
        point, rank, parts = bisect_left(at, cell), 0, []
        while rank < size:
            shard = owner[point % len(owner)]
            taken = min(size - rank, quota[shard] - held[shard])
            if taken:
                parts.append((rank, shard, held[shard]))
                held[shard] += taken
                rank += taken
            point += 1
        out.append((cell, parts))
    return out


def cell_of(key: list[str], bits: int):
    place = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in key]), F.lit(1 << 62))
    return place, F.shiftright(place, 62 - bits)


def place(rows: DataFrame, shards: int, key: list[str], ties: list[str], slack: float | None = 0.0,
          points: int = POINTS, bits: int = CELL_BITS) -> DataFrame:
    """Adds ``shard`` and ``slot``, the row's number within its shard from 0.

    ``key`` and ``ties`` together should tell rows apart; rows alike in both are
    interchangeable.
    """
    spark = rows.sparkSession
    at, owner = ring(spark, shards, points, bits)
    hashed, cell = cell_of(key, bits)
    sizes = [(row.cell, row["count"]) for row in rows.select(cell.alias("cell")).groupBy("cell").count().collect()]
    quota = quotas(sum(size for _, size in sizes), shards, slack)
    plan = spark.createDataFrame(runs(sizes, at, owner, quota),
                                 "_cell long, _parts array<struct<first: long, shard: int, slot: long>>")
    order = Window.partitionBy("_cell").orderBy("_place", *[f"`{name}`" for name in [*key, *ties]])
    numbered = (
        rows.drop("shard", "slot").withColumn("_place", hashed).withColumn("_cell", cell)
        .withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    )
    part = F.element_at(F.filter("_parts", lambda p: p.first <= F.col("_rank")), -1)
    return (
        numbered.join(F.broadcast(plan), "_cell").withColumn("_part", part)
        .withColumn("shard", F.col("_part.shard"))
        .withColumn("slot", F.col("_part.slot") + F.col("_rank") - F.col("_part.first"))
        .drop("_cell", "_place", "_rank", "_parts", "_part")
    )


def owners(rows: DataFrame, shards: int, key: list[str], name: str = "shard",
           points: int = POINTS, bits: int = CELL_BITS) -> DataFrame:
    """Adds the shard that the key alone decides; a lookup, without a shuffle."""
    spark = rows.sparkSession
    at, owner = ring(spark, shards, points, bits)
    table = spark.createDataFrame(
        [(cell, owner[bisect_left(at, cell) % len(owner)]) for cell in range(1 << bits)], f"_cell long, `{name}` int")
    cell = cell_of(key, bits)[1]
    return rows.drop(name).withColumn("_cell", cell).join(F.broadcast(table), "_cell").drop("_cell")
