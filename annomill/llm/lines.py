"""Drops lines that repeat an earlier one, exactly or up to one edit.

A line is dropped if an equal line, or one that differs by a character put in,
taken out or replaced, stands earlier: in a row of a smaller id or further up in
the same text.  Lines are judged on the input.  Blank lines stay, and lines with
fewer than ``LEAST_CHARS`` characters are dropped as exact repeats only.

Near lines are found by a join of deletion neighbourhoods.  All variants of a line
with one character less are hashed, together with their place if they are to find
a replaced character; lines meet in equal variants, the earliest there is each
one's partner, and the edit distance to it is checked on the texts.

So that not every character of the corpus makes a row, variants are made where a
partner is possible at all.  Two lines one edit apart have equal first halves or
equal last halves; lines that share a half are cut into blocks of a few
characters, and only where all but one block (counted from both ends) is shared
are the variants of that block made.  A variant then is the hashes of what stands
before and behind the block and the block with one character less.  These steps
lose nothing: they are implied by the edit distance.

Everything runs in SQL functions.  Hot lines are counted before they move, members
of a variant are never paired with each other but with the earliest one only, and
what is broadcast are bitmaps of a fixed size that keep rows without a chance from
moving.

Defined cases: a NULL text stays NULL and has no lines, an empty one has one blank
line; NULL ids come first; rows alike in id and text are one document, so both lose
the same lines; an empty table gives an empty table; other columns are kept unless
called ``n_lines`` or ``n_removed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .blocks import LOWEST

LEAST_CHARS = 16
#: Bits of the filters; at most 128 rows of 4 KiB are broadcast.
FILTER_BITS = 1 << 22


def possible(frame: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key may be among the keys, by a bitmap of a fixed number of bits."""
    def slot(name: str) -> Column:
        return F.pmod(F.xxhash64(name, F.lit("bitmap")), F.lit(FILTER_BITS))

    bits = keys.select(slot(key).alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    place = F.bitmap_bit_position(slot(key))
    return (
        frame.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number(slot(key)))
        .join(F.broadcast(bits), "_bucket")
        .where("(int(conv(hex(substring(_bits, int(_place div 8) + 1, 1)), 16, 10)) >> int(_place % 8)) & 1 = 1")
        .drop("_place", "_bucket", "_bits")
    )


def keyed(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Adds ``_doc`` and ``_rank``, which tell documents apart; the rank is 0 unless ids repeat.

    The second frame has one row for each document.
    """
    ids = F.col(f"`{id_column}`").cast("long")
    repeats = docs.groupBy(ids.alias("id")).count().where("count > 1").limit(1).count()
    rank = F.xxhash64(F.col(f"`{text_column}`")) if repeats else F.lit(0).cast("long")
    rows = docs.withColumn("_doc", F.coalesce(ids, F.lit(LOWEST))).withColumn("_rank", rank)
    return rows, rows.dropDuplicates(["_doc", "_rank"]) if repeats else rows


def all_lines(docs: DataFrame, text_column: str) -> DataFrame:
    """``place`` and ``line`` of every line that is not blank, with two hashes that stand for it."""
    split = docs.select("_doc", "_rank", F.posexplode(F.split(F.col(f"`{text_column}`").cast("string"), "\n"))
                        .alias("number", "line")).where("trim(BOTH '\t\n\r\f\u000b ' FROM line) <> ''")
    return split.select(F.struct("_doc", "_rank", "number").alias("place"), "line",
                        F.xxhash64("line").alias("h"), F.xxhash64(F.lit("second"), F.col("line")).alias("g"))


def halves(lines: DataFrame) -> DataFrame:
    """The halves that a line shares with any line one edit apart: ``key, h, g``.

    Of two such lines the shorter one's length m counts; a line may be the shorter
    or the longer one.
    """
    n = F.length("line")
    sizes = F.array_distinct(F.array(F.floor(n / 2), F.floor((n - 1) / 2)).cast("array<int>"))
    sides = F.explode(F.flatten(F.transform(sizes, lambda size: F.array(
        F.xxhash64(F.lit("first"), F.left("line", size)), F.xxhash64(F.lit("last"), F.right("line", size))))))
    return lines.where(n >= LEAST_CHARS).select(sides.alias("key"), "h", "g")


def shared(rows: DataFrame) -> DataFrame:
    """Keys under which different lines stand."""
    return rows.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.min("g").alias("c"),
                                   F.max("g").alias("d")).where("a <> b OR c <> d").select("key")


def block_size(m: Column) -> Column:
    """Characters of a block for a (shorter) line's length; larger for very long lines, so that work stays near linear."""
    return F.when(m < 2_048, 16).when(m < 32_768, 64).otherwise(512)


def blocks(lines: DataFrame) -> DataFrame:
    """Where a line may differ from another: ``key, middle, role`` and the line.

    For the shorter length m, cut into b blocks, and block i the lines agree in the
    first i blocks and in the last b - i - 1; ``middle`` is what lies between.  The role
    is 0 for the shorter line (or one as long), 1 for the longer.
    """
    text = F.col("line")
    made = (
        lines.withColumn("n", F.length("line"))
        .withColumn("role", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("m", F.col("n") - F.col("role"))
        .withColumn("size", block_size(F.col("m"))).withColumn("b", F.floor(F.col("m") / F.col("size")).cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("b"))))
        .withColumn("head", F.col("i") * F.col("size"))
        .withColumn("tail", F.greatest(F.lit(0), (F.col("b") - F.col("i") - 1) * F.col("size")))
    )
    ahead, behind = F.left(text, F.col("head")), F.right(text, F.col("tail"))
    middle = F.substring(text, F.col("head") + 1, F.col("n") - F.col("tail") - F.col("head"))
    return made.select("h", "g", "place", "role", middle.alias("middle"),
                       F.xxhash64("m", "i", ahead, behind).alias("key"))


def variants(found: DataFrame) -> DataFrame:
    """One character less: ``variant, longer`` and the line.

    Lines of one length meet in what is left and where; a longer line meets the
    shorter one as it is.
    """
    size = F.length("middle")
    at = F.explode(F.when(size > 0, F.sequence(F.lit(1), size)))
    less = F.concat(F.expr("left(middle, c - 1)"), F.expr("substring(middle, c + 1)"))
    line = ["h", "g", "place", "key"]
    cut = found.select(*line, "role", "middle", at.alias("c")).withColumn("less", less)
    same = cut.where("role = 0").select(*line, F.xxhash64("key", F.lit("same"), "c", "less").alias("variant"),
                                        F.lit(False).alias("longer"), F.lit(True).alias("replaced"))
    longer = cut.where("role = 1").select(*line, F.xxhash64("key", F.lit("less"), "less").alias("variant"),
                                          F.lit(True).alias("longer"), F.lit(False).alias("replaced"))
    shorter = found.where("role = 0").select(*line, F.xxhash64("key", F.lit("less"), "middle").alias("variant"),
                                             F.lit(False).alias("longer"), F.lit(False).alias("replaced"))
    return same.unionByName(longer).unionByName(shorter)


def near_lines(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """``h, g`` of lines with an earlier line one edit apart."""
    cut = halves(lines)
    keys = stored(shared(cut), "line-halves")
    some = possible(cut, "key", keys).join(keys, "key").select("h", "g").distinct()
    some = stored(some.join(firsts, ["h", "g"]), "line-candidates")
    texts = possible(lines.withColumn("key", F.col("h")), "key", some.select(F.col("h").alias("key"))).drop("key")
    texts = stored(texts.join(some, ["h", "g", "place"]).dropDuplicates(["h", "g"]), "line-texts")
    cuts = stored(blocks(texts), "line-blocks")
    alike = stored(cuts.join(shared(cuts), "key", "left_semi"), "line-shared-blocks")
    made = variants(alike)
    earliest = made.groupBy("variant").agg(
        F.min(F.when(F.col("longer"), F.col("place"))).alias("longer_place"),
        F.min(F.when(~F.col("longer"), F.col("place"))).alias("other_place"))
    return _verified(made, earliest, texts)


def _verified(made: DataFrame, earliest: DataFrame, texts: DataFrame) -> DataFrame:
    partner = F.when(F.col("longer") | F.col("replaced"), F.col("other_place")).otherwise(F.col("longer_place"))
    pairs = (
        made.join(earliest, "variant").withColumn("partner", partner).where("partner < place")
        .groupBy("h", "g").agg(F.min("partner").alias("partner"))
    )
    other = texts.select(F.col("place").alias("partner"), F.col("line").alias("earlier"))
    checked = pairs.join(texts.select("h", "g", "line"), ["h", "g"]).join(other, "partner")
    return checked.where(F.levenshtein("line", "earlier", 1) >= 0).select("h", "g")


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with their repeated lines taken out, ``n_lines`` and ``n_removed`` added."""
    rows, once = keyed(docs.drop("n_lines", "n_removed"), id_column, text_column)
    lines = all_lines(once, text_column)
    seen = lines.groupBy("h", "g").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("times"))
    firsts = stored(seen, "line-firsts")
    near = near_lines(lines, firsts.select("h", "g", "place")).withColumn("near", F.lit(True))
    judged = firsts.join(near, ["h", "g"], "left").where("near OR times > 1").withColumnRenamed("place", "first")
    judged = stored(judged.select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near")), "line-repeats")
    places = lines.select("h", "g", "place").join(judged, ["h", "g"]).where("near OR place > first")
    gone = places.groupBy("place._doc", "place._rank").agg(F.collect_set("place.number").alias("_gone"))
    text = F.col(f"`{text_column}`").cast("string")
    split = F.split(text, "\n")
    kept = F.filter(split, lambda _, i: ~F.array_contains("_gone", i))
    done = rows.join(gone, ["_doc", "_rank"], "left")
    return (
        done.withColumn("n_lines", F.when(text.isNull(), 0).otherwise(F.size(split)).cast("long"))
        .withColumn("n_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("long"))
        .withColumn(text_column, F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(kept, "\n")))
        .select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")], "n_lines", "n_removed")
    )
