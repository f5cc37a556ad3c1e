"""CSV files with line breaks in quotes, read by many tasks per file.

Spark splits a file at line breaks; whether a line break ends a record depends on the
quotes ahead of it in the whole file.  So the quotes of every split are counted first, and
added up over the splits of a file: an odd number ahead of a split says that it begins
inside quotes.  Then every split puts its own lines together to records.  What a
split begins with while inside quotes, and a record that it leaves open, are *fragments*, at
most two a split; only these move, to be joined with those of the splits before and
behind.  No whole file and no other text is shuffled.

Quotes stand around whole fields and are doubled inside (RFC 4180).  A quote elsewhere
would be taken for one that opens or closes; a record with such a quote fails the job.
Lines end with ``\\n`` or ``\\r\\n``; as with Spark's reader, those in the quotes of a file
whose first line ends with ``\\r\\n`` become ``\\n``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored

#: A table of splits is held in every task up to this many rows of at most a few hundred bytes.
IN_MEMORY_SPLITS = 1 << 17

# Functions travel to workers by value, so that those need not find this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FIELD = r'(?:"(?:[^"]|"")*"|[^",]*)'
WELL_FORMED = rf"^{_FIELD}(?:,{_FIELD})*$"
_PIECES = "file_path string, file_block long, number long, kind int, record string"
RECORD, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block"), "value")


def split_states(lines: DataFrame) -> DataFrame:
    """``file_path, file_block, inside, crlf``: whether a split begins inside quotes, and whether its file's first line ends with CRLF."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    counted = placed.groupBy("file_path", "file_block").agg(
        F.sum(quotes).alias("quotes"), F.min_by(F.col("value").endswith("\r"), "place").alias("crlf"))
    in_file = Window.partitionBy("file_path").orderBy("file_block")
    ahead = in_file.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2 == 1
    crlf = F.first("crlf").over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    return stored(counted.select("file_path", "file_block", inside.alias("inside"), crlf.alias("crlf")), "csv-splits")


def _in_order(lines: DataFrame, states: DataFrame, in_memory: int) -> DataFrame:
    """Lines with their split's state, each split's lines together and in order."""
    cut_anew = F.raise_error(F.lit("the files were split differently a moment ago; read them again"))
    inside = F.coalesce("inside", cut_anew).alias("inside")
    columns = ["file_path", "file_block", inside, "crlf", "value"]
    if states.count() <= in_memory:
        return lines.join(F.broadcast(states), ["file_path", "file_block"], "left").select(columns)
    numbered = lines.withColumn("_place", F.monotonically_increasing_id())
    return (
        numbered.join(states, ["file_path", "file_block"], "left").select(*columns, "_place")
        .repartition("file_path", "file_block").sortWithinPartitions("file_path", "file_block", "_place").drop("_place")
    )


class _Split:
    """The lines of one split as they come."""

    def __init__(self, path: str, block: int, inside: bool, crlf: bool):
        self.path, self.block, self.inside, self.crlf = path, block, inside, crlf
        self.number, self.open, self.at_head = 0, [], inside

    def take(self, values: pa.Array) -> list[tuple[int, int, pa.Array]]:
        """``number, kind, records`` of what is complete."""
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        after = (np.cumsum(quotes) + self.inside) % 2 == 1
        starts = np.flatnonzero(~np.append(self.inside, after[:-1]))
        out = []
        first = starts[0] if len(starts) else len(values)
        if first:
            self.open += values.slice(0, first).to_pylist()
        if self.open and (len(starts) or not after[-1]):
            out += self.closed()
        if len(starts):
            whole = len(starts) - int(after[-1])
            edges = np.append(starts, len(values))
            if whole:
                # One list per record; most have a single line.
                part = values.slice(edges[0], edges[whole] - edges[0])
                lists = pa.ListArray.from_arrays(pa.array(edges[:whole + 1] - edges[0], pa.int32()), part)
                records = pc.replace_substring_regex(pc.binary_join(lists, "\n"), r"\r$", "")
                if self.crlf:
                    records = pc.replace_substring(records, "\r\n", "\n")
                records = records.filter(pc.not_equal(records, ""))
                out.append((self.number, RECORD, records))
                self.number += len(records)
            if after[-1]:
                self.open = values.slice(edges[whole]).to_pylist()
        self.inside = bool(after[-1])
        return out

    def closed(self) -> list[tuple[int, int, pa.Array]]:
        text = self.text().removesuffix("\r")
        self.open = []
        if self.at_head:
            self.at_head = False
            return [(-1, HEAD, pa.array([text]))]
        self.number += 1
        return [(self.number - 1, RECORD, pa.array([text]))]

    def end(self) -> list[tuple[int, int, pa.Array]]:
        if not self.open:
            return []
        kind = MIDDLE if self.at_head else TAIL
        # The next fragment follows behind a line break.
        text = self.text().removesuffix("\r") if self.crlf else self.text()
        return [(-1 if self.at_head else self.number, kind, pa.array([text]))]

    def text(self) -> str:
        text = "\n".join(self.open)
        return text.replace("\r\n", "\n") if self.crlf else text


def _rows(split: _Split, found: list[tuple[int, int, pa.Array]], fragments: bool) -> Iterator[pa.RecordBatch]:
    for number, kind, records in found:
        if (kind != RECORD) != fragments or not len(records):
            continue
        if kind == RECORD:
            _check(records, split.path)
        n = len(records)
        yield pa.RecordBatch.from_arrays([
            pa.array([split.path] * n), pa.array([split.block] * n, pa.int64()),
            pa.array(np.arange(number, number + n), pa.int64()), pa.array([kind] * n, pa.int32()), records.cast(pa.string())],
            names=["file_path", "file_block", "number", "kind", "record"])


def _check(records: pa.Array, path: str) -> None:
    good = pc.match_substring_regex(records, WELL_FORMED)
    if not pc.all(good).as_py():
        bad = records.filter(pc.invert(good))[0].as_py()
        raise ValueError(f"a quote within a field that has none around it, in {path}: {bad[:200]}")


def pieces(lines: DataFrame, fragments: bool) -> DataFrame:
    """Records that lie within a split, or the fragments at splits' ends: ``file_path, file_block, number, kind, record``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            paths, blocks, inside, crlf, values = batch.columns
            new = np.ones(batch.num_rows, dtype=bool)
            block = blocks.to_numpy()
            if batch.num_rows > 1:
                moved = pc.not_equal(paths.slice(1), paths.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
                new[1:] = moved | (block[1:] != block[:-1])
            edges = np.append(np.flatnonzero(new), batch.num_rows)
            for begin, end in zip(edges[:-1], edges[1:]):
                place = paths[begin].as_py(), int(block[begin])
                if split is None or place != (split.path, split.block):
                    if split is not None:
                        yield from _rows(split, split.end(), fragments)
                    split = _Split(*place, inside[begin].as_py(), crlf[begin].as_py())
                yield from _rows(split, split.take(values.slice(begin, end - begin)), fragments)
        if split is not None:
            yield from _rows(split, split.end(), fragments)

    return lines.mapInArrow(cut, _PIECES)


def joined_fragments(found: DataFrame) -> DataFrame:
    """Records that lie in several splits; a file that ends inside quotes ends its last record."""
    whole = Window.partitionBy("file_path").orderBy("file_block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    chained = found.withColumn("chain", F.sum((F.col("kind") == TAIL).cast("long")).over(whole))
    grouped = chained.groupBy("file_path", "chain").agg(
        F.array_sort(F.collect_list(F.struct("file_block", "kind", "number", "record"))).alias("f"))
    text = F.array_join(F.transform("f", lambda f: f.record), "\n")
    return grouped.select("file_path", F.col("f")[0].file_block.alias("file_block"), F.col("f")[0].number.alias("number"),
                          F.lit(RECORD).alias("kind"), text.alias("record"))


def _checked(found: DataFrame) -> DataFrame:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _check(batch.column(4), batch.column(0)[0].as_py())
            yield batch

    return found.mapInArrow(check, _PIECES)


def csv_records(spark: SparkSession, path: str | list[str], in_memory: int = IN_MEMORY_SPLITS) -> DataFrame:
    """``file_path, file_block, file_pos, record``: every record's text.

    ``file_pos`` numbers the records that begin in a split from 0, without gaps; the first
    one of a file is its header.
    """
    lines = _lines(spark, path)
    ordered = _in_order(lines, split_states(lines), in_memory)
    crossing = _checked(joined_fragments(pieces(ordered, True)))
    return pieces(ordered, False).unionByName(crossing).select(
        "file_path", "file_block", F.col("number").alias("file_pos"), "record")


def read_csv_records(spark: SparkSession, path: str | list[str], names: list[str], in_memory: int = IN_MEMORY_SPLITS) -> DataFrame:
    """The fields of every record as strings under ``names``, the header's, with the record's position.

    A file whose header has other names fails the job.
    """
    fields = [f"c{i}" for i in range(len(names))]
    parsed = F.from_csv("record", ", ".join(f"{field} string" for field in fields), {"escape": '"', "multiLine": "true"})
    rows = csv_records(spark, path, in_memory).withColumn("_fields", parsed)
    given = F.array(*[F.col("_fields")[field] for field in fields])
    first = given[0].eqNullSafe(names[0]) | given[0].eqNullSafe("﻿" + names[0])
    rest = F.slice(given, 2, len(names)).eqNullSafe(F.lit(names[1:]) if len(names) > 1 else F.array().cast("array<string>"))
    other = F.raise_error(F.concat(F.lit("the header has other names in "), F.col("file_path")))
    header = (F.col("file_block") == 0) & (F.col("file_pos") == 0)
    rows = rows.where(F.when(header, F.when(first & rest, F.lit(False)).otherwise(other)).otherwise(True))
    return rows.select("file_path", "file_block", "file_pos",
                       *[F.col("_fields")[field].alias(name) for field, name in zip(fields, names)])
