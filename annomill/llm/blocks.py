"""Moves texts, questions and answers between tasks as compressed blocks.

A job over windows of text asks of each window whether it stands elsewhere too.
There are far more windows than rows, so a task gathers its questions and sends
one block to each *bucket* (a hash of the window); the bucket's task answers them
with one block for each *group* of documents, where they meet the documents'
texts again.  The numbers of buckets and groups follow the size of the corpus, so
both stay of one size.

Equal windows of one task are settled there and asked about once, so a window
that stands in a third of all documents sends one question per task.

A document is known by its id and, where ids repeat, a hash of its text; rows
alike in both are one document.  A NULL id is the lowest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import bytes_of, mixed

GROUP_BYTES = 8 << 20
LEAST_GROUPS = 256
LOWEST = -(1 << 63)
FLUSH = 1_500_000
BLOCK = "part int, kind int, block binary"


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes; 64-bit signed ones as differences."""
    heads, bodies = [len(arrays)], []
    for array in arrays:
        if array.dtype == np.int64:
            array = np.diff(array, prepend=np.int64(0))
        kind = "uint8 int32 int64 uint64".split().index(array.dtype.name)
        heads += [kind, len(array)]
        bodies.append(array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes())
    raw = np.array(heads, dtype="<i8").tobytes() + b"".join(bodies)
    return np.array([len(raw)], dtype="<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def expand(block: bytes) -> list[np.ndarray]:
    size = int(np.frombuffer(block[:8], dtype="<i8")[0])
    raw = np.frombuffer(pa.decompress(block[8:], decompressed_size=size, codec="zstd"), dtype=np.uint8)
    count = int(raw[:8].view("<i8")[0])
    heads = raw[8:8 + 16 * count].view("<i8").reshape(count, 2)
    at, out = 8 + 16 * count, []
    for kind, length in heads.tolist():
        dtype = np.dtype((np.uint8, np.int32, np.int64, np.uint64)[kind])
        planes = raw[at:at + length * dtype.itemsize].reshape(dtype.itemsize, length)
        array = np.ascontiguousarray(planes.T).view(dtype).reshape(length)
        out.append(np.cumsum(array) if kind == 2 else array)
        at += length * dtype.itemsize
    return out


def joined(blocks: list[bytes], dtypes: list) -> list[np.ndarray]:
    """The arrays of several blocks behind each other."""
    parts = [expand(block) for block in blocks]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, d) for i, d in enumerate(dtypes)]


def batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
        pa.array([r[2] for r in rows], pa.binary())], names=["part", "kind", "block"])


def spread(parts: np.ndarray, kind: int, *arrays: np.ndarray) -> list[tuple[int, int, bytes]]:
    """One block for each part that has entries."""
    if not len(parts):
        return []
    order = np.argsort(parts.astype(np.uint16) if parts.max() < 65536 else parts, kind="stable")
    parts = parts[order]
    first = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
    edges = np.append(first, len(parts))
    arrays = [a[order] for a in arrays]
    return [(int(parts[b]), kind, squeeze(*[a[b:e] for a in arrays])) for b, e in zip(edges[:-1], edges[1:])]


def group_of(doc: np.ndarray, rank: np.ndarray, groups: int) -> np.ndarray:
    return (mixed(mixed(doc.view(np.uint64)) + rank.view(np.uint64)) % np.uint64(groups)).astype(np.int32)


def bucket_of(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Independent of the hash's own bits, which all serve to tell windows apart."""
    return (mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(groups)).astype(np.int32)


def identified(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """``doc, rank, text, anonymous`` of all rows, and of one row for each ``doc, rank``.

    ``rank`` is 0 unless ids repeat; ``anonymous`` marks a NULL id.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    repeats = rows.groupBy("id").count().where("count > 1").limit(1).count()
    rank: Column = F.xxhash64("text") if repeats else F.lit(0).cast("long")
    rows = rows.select(F.coalesce("id", F.lit(LOWEST)).alias("doc"), rank.alias("rank"), "text",
                       F.col("id").isNull().alias("anonymous"))
    return rows, rows.dropDuplicates(["doc", "rank"]) if repeats else rows


def groups_for(rows: DataFrame) -> int:
    """Number of groups and buckets: as many as keep one at about ``GROUP_BYTES`` of text."""
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(LEAST_GROUPS, -(-total // GROUP_BYTES))


def text_blocks(rows: DataFrame, groups: int) -> DataFrame:
    """The texts as blocks of their groups: ids, ranks, which ids are NULL, edges and bytes."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for one in batches:
            held.append(one)
            size += one.nbytes
            if size >= 64 << 20:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    def packed(held):
        table = pa.Table.from_batches(held)
        doc, rank = table.column("doc").to_numpy(), table.column("rank").to_numpy()
        anonymous = table.column("anonymous").to_numpy().astype(np.uint8)
        part = group_of(doc, rank, groups)
        order = np.argsort(part, kind="stable")
        table = table.select(["text"]).take(pa.array(order)).combine_chunks()
        doc, rank, anonymous, part = doc[order], rank[order], anonymous[order], part[order]
        edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
        texts = table.column("text")
        texts = texts.chunk(0) if texts.num_chunks == 1 else pa.concat_arrays(texts.chunks)
        out = []
        for b, e in zip(edges[:-1], edges[1:]):
            data, ends = bytes_of(texts.slice(b, e - b))
            out.append((int(part[b]), 0, squeeze(doc[b:e], rank[b:e], anonymous[b:e], ends, data)))
        return batch(out)

    return rows.mapInArrow(blocks, BLOCK)


class Group:
    """The documents of one group with the answers about them, ``(start, length)`` runs by document."""

    def __init__(self, texts: pa.Table, answers: pa.Table):
        parts = [expand(b) for b in texts.column("block").to_pylist()]
        self.doc = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        self.rank = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        self.anonymous = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.uint8)
        sizes = np.concatenate([np.diff(p[3]) for p in parts]) if parts else np.zeros(0, np.int64)
        self.data = np.concatenate([p[4] for p in parts]) if parts else np.zeros(0, np.uint8)
        self.edges = np.append(0, np.cumsum(sizes)).astype(np.int64)
        doc, rank, start, length = joined(answers.column("block").to_pylist(), [np.int64, np.int64, np.int64, np.int32])
        order = np.lexsort((start, rank, doc))
        self.answers = doc[order], rank[order], start[order], length[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, (np.diff(self.answers[0]) != 0) | (np.diff(self.answers[1]) != 0))) \
            if len(doc) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(doc))
        self.found = {(int(self.answers[0][b]), int(self.answers[1][b])): (b, e) for b, e in zip(first, ends)}

    def pieces(self, size: int) -> Iterator[tuple[int, int]]:
        """Runs of documents of about ``size`` bytes; a longer document is one by itself."""
        begin = 0
        while begin < len(self.doc):
            end = max(begin + 1, int(np.searchsorted(self.edges, self.edges[begin] + size, side="right")) - 1)
            yield begin, end
            begin = end

    def runs(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        b, e = self.found.get((int(self.doc[i]), int(self.rank[i])), (0, 0))
        return self.answers[2][b:e], self.answers[3][b:e]

    def marked(self, begin: int, end: int, first: np.ndarray, size: int, reach: int = 1, sign: int = 1) -> np.ndarray:
        """Marks what the runs cover; ``first[i]`` is where document ``begin + i`` begins, a run covers ``reach - 1`` more.

        Only runs whose length has the sign are looked at.
        """
        steps = np.zeros(size + 1, dtype=np.int64)
        for i in range(begin, end):
            start, length = self.runs(i)
            start, length = start[sign * length > 0], sign * length[sign * length > 0]
            if len(start):
                np.add.at(steps, np.minimum(first[i - begin] + start, size), 1)
                np.add.at(steps, np.minimum(first[i - begin] + start + length + reach - 1, size), -1)
        return np.cumsum(steps[:-1]) > 0


def first_of(hashes: np.ndarray, order_by: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries sorted by hash and place: the order, where each hash begins, and how many it has."""
    order = np.lexsort((*order_by[::-1], hashes)) if order_by else np.argsort(hashes, kind="stable")
    sorted_hashes = hashes[order]
    first = np.flatnonzero(np.append(True, sorted_hashes[1:] != sorted_hashes[:-1])) if len(order) else np.zeros(0, np.int64)
    return order, first, np.diff(np.append(first, len(order)))


def ask(hashes, doc, rank, start, length, groups: int, later: bool) -> list[tuple[int, int, bytes]]:
    """Questions (kind 0) about distinct windows, and what equal windows here settle (kind 1).

    ``later``: the answer names every window but the first; else every window that
    stands in two places.
    """
    order, first, count = first_of(hashes, (doc, rank, start) if later else ())
    alone = np.zeros(len(hashes), dtype=bool)
    alone[order[first]] = True
    weight = np.ones(len(hashes), dtype=np.uint8)
    weight[order[first]] = np.minimum(count, 2)
    if later:
        known = ~alone
    else:
        known = np.ones(len(hashes), dtype=bool)
        known[order[first[count == 1]]] = False
    out = spread(bucket_of(hashes[alone], groups), 0, hashes[alone], doc[alone], rank[alone], start[alone],
                 length[alone], weight[alone])
    out += spread(group_of(doc[known], rank[known], groups), 1, doc[known], rank[known], start[known], length[known])
    return out


def answered(groups: int, later: bool):
    """A bucket's answers as blocks for the groups of the documents that asked."""
    def answer(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        blocks = table.column("block").to_pylist()
        settled = [(p, 1, b) for p, k, b in zip(table.column("part").to_pylist(), kinds, blocks) if k == 1]
        hashes, doc, rank, start, length, weight = joined(
            [b for k, b in zip(kinds, blocks) if k == 0],
            [np.uint64, np.int64, np.int64, np.int64, np.int32, np.uint8])
        order, first, count = first_of(hashes, (doc, rank, start) if later else ())
        if later:
            named = np.ones(len(hashes), dtype=bool)
            named[order[first]] = False
        else:
            total = np.add.reduceat(weight[order].astype(np.int64), first) if len(first) else count
            named = np.zeros(len(hashes), dtype=bool)
            named[order] = np.repeat(total > 1, count)
            named &= weight == 1
        out = spread(group_of(doc[named], rank[named], groups), 1, doc[named], rank[named], start[named], length[named])
        return pa.Table.from_batches([batch(settled + out)])

    return answer


class Questions:
    """Gathers questions of a task and sends them when there are enough."""

    def __init__(self, groups: int, later: bool):
        self.groups, self.later, self.held, self.size = groups, later, [], 0

    def add(self, *arrays: np.ndarray) -> list[tuple[int, int, bytes]]:
        self.held.append(arrays)
        self.size += len(arrays[0])
        return self.flush() if self.size >= FLUSH else []

    def flush(self) -> list[tuple[int, int, bytes]]:
        if not self.held:
            return []
        arrays = [np.concatenate([held[i] for held in self.held]) for i in range(5)]
        self.held, self.size = [], 0
        return ask(*arrays, self.groups, self.later)
