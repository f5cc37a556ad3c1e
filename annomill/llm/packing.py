"""Cost-balanced packing of token streams into sequences of one length.

The cost of a piece of n tokens is estimated as ``n + n * n / capacity``: a
linear share and the quadratic share of attention within the piece.  Pieces go
in descending length to the cheapest sequence that still has room for them; a
piece that fits nowhere fills the cheapest sequence with room and its rest is
placed again, so only the last sequence of a block is padded.

Blocks are cut from the partitions as they are: nothing is shuffled, and a task
holds ``BLOCK_TOKENS`` tokens at a time, or one document if that is longer.

Defined cases: a NULL or empty text is the closing id alone; documents that
share an id are packed one by one; an empty table gives no pieces; columns other
than the two named ones are ignored.
"""

from __future__ import annotations

import heapq
import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .words import give_back, slices

BLOCK_TOKENS = 1_000_000
#: Some 180 bytes each, which the worker keeps beside later tasks.
CACHED_UNITS = 150_000
#: A single one of these after a letter is a piece of its own at a unit's end.
MARKS = ".,;:!?"

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_cost double")


class UnitIds(dict):
    """Ids of text between single blanks, as little-endian 32-bit bytes.

    A byte-level vocabulary never joins a blank to what stands before it, so the
    ids of a text are those of its units in a row.  The exception are runs of
    white space that hold a blank; such units have no entry of their own.
    The ranks of the vocabulary give the same ids as its full description, in a
    quarter of the time.
    """

    def __init__(self, ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...]):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.model = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.piece = self.model._core_bpe.encode_single_piece
        self.marks = {mark: self.plain(mark) for mark in MARKS}
        self.special = {text: np.array([id_], dtype="<u4").tobytes() for text, id_ in special}
        # The longest of those that begin at one place.
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None

    def plain(self, text: str) -> bytes:
        return np.array(self.model.encode_ordinary(text), dtype="<u4").tobytes()

    def __missing__(self, unit: str) -> bytes | None:
        if unit.isalpha():
            ids = array("I", self.piece(b" " + unit.encode())).tobytes()
        elif unit[-1:] in MARKS and unit[:-1].isalpha():
            ids = self[unit[:-1]] + self.marks[unit[-1]]
        elif not unit or unit[0].isspace():
            return None
        else:
            ids = array("I", self.model.encode_ordinary(" " + unit)).tobytes()
        self[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text; special tokens in it have their own, and what stands between them is encoded by itself."""
        if self.cuts is None or self.cuts.search(text) is None:
            return self.between(text)
        return b"".join(self.special[piece] if n % 2 else self.between(piece)
                        for n, piece in enumerate(self.cuts.split(text)) if piece)

    def between(self, text: str) -> bytes:
        if len(self) > CACHED_UNITS:
            self.clear()
        first, *units = text.split(" ")
        try:
            return self.plain(first) + b"".join(map(self.__getitem__, units))
        except TypeError:
            return self.plain(text)


#: Name under which a worker keeps what its tasks share; functions travel by value and have no module there.
SHARED = "annomill_llm_unit_ids"


def units_of(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> UnitIds:
    """The worker's units; later tasks of the same worker find the earlier ones' ids."""
    held = sys.modules.setdefault(SHARED, types.ModuleType(SHARED)).__dict__
    key = repr((ranks_path, pattern, special))
    if key not in held:
        held[key] = UnitIds(ranks_path, pattern, special)
    return held[key]


def piece_cost(length: int, capacity: int) -> float:
    return length + length * length / capacity


def assign(lengths: list[int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], list[float]]:
    """Pieces ``(document, start, length, sequence, offset)`` and each sequence's cost.

    Lengths only go down, so a sequence that has room once has it until it is chosen:
    ``heap`` holds those by cost, the others are parked until the length has come
    down to their room.
    """
    pieces, costs, room, rest = [], [], [], []
    for doc, length in enumerate(lengths):
        whole = length // capacity * capacity
        for start in range(0, whole, capacity):
            pieces.append((doc, start, capacity, len(costs), 0))
            costs.append(piece_cost(capacity, capacity))
            room.append(0)
        if length > whole:
            rest.append((whole - length, doc, whole))
    open_sequences = -(-sum(-x[0] for x in rest) // capacity)
    heap = [(0.0, len(costs) + i) for i in range(open_sequences)]
    costs += [0.0] * open_sequences
    room += [capacity] * open_sequences
    parked, by_room, waits = [], [], [False] * len(costs)
    heapq.heapify(rest)
    while rest:
        negative, doc, start = heapq.heappop(rest)
        length = -negative
        while by_room and -by_room[0][0] >= length:
            free, sequence = heapq.heappop(by_room)
            if waits[sequence] and room[sequence] == -free:
                waits[sequence] = False
                heapq.heappush(heap, (costs[sequence], sequence))
        if heap:
            _, chosen = heapq.heappop(heap)
        else:
            cost, chosen = heapq.heappop(parked)
            while not waits[chosen] or cost != costs[chosen]:
                cost, chosen = heapq.heappop(parked)
            heapq.heappush(rest, (room[chosen] - length, doc, start + room[chosen]))
            length = room[chosen]
        pieces.append((doc, start, length, chosen, capacity - room[chosen]))
        room[chosen] -= length
        costs[chosen] += piece_cost(length, capacity)
        waits[chosen] = room[chosen] > 0
        if waits[chosen]:
            heapq.heappush(parked, (costs[chosen], chosen))
            heapq.heappush(by_room, (-room[chosen], chosen))
    return pieces, costs


def pack(docs: DataFrame, ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = (), capacity: int = 1024, closing_id: int = 0,
         id_column: str = "doc_id", text_column: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of all documents with their ids and the sequence each lies in.

    ``ranks_path`` is a byte-level vocabulary's file of ranks on every worker and
    ``pattern`` how it cuts text into pieces; ``special`` are tokens, with their ids, that a
    text is cut at first.
    ``sequence_id`` counts up within a partition of the input, whose number is
    its high half.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
        units, closing = units_of(ranks_path, pattern, special), np.array([closing_id], dtype="<u4").tobytes()
        keys, tokens, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                keys += part.column("doc_id").to_pylist()
                new = [units.encode(text or "") + closing for text in part.column("text").to_pylist()]
                tokens += new
                held += sum(map(len, new)) // 4
                if held >= block_tokens:
                    yield keys, tokens
                    keys, tokens, held = [], [], 0
        if keys:
            yield keys, tokens

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for keys, tokens in blocks(batches):
            pieces, costs = assign([len(ids) // 4 for ids in tokens], capacity)
            for i in range(0, len(pieces), 4000):
                doc, start, length, sequence, offset = map(list, zip(*pieces[i:i + 4000]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[d] for d in doc], pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array([tokens[d][4 * s:4 * (s + n)] for d, s, n in zip(doc, start, length)], pa.binary()),
                    pa.array([len(tokens[d]) // 4 for d in doc], pa.int64()),
                    pa.array([base + s for s in sequence], pa.int64()), pa.array(offset, pa.int64()),
                    pa.array([costs[s] for s in sequence], pa.float64()),
                ], names=[field.split()[0] for field in PIECES.split(", ")])
            base += len(costs)
        give_back()

    chosen = docs.selectExpr(f"CAST(`{id_column}` AS BIGINT) AS doc_id", f"CAST(`{text_column}` AS STRING) AS text")
    return chosen.mapInArrow(packed, PIECES)
