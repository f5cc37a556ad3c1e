"""Removes repeated runs of words by level-wise doubling.

Level by level the windows of 5, 10, 20, ... words that stand in more than one
place are found.  A window is looked at on the next level, at twice the length,
only if it holds a repeated one; the last level has the length asked for.  The
search ends early when a level leaves no candidates.

Below the last level one window stands for its neighbours: of all windows of the
level within a window of full length the one with the lowest hash (the leftmost
of equals) is asked about.  Equal windows of full length choose it at the same
place, so none is lost, and far fewer questions are asked.

On the last level each word is removed that lies in a window whose words also
start earlier: in a row of a smaller id, or earlier in the same document.
Windows are judged on the input.  Windows are compared by 64-bit hashes within
buckets chosen by another hash.

Each level reads the texts once and moves questions and answers in compressed
blocks (``blocks``); no task holds more than a bucket or a group of documents,
whose sizes do not grow with the corpus.

Defined cases: a NULL or empty text has no words; NULL ids come first; rows alike
in id and text are one document, and each gets its result; documents shorter
than a window keep all words; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import stored
from .blocks import (BLOCK, Group, Questions, answered, batch, groups_for, identified, text_blocks)
from .words import SLICE_BYTES, Powers, Texts, slices, smallest, texts, windows

BASE_WORDS = 5


def levels(width: int, base: int = BASE_WORDS) -> list[int]:
    """Doubling lengths that end with ``width``."""
    out = [width]
    while out[0] % 2 == 0 and out[0] // 2 >= base:
        out.insert(0, out[0] // 2)
    return out


def runs_of(starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and length of runs of following starts that chose the same window."""
    if not len(starts):
        return starts, starts
    new = np.append(True, (chosen[1:] != chosen[:-1]) | (np.diff(starts) != 1))
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(starts)))


def questions(found: Texts, hashes: np.ndarray, doc: np.ndarray, rank: np.ndarray, powers: Powers, level: int,
              width: int, candidate: np.ndarray | None):
    """Arrays ``hash, doc, rank, start, length`` of what is asked on a level about a few documents."""
    count = len(hashes) - width + 1
    if count <= 0:
        return None
    at = np.arange(count)
    inside = at + width <= found.first[found.doc[:count] + 1]
    if candidate is not None:
        inside &= candidate[:count]
    starts = np.flatnonzero(inside)
    own = windows(hashes, powers, level)
    if level == width:
        first, length, asked = starts, np.ones(len(starts), dtype=np.int64), own[starts]
    else:
        chosen = smallest(own, width - level + 1)[starts]
        begin, length = runs_of(starts, chosen)
        first, asked = starts[begin], own[chosen[begin]]
    owner = found.doc[first]
    return asked, doc[owner], rank[owner], first - found.first[owner], length.astype(np.int32)


def _first_level(level: int, width: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, gathered = Powers(), Questions(groups, level == width)
        for one in batches:
            for part in slices(one, "text"):
                found = texts(part, "text")
                asked = questions(found, found.hashes(powers), part.column("doc").to_numpy(),
                                  part.column("rank").to_numpy(), powers, level, width, None)
                if asked and (rows := gathered.add(*asked)):
                    yield batch(rows)
        yield batch(gathered.flush())

    return run


def _next_level(level: int, width: int, groups: int):
    def run(held: pa.Table, answers: pa.Table) -> pa.Table:
        group, powers, gathered, rows = Group(held, answers), Powers(), Questions(groups, level == width), []
        for begin, end in group.pieces(SLICE_BYTES):
            if not any((int(group.doc[i]), int(group.rank[i])) in group.found for i in range(begin, end)):
                continue
            found = _piece(group, begin, end)
            candidate = group.marked(begin, end, found.first, len(found.doc))
            asked = questions(found, found.hashes(powers), group.doc[begin:end], group.rank[begin:end], powers,
                              level, width, candidate)
            if asked:
                rows += gathered.add(*asked)
        return pa.Table.from_batches([batch(rows + gathered.flush())])

    return run


def _piece(group: Group, begin: int, end: int) -> Texts:
    low, high = group.edges[begin], group.edges[end]
    return Texts(group.data[low:high], group.edges[begin:end + 1] - low)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
RESULT = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long>>"


def _removed(width: int):
    def run(held: pa.Table, answers: pa.Table) -> pa.Table:
        group, out = Group(held, answers), []
        for begin, end in group.pieces(SLICE_BYTES):
            found = _piece(group, begin, end)
            gone = group.marked(begin, end, found.first, len(found.doc), width)
            kept = [_kept(found, gone, i) for i in range(end - begin)]
            spans = [_spans(gone[found.first[i]:found.first[i + 1]]) for i in range(end - begin)]
            out.append(pa.RecordBatch.from_arrays([
                pa.array(group.doc[begin:end], mask=group.anonymous[begin:end].astype(bool)),
                pa.array(found.counts.astype(np.int64)),
                pa.array([int(gone[found.first[i]:found.first[i + 1]].sum()) for i in range(end - begin)], pa.int64()),
                pa.array(kept, pa.string()),
                pa.array(spans, SCHEMA.field("spans").type)], schema=SCHEMA))
        return pa.Table.from_batches(out, SCHEMA)

    return run


def _kept(found: Texts, gone: np.ndarray, i: int) -> str:
    words = found.text(i).split()
    marks = gone[found.first[i]:found.first[i + 1]]
    if marks.any():
        words = [word for word, mark in zip(words, marks.tolist()) if not mark]
    return b" ".join(words).decode()


def _spans(gone: np.ndarray) -> list[tuple[int, int]]:
    steps = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return [{"start": int(b), "end": int(e)} for b, e in zip(steps[::2], steps[1::2])]


def remove_repeats(docs: DataFrame, width: int = 20, base: int = BASE_WORDS,
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans`` of each row; spans count words, their ends exclusive."""
    rows, once = identified(docs, id_column, text_column)
    groups = groups_for(rows)
    moved = text_blocks(once, groups)
    answers = None
    for level in levels(width, base):
        if answers is None:
            asked = once.select("doc", "rank", "text").mapInArrow(_first_level(level, width, groups), BLOCK)
        else:
            asked = moved.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
                _next_level(level, width, groups), BLOCK)
        answers = asked.groupBy("part").applyInArrow(answered(groups, level == width), BLOCK)
        if level < width:
            answers = stored(answers, f"windows-{level}")
            if answers.isEmpty():
                break
    return text_blocks(rows, groups).groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_removed(width), RESULT)
