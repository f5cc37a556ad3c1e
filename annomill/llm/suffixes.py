"""Removes long repeated strings with suffix arrays built by grouping.

**Suffix array.** ``suffix_order`` sorts the suffixes of a text in linear time.
Groups of suffixes are taken in descending order; every member's previous smaller
suffix (the nearest one before it in a lower group) is moved behind its old group,
by the number of members that point to it.  In the end a group is what shares a
Lyndon prefix; one ascending pass then emits the members of each group in order.

**Distribution.** A string of ``width`` bytes contains many of ``CORE`` bytes; the
one with the lowest hash (the leftmost of equals) stands for it, so equal strings
are found where equal cores are.

1. Each task asks which of its cores stand in another place too.
2. Around each such core the bytes that strings with this core can cover make a
   *segment*: what is left of the core, the core, what is right of it.  Segments
   meet by their core.  Equal ones are one segment of a higher multiplicity.
3. Where segments differ their suffix array is built, the core counting as one
   letter.  A string is repeated if its segment stands in several places or if a
   neighbour in suffix order begins with the same ``width`` bytes.
4. The bytes that repeated strings cover are taken out of the documents.

Cores that stand in more than ``HOT_CORE`` places do not meet in one task: their
strings are asked about one by one, by a hash of all their bytes.

Texts, questions and answers move in compressed blocks (``blocks``).  Cores and
strings are compared by 64-bit hashes within buckets chosen by another hash, what
stands around a core byte by byte.

Defined cases: a NULL or empty text has no bytes; rows alike in id and text are
one document and each gets its result, so they are no repeat of each other; a
document shorter than ``width`` keeps all; strings may overlap; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import stored
from .blocks import (BLOCK, Group, Questions, answered, batch, bucket_of, expand, first_of, group_of, groups_for,
                     identified, joined, spread, squeeze, text_blocks)
from .words import Powers, byte_values, bytes_of, mixed, running, slices, smallest, spans

CORE = 256
#: A core counts as hot from so many places in one task, or in all.
HOT_IN_TASK = 128
HOT_CORE = 20_000
SLICE = 1 << 20
FLUSH = 1_500_000
#: Letters beside the 256 bytes.
CORE_LETTER, END_LETTER = "\u0100", "\u0101"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
RESULT = "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>"


def suffix_order(text: str) -> list[int]:
    """Begin of every suffix in ascending order; a suffix is smaller than those it begins."""
    n = len(text)
    if not n:
        return []
    letters = sorted(set(text))
    number = {letter: i for i, letter in enumerate(letters)}
    group = [number[letter] for letter in text]
    members: list[list[int]] = [[] for _ in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    count = len(letters)
    before = list(range(-1, count - 1))
    after = list(range(1, count)) + [-1]
    done = [False] * count
    smaller = [-1] * n
    current = count - 1
    while current >= 0:
        done[current] = True
        own = sorted(i for i in members[current] if group[i] == current)
        members[current] = own
        pointed: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and done[group[j]]:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in pointed.items():
                moved.setdefault((times, group[j]), []).append(j)
            for (_, old), these in sorted(moved.items(), reverse=True):
                new = len(members)
                members.append(these)
                done.append(False)
                follower = after[old]
                before.append(old)
                after.append(follower)
                after[old] = new
                if follower >= 0:
                    before[follower] = new
                for j in these:
                    group[j] = new
        current = before[current]
    slot, place, current = [0] * len(members), 0, 0
    while current >= 0:
        slot[current] = place
        place += len(members[current]) if members[current] else 0
        current = after[current]
    return _emitted(n, group, members, slot, smaller)


def _emitted(n: int, group: list[int], members: list[list[int]], slot: list[int], smaller: list[int]) -> list[int]:
    """Suffix order from groups: each emitted suffix releases those whose next smaller one it is."""
    order, out = [-1] * n, [False] * n
    for r in range(-1, n):
        i = (order[r] if r >= 0 else n) - 1
        while i >= 0 and not out[i]:
            g = group[i]
            order[slot[g]] = i
            slot[g] += 1
            out[i] = True
            i = smaller[i]
    return order


class Strings:
    """The strings of ``width`` bytes within a few documents, by the core that stands for each."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, width: int, core: int, powers: Powers):
        self.data, self.edges, self.width, self.core, self.powers = data, edges, width, core, powers
        self.sums = running(byte_values(2)[data], powers)
        count = max(0, len(data) - width + 1)
        owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[:count]
        self.inside = np.arange(count) + width <= edges[owner + 1] if count else np.zeros(0, dtype=bool)
        self.owner = owner
        if count:
            at = np.arange(len(data) - core + 1)
            rough = (self.sums[at + core] - self.sums[at]) * powers.upto(len(self.sums))[1][at]
            self.chosen = smallest(rough, width - core + 1)
        else:
            self.chosen = np.zeros(0, dtype=np.int64)

    def runs(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owner, first start, number of starts and core of each run of wanted strings with one core."""
        starts = np.flatnonzero(self.inside & wanted)
        chosen = self.chosen[starts]
        if not len(starts):
            return starts, starts, starts, starts
        new = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (np.diff(starts) != 1)))
        return self.owner[starts[new]], starts[new], np.diff(np.append(new, len(starts))), chosen[new]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return spans(self.sums, starts, ends, self.powers)


def ask_cores(hashes, doc, rank, start, length, groups: int) -> list[tuple[int, int, bytes]]:
    """Questions about cores.  Of a core that is hot here one is sent, and its places are answered at once."""
    order, first, count = first_of(hashes, ())
    each = np.empty(len(hashes), dtype=np.int64)
    each[order] = np.repeat(count, count)
    hot = each >= HOT_IN_TASK
    sent = ~hot
    sent[order[first]] = True
    weight = np.where(hot, HOT_CORE, 1).astype(np.int32)
    out = spread(bucket_of(hashes[sent], groups), 0, hashes[sent], doc[sent], rank[sent], start[sent], length[sent],
                 weight[sent])
    return out + spread(group_of(doc[hot], rank[hot], groups), 1, doc[hot], rank[hot], start[hot], -length[hot])


def _cores(width: int, core: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(), [], 0
        for one in batches:
            for part in slices(one, "text", SLICE):
                data, edges = bytes_of(part.column("text"))
                strings = Strings(data, edges, width, core, powers)
                owner, first, length, chosen = strings.runs(np.ones(len(strings.inside), dtype=bool))
                if len(first):
                    held.append((strings.hashes(chosen, chosen + core), part.column("doc").to_numpy()[owner],
                                 part.column("rank").to_numpy()[owner], first - edges[owner], length.astype(np.int32)))
                    size += len(first)
                if size >= FLUSH:
                    yield batch(ask_cores(*map(np.concatenate, zip(*held)), groups))
                    held, size = [], 0
        if held:
            yield batch(ask_cores(*map(np.concatenate, zip(*held)), groups))

    return run


def _repeated_cores(groups: int):
    """Runs whose core stands in several places; of hot cores with a negative length."""
    def run(table: pa.Table) -> pa.Table:
        kinds, blocks = table.column("kind").to_pylist(), table.column("block").to_pylist()
        settled = [(p, 1, b) for p, k, b in zip(table.column("part").to_pylist(), kinds, blocks) if k == 1]
        hashes, doc, rank, start, length, weight = joined(
            [b for k, b in zip(kinds, blocks) if k == 0], [np.uint64, np.int64, np.int64, np.int64, np.int32, np.int32])
        order, first, count = first_of(hashes, ())
        total = np.empty(len(hashes), dtype=np.int64)
        if len(order):
            total[order] = np.repeat(np.add.reduceat(weight[order].astype(np.int64), first), count)
        named = (total > 1) & (weight < HOT_CORE)
        length = np.where(total >= HOT_CORE, -length, length)
        out = spread(group_of(doc[named], rank[named], groups), 1, doc[named], rank[named], start[named], length[named])
        return pa.Table.from_batches([batch(settled + out)])

    return run


def _segments(width: int, core: int, groups: int):
    def run(held: pa.Table, answers: pa.Table) -> pa.Table:
        group, powers, rows = Group(held, answers), Powers(), []
        asked, found = Questions(groups, False), []
        for begin, end in group.pieces(SLICE):
            if not any((int(group.doc[i]), int(group.rank[i])) in group.found for i in range(begin, end)):
                continue
            low = group.edges[begin]
            data, edges = group.data[low:group.edges[end]], group.edges[begin:end + 1] - low
            strings = Strings(data, edges, width, core, powers)
            count = len(strings.inside)
            doc, rank = group.doc[begin:end], group.rank[begin:end]
            hot = np.flatnonzero(group.marked(begin, end, edges, len(data), sign=-1)[:count] & strings.inside)
            if len(hot):
                owner = strings.owner[hot]
                rows += asked.add(strings.hashes(hot, hot + width), doc[owner], rank[owner], hot - edges[owner],
                                  np.ones(len(hot), dtype=np.int32))
            owner, first, length, chosen = strings.runs(group.marked(begin, end, edges, len(data))[:count])
            if len(first):
                last = first + length - 1 + width
                whole = strings.hashes(first, last) ^ mixed((chosen - first).astype(np.uint64))
                around = [data[a:p].tobytes() + data[p + core:b].tobytes()
                          for a, p, b in zip(first.tolist(), chosen.tolist(), last.tolist())]
                found.append((whole, strings.hashes(chosen, chosen + core), doc[owner], rank[owner],
                              first - edges[owner], length.astype(np.int32), (chosen - first).astype(np.int32), around))
        rows += asked.flush()
        if found:
            rows += _sent([np.concatenate(x) for x in list(zip(*found))[:7]], sum((x[7] for x in found), []), groups)
        return pa.Table.from_batches([batch(rows)])

    return run


def _sent(arrays: list[np.ndarray], around: list[bytes], groups: int) -> list[tuple[int, int, bytes]]:
    """Segments (kind 2), equal ones once; where there are several here, all their strings are repeated."""
    whole, cores, doc, rank, start, length, left = arrays
    order, first, count = first_of(whole, ())
    each = np.empty(len(whole), dtype=np.int64)
    each[order] = np.repeat(count, count)
    several = each > 1
    out = spread(group_of(doc[several], rank[several], groups), 1, doc[several], rank[several], start[several],
                 length[several])
    sent = order[first]
    weight = np.minimum(each, 2).astype(np.int32)
    part = bucket_of(cores[sent], groups)
    sent = sent[np.argsort(part, kind="stable")]
    part = np.sort(part, kind="stable")
    edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
    for b, e in zip(edges[:-1], edges[1:]):
        own = sent[b:e]
        texts = [around[i] for i in own.tolist()]
        sizes = np.array([len(t) for t in texts], dtype=np.int32)
        out.append((int(part[b]), 2, squeeze(cores[own], doc[own], rank[own], start[own], length[own], left[own],
                                             weight[own], sizes, np.frombuffer(b"".join(texts), dtype=np.uint8))))
    return out


def repeated_starts(segments: list[tuple[bytes, int, int]], several: list[bool], letters: int) -> list[list[int]]:
    """Which strings of each segment that stands in one place stand in another segment too.

    A segment is the bytes around its core, how many of them are left of it, and
    its number of strings; a string has ``letters`` letters, the core being one.
    """
    texts = []
    for around, left, _ in segments:
        around = around.decode("latin-1")
        texts.append(around[:left] + CORE_LETTER + around[left:] + END_LETTER)
    text = "".join(texts)
    owner = [-1] * len(text)
    begin, at = [], 0
    for d, (_, _, count) in enumerate(segments):
        begin.append(at)
        owner[at:at + count] = [d] * count
        at += len(texts[d])
    found: list[list[int]] = [[] for _ in segments]
    before, own = -1, ""
    marked = False
    for i in suffix_order(text):
        if owner[i] < 0:
            continue
        string = text[i:i + letters]
        if string == own:
            if not marked:
                found[owner[before]].append(before - begin[owner[before]])
            found[owner[i]].append(i - begin[owner[i]])
            marked = True
        else:
            marked = False
        before, own = i, string
    return [[] if many else starts for starts, many in zip(found, several)]


def _repeated_strings(width: int, core: int, groups: int):
    windows = answered(groups, False)

    def run(table: pa.Table) -> pa.Table:
        kinds = np.array(table.column("kind").to_pylist(), dtype=np.int64)
        out = [windows(table.filter(pa.array(kinds != 2)))]
        parts = [expand(b) for b in table.filter(pa.array(kinds == 2)).column("block").to_pylist()]
        if parts:
            out.append(pa.Table.from_batches([batch(_met(parts, width - core + 1, groups))]))
        return pa.concat_tables(out)

    return run


def _met(parts: list[list[np.ndarray]], letters: int, groups: int) -> list[tuple[int, int, bytes]]:
    """Answers about the segments of a bucket."""
    cores, doc, rank, start, length, left, weight, sizes = [np.concatenate([p[i] for p in parts]) for i in range(8)]
    data = np.concatenate([p[8] for p in parts]).tobytes()
    ends = np.cumsum(sizes.astype(np.int64))
    begins = ends - sizes
    order, first, count = first_of(cores, ())
    named: list[tuple[int, int, int]] = []
    for at, number in zip(first.tolist(), count.tolist()):
        if number == 1:
            continue
        own = order[at:at + number].tolist()
        same: dict[tuple[bytes, int], list[int]] = {}
        for i in own:
            same.setdefault((data[begins[i]:ends[i]], int(left[i])), []).append(i)
        several = [sum(int(weight[i]) for i in these) > 1 for these in same.values()]
        for these, many in zip(same.values(), several):
            if many:
                named += [(i, int(start[i]), int(length[i])) for i in these if weight[i] == 1]
        if len(same) > 1 and not all(several):
            segments = [(*key, int(length[these[0]])) for key, these in same.items()]
            for these, starts in zip(same.values(), repeated_starts(segments, several, letters)):
                named += [(these[0], int(start[these[0]]) + k, 1) for k in starts]
    if not named:
        return []
    entry, begin, many = map(np.array, zip(*named))
    return spread(group_of(doc[entry], rank[entry], groups), 1, doc[entry], rank[entry], begin.astype(np.int64),
                  many.astype(np.int32))


def _removed(width: int):
    def run(held: pa.Table, answers: pa.Table) -> pa.Table:
        group, out = Group(held, answers), []
        for begin, end in group.pieces(SLICE):
            low = group.edges[begin]
            data, edges = group.data[low:group.edges[end]], group.edges[begin:end + 1] - low
            gone = group.marked(begin, end, edges, len(data), width)
            kept, found = [], []
            for b, e in zip(edges[:-1], edges[1:]):
                own = gone[b:e]
                steps = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).tolist()
                kept.append((data[b:e][~own] if steps else data[b:e]).tobytes())
                found.append([{"start": x, "end": y} for x, y in zip(steps[::2], steps[1::2])])
            out.append(pa.RecordBatch.from_arrays([
                pa.array(group.doc[begin:end], mask=group.anonymous[begin:end].astype(bool)),
                pa.array(np.diff(edges)), pa.array(kept, pa.binary()), pa.array(found, SCHEMA.field("spans").type)],
                schema=SCHEMA))
        return pa.Table.from_batches(out, SCHEMA)

    return run


def remove_repeats(docs: DataFrame, width: int = 400, core: int = CORE, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, kept, spans`` of each row; spans count bytes of the input, their ends exclusive.

    ``core`` must be at most ``width``.
    """
    rows, once = identified(docs, id_column, text_column)
    groups = groups_for(rows)
    moved = text_blocks(once, groups)
    cores = once.select("doc", "rank", "text").mapInArrow(_cores(width, core, groups), BLOCK)
    repeated = stored(cores.groupBy("part").applyInArrow(_repeated_cores(groups), BLOCK), "repeated-cores")
    segments = moved.groupBy("part").cogroup(repeated.groupBy("part")).applyInArrow(
        _segments(width, core, groups), BLOCK)
    strings = segments.groupBy("part").applyInArrow(_repeated_strings(width, core, groups), BLOCK)
    return text_blocks(rows, groups).groupBy("part").cogroup(strings.groupBy("part")).applyInArrow(_removed(width), RESULT)
