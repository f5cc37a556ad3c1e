"""Near duplicates by ProbMinHash signatures, banding and verification.

The weight of a shingle (five words in a row) is how often a text holds it.  Each
shingle sends arrivals of a Poisson process whose rate is its weight; every arrival
falls into a random slot of the text's signature, and each slot keeps the shingle
of its first arrival.  A text's processes stop as soon as no later arrival can come
first anywhere.  Two texts agree in a slot with the probability Jaccard similarity

    J(x, y) = sum over common d of 1 / sum over e of max(x_e / x_d, y_e / y_d).

Texts whose signatures agree in all slots of a band are candidates.  With
``BANDS`` bands of ``ROWS`` slots a pair of similarity 0.8 is missed with a chance
of ``(1 - 0.8 ** 5) ** 26``, about 3e-5.  Candidates are linked if their exact
similarity, taken from the texts, is at least ``SIMILAR``; a class is what links
connect.

Texts with the same weighted shingles are one text to all this.  Within a band's
bucket texts are not paired with each other but with the bucket's lowest one, then
with a few of its largest class.  Of what is still in different classes, pairs are
compared unless it follows from how both differ from one of those few that they
cannot be linked (``_cross``), so no link between candidates is lost.

Defined cases: a text of one to four words is a single shingle; NULL and empty
texts, and such of white space alone, have none and are one class; NULL ids come
first, and a class may be named by one; rows alike in id and text are one document;
an empty table gives an empty table; other columns are ignored or, by
``keep_one``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .blocks import LOWEST
from .lines import keyed, possible
from .words import Powers, Texts, give_back, mixed, running, slices, small_batches, spans, texts, windows

WORDS = 5
SIMILAR = 0.8
ROWS = 5
BANDS = 26
GOLDEN = 0x9E3779B97F4A7C15
SLICE = 512 << 10
#: Members of a bucket's largest class that others are compared with before all are.
MEMBERS = 8
#: Words of 64 bits of a delta's parity signature.
PARITY = 16
#: Cells that a text's shingles are added up in, by their hash.
CELLS = 512
#: Texts whose cells are compared with as many others' at once.
PACK = 512


def shingles(found: Texts, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and weight of every distinct shingle, by text."""
    hashes = found.hashes(powers, seed=1)
    count = max(0, len(hashes) - WORDS + 1)
    full = np.flatnonzero(np.arange(count) + WORDS <= found.first[found.doc[:count] + 1])
    doc, own = found.doc[full], windows(hashes, powers, WORDS)[full]
    short = np.flatnonzero((found.counts > 0) & (found.counts < WORDS))
    if len(short):
        sums = running(hashes, powers)
        doc = np.append(doc, short)
        own = np.append(own, spans(sums, found.first[short], found.first[short + 1], powers))
    order = np.lexsort((own, doc))
    doc, own = doc[order], own[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (own[1:] != own[:-1]))) if len(doc) else order
    return doc[new], own[new], np.diff(np.append(new, len(doc)))


def uniform(hashes: np.ndarray, arrival: int, use: int) -> np.ndarray:
    return mixed(hashes + np.uint64((arrival * 2 + use + 1) * GOLDEN % (1 << 64)))


def signatures(doc: np.ndarray, hashes: np.ndarray, weight: np.ndarray, count: int, slots: int) -> np.ndarray:
    """The shingle that arrives first in each slot of each text; 0 for a text without shingles."""
    earliest = np.full(count * slots, np.inf)
    out = np.zeros(count * slots, dtype=np.uint64)
    row, own, rate, time, arrival = doc, hashes, weight.astype(np.float64), np.zeros(len(doc)), 0
    while len(row):
        chance = ((uniform(own, arrival, 0) >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53
        time = time - np.log(chance) / rate
        cell = row * slots + (uniform(own, arrival, 1) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(earliest, cell, time)
        hit = time == earliest[cell]
        out[cell[hit]] = own[hit]
        limit = earliest.reshape(count, slots).max(axis=1)
        alive = time < limit[row]
        row, own, rate, time = row[alive], own[alive], rate[alive], time[alive]
        arrival += 1
    return out.reshape(count, slots)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A hash for each band of each row."""
    keys = np.zeros((len(signature), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(signature), (band + 1) * GOLDEN % (1 << 64), dtype=np.uint64)
        for slot in range(band * ROWS, (band + 1) * ROWS):
            key = mixed(key ^ signature[:, slot]) + np.uint64(slot)
        keys[:, band] = key
    return keys


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for one in batches:
        for part in slices(one, "text", SLICE):
            found = texts(part, "text")
            doc, own, weight = shingles(found, powers)
            keys = band_keys(signatures(doc, own, weight, found.n, ROWS * BANDS))
            sums = []
            for seed in (3, 5):
                total = np.zeros(found.n, dtype=np.uint64)
                np.add.at(total, doc, mixed(own + np.uint64(seed)) * weight.astype(np.uint64))
                sums.append(mixed(total).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                part.column("node"), pa.array(sums[0]), pa.array(sums[1]),
                pa.ListArray.from_arrays(pa.array(np.arange(found.n + 1) * BANDS, pa.int32()),
                                         pa.array(keys.reshape(-1).view(np.int64)))],
                names=["node", "a", "b", "keys"])
    give_back()


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two texts' ``(hashes, weights)``, hashes ascending."""
    both, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 1.0 if not len(x[0]) and not len(y[0]) else 0.0
    xs, ys = x[1][i].astype(np.float64), y[1][j].astype(np.float64)
    order = np.argsort(xs / ys, kind="stable")
    xs, ys = xs[order], ys[order]
    only_x, only_y = x[1].sum() - xs.sum(), y[1].sum() - ys.sum()
    above = only_x + np.cumsum(xs[::-1])[::-1]
    below = only_y + np.cumsum(ys) - ys
    return float((1.0 / (above / xs + below / ys)).sum())


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()

    def sets(part: pa.RecordBatch, column: str) -> list:
        doc, own, weight = shingles(texts(part, column), powers)
        edges = np.searchsorted(doc, np.arange(part.num_rows + 1))
        return [(own[b:e], weight[b:e]) for b, e in zip(edges[:-1], edges[1:])]

    for one in batches:
        for half in slices(one, "text", SLICE):
            for part in slices(half, "other_text", SLICE):
                linked = [similarity(x, y) >= SIMILAR for x, y in zip(sets(part, "text"), sets(part, "other_text"))]
                yield part.select(["node", "other"]).filter(pa.array(linked, pa.bool_()))
    give_back()


def linked(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs ``node, other`` whose texts are similar."""
    mine = pairs.join(held, "node")
    both = mine.join(held.select(F.col("node").alias("other"), F.col("text").alias("other_text")), "other")
    return both.select("node", "other", "text", "other_text").mapInArrow(_compared, "node long, other long")


def roots(parents: DataFrame) -> DataFrame:
    """``node, label`` from ``node, other`` with one lower ``other`` for each node: where the pointers end."""
    labels = parents.select("node", F.col("other").alias("label"))
    while True:
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        ahead = stored(labels.join(further, "label", "left").select("node", "label", "next"), "roots")
        if ahead.where("next IS NOT NULL").isEmpty():
            return labels
        labels = ahead.select("node", F.coalesce("next", "label").alias("label"))


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of all linked nodes; the label is the lowest node that links lead to.

    In each round a node takes the lowest label around it, and then that label's own;
    the sum of the labels falls until nothing changes.
    """
    edges = stored(links.select("node", "other").union(links.select("other", "node")), "links")
    labels = edges.select("node", F.col("node").alias("label")).distinct()
    before = None
    while True:
        labels = stored(labels, "labels")
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels
        before = total
        near = edges.join(labels.withColumnRenamed("node", "other"), "other").select("node", "label")
        lowest = stored(near.union(labels.select("node", "label")).groupBy("node").agg(F.min("label").alias("label")),
                        "lowest")
        jump = lowest.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = lowest.join(jump, "label").select("node", F.least("label", "far").alias("label"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after further links, which are few; they are followed between classes, not nodes."""
    known = labels.select("node", F.col("label").alias("x"))
    ends = links.join(known, "node", "left").join(
        known.select(F.col("node").alias("other"), F.col("x").alias("y")), "other", "left")
    between = ends.select("node", "other", F.coalesce("x", "node").alias("x"), F.coalesce("y", "other").alias("y"))
    found = components(between.select(F.col("x").alias("node"), F.col("y").alias("other")))
    more = between.select("node", F.col("x").alias("label")).union(between.select("other", "y")).union(
        found.select("node", F.col("node").alias("label")))
    every = labels.union(more.join(labels, "node", "left_anti").distinct())
    lower = found.select(F.col("node").alias("label"), F.col("label").alias("low"))
    return stored(every.join(lower, "label", "left").select("node", F.coalesce("low", "label").alias("label")), "merged")


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_doc, _rank, label`` of all documents; documents of a class have the same label."""
    with small_batches(docs.sparkSession):
        return _classes(docs, id_column, text_column)


def _classes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows, once = keyed(docs, id_column, text_column)
    node = F.when(F.col("_rank") == 0, F.col("_doc")).otherwise(F.xxhash64("_doc", "_rank"))
    columns = ["_doc", "_rank", node.alias("node"),
               F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text")]
    every, named = rows.select(columns), once.select(columns)
    signed = stored(named.select("node", "text").mapInArrow(
        _signed, "node long, a long, b long, keys array<long>"), "signatures")
    same = stored(signed.groupBy("a", "b").agg(F.min("node").alias("first")), "same-shingles")
    firsts = signed.join(same.select(F.col("first").alias("node")), "node", "left_semi")
    bands = stored(firsts.select("node", F.explode("keys").alias("key")), "bands")
    leaders = stored(bands.groupBy("key").agg(F.min("node").alias("other"), F.max("node").alias("last"))
                     .where("other <> last").select("key", "other"), "band-leaders")
    shared = stored(possible(bands, "key", leaders).join(leaders, "key"), "shared-bands")
    involved = shared.select("node").distinct()
    held = stored(possible(named, "node", involved).select("node", "text").join(involved, "node"),
                  "candidate-texts")
    stars = stored(shared.where("node <> other").select("node", "other").distinct(), "stars")
    nearest = stored(stars.groupBy("node").agg(F.min("other").alias("other")), "pairs-1")
    labels = stored(roots(stored(linked(nearest, held), "links-1")), "labels-1")
    seen = nearest

    def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs in different classes that have not been compared."""
        mine = labels.select("node", F.col("label").alias("x"))
        other = labels.select(F.col("node").alias("other"), F.col("label").alias("y"))
        split = pairs.join(mine, "node", "left").join(other, "other", "left").where(
            "coalesce(x, node) <> coalesce(y, other)").select("node", "other")
        return split.join(seen, ["node", "other"], "left_anti")

    def with_links_of(pairs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
        if pairs.isEmpty():
            return labels
        links = stored(linked(pairs, held), label)
        return labels if links.isEmpty() else merged(labels, links)

    rest = stored(apart(stars, labels), "pairs-2")
    labels = with_links_of(rest, labels, "links-2")
    seen = seen.union(rest)
    left = _mixed(shared, labels)
    largest = stored(_largest(left), "largest-classes")
    rest = stored(apart(_with_largest(left, largest), labels), "pairs-3")
    labels = with_links_of(rest, labels, "links-3")
    seen = seen.union(rest)
    bases = largest.select("key", F.col("members")[0].alias("base"))
    rest = stored(apart(_cross(_mixed(shared, labels), bases, held), labels), "pairs-4")
    labels = with_links_of(rest, labels, "links-4")
    named_same = signed.select("node", "a", "b").join(same, ["a", "b"]).select("node", "first")
    label = named_same.join(labels.withColumnRenamed("node", "first"), "first", "left").select(
        "node", F.coalesce("label", "first").alias("label"))
    return stored(every.select("_doc", "_rank", "node").join(label, "node").select("_doc", "_rank", "label"), "classes")


def _mixed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, node, label`` of the buckets with several classes, which are few."""
    labelled = shared.select("key", "node").join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label"))
    mixed_keys = stored(labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(
        "low <> high").select("key"), "mixed-keys")
    return stored(labelled.join(mixed_keys, "key"), "mixed-buckets")


def _largest(left: DataFrame) -> DataFrame:
    """``key, most, members``: the largest class of each bucket and a few of its nodes."""
    some = F.array(*[F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(MEMBERS)])
    sides = left.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.array_distinct(some).alias("members"))
    largest = sides.groupBy("key").agg(F.max(F.struct("n", "label", "members")).alias("best"))
    return largest.select("key", F.col("best.label").alias("most"), F.col("best.members").alias("members"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs, the lower node second."""
    return pairs.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")).distinct()


def _with_largest(left: DataFrame, largest: DataFrame) -> DataFrame:
    """Pairs of a bucket's other nodes with a few nodes of its largest class.

    A class of thousands of copies has strays that are like some of them but not
    like the lowest; most find one here, which spares comparing them with all.
    """
    rest = left.join(largest, "key").where("label <> most")
    return _ordered(rest.select("node", F.explode("members").alias("other")))


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each bit whether an odd number of the hashes falls to it.

    Two sets differ in at least as many hashes as their parities differ in bits.
    """
    bits = PARITY * 64
    count = np.bincount((mixed(hashes) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8)).view(np.int64)


def cells(hashes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """How a text's weight falls to a few cells; texts are at most as similar as their cells.

    A shingle's term of the similarity, ``1 / sum over e of max(x_e / x_d, y_e / y_d)``, is
    concave in ``x_d, y_d`` and grows in proportion with both, so the term of a sum is at
    least the sum of the terms; and no maximum of sums exceeds the sum of the maxima.
    """
    cell = (mixed(hashes) % np.uint64(CELLS)).astype(np.int64)
    return np.bincount(cell, weights=weight, minlength=CELLS).astype("<i8")


def similar_cells(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which rows' cells have a similarity of at least ``SIMILAR`` to one row's, but for rounding."""
    least = SIMILAR - 1e-9
    held = one > 0
    x, ys = one[held].astype(np.float64), others[:, held].astype(np.float64)
    total, totals = x.sum(), others.sum(axis=1).astype(np.float64)
    if not len(x):
        return totals == 0
    # Added up, what two texts have alike in shares is no less than their similarity.
    alike = np.minimum(x / total, ys / np.maximum(totals, 1)[:, None]).sum(axis=1)
    found = np.flatnonzero(alike >= least)
    ys, without = ys[found], (totals - ys.sum(axis=1))[found]
    with np.errstate(divide="ignore"):
        order = np.argsort(x / ys, axis=1)
    ys, xs = np.take_along_axis(ys, order, axis=1), x[order]
    above = np.cumsum(xs[:, ::-1], axis=1)[:, ::-1]
    below = np.cumsum(ys, axis=1) - ys + without[:, None]
    both = ys > 0
    terms = np.where(both, 1.0 / (above / xs + below / np.where(both, ys, 1.0)), 0.0)
    out = np.zeros(len(others), dtype=bool)
    out[found] = terms.sum(axis=1) >= least
    return out


def _deltas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()

    def sets(part: pa.RecordBatch, column: str) -> list:
        doc, own, weight = shingles(texts(part, column), powers)
        edges = np.searchsorted(doc, np.arange(part.num_rows + 1))
        return [(own[b:e], weight[b:e]) for b, e in zip(edges[:-1], edges[1:])]

    for one in batches:
        for half in slices(one, "text", SLICE):
            for part in slices(half, "base_text", SLICE):
                mine, base = sets(part, "text"), sets(part, "base_text")
                apart = [np.setxor1d(x, y, assume_unique=True) for (x, _), (y, _) in zip(mine, base)]
                size = [2 * int(weight.sum()) - len(x) for x, weight in mine]
                uneven = [4 * m > 5 * len(x) for m, (x, _) in zip(size, mine)]
                limit = [min(2 * int(weight.sum()) - len(x), len(x) * 5 // 4) for x, weight in base]
                yield pa.RecordBatch.from_arrays([
                    part.column("base"), part.column("node"), part.column("label"),
                    pa.array(size, pa.int64()), pa.array(limit, pa.int64()), pa.array(uneven, pa.bool_()),
                    pa.array([x.view(np.int64) for x in apart], pa.list_(pa.int64())),
                    pa.array([parities(x) for x in apart], pa.list_(pa.int64())),
                    pa.array([cells(*x).tobytes() for x in mine], pa.binary())],
                    names=["base", "node", "label", "size", "limit", "uneven", "delta", "parity", "cells"])
    give_back()


def _cross(left: DataFrame, bases: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs of different classes around a base that may be linked.

    ``left`` has ``key, node, label``, ``bases`` each key's ``base``: a node that all
    others of the key have been compared with.  A text is described by its *delta*,
    the distinct shingles that either it or the base has; two texts differ in exactly
    the ``h`` shingles that only one of their deltas holds.  With m shingles in all,
    n of them distinct, and the size ``s = 2 m - n``, the similarity of x and y is at
    most ``c / (c + o)``, where c is the sum of the larger weights of what both hold
    and o the weight of what one holds.  As ``o >= h`` and
    ``c <= m_x + m_y - o - (n_x + n_y - h) / 2``, 0.8 implies ``9 h <= s_x + s_y``.

    With a limit of the base's size, 5 / 4 of its distinct shingles at most, a *far* text
    has ``9 |delta| > s + limit``, a *heavy* one ``s > 9 |delta| + limit`` or
    ``s > 5 / 4 n``, for which these bounds say little.  So of two linked texts of which one is far and none heavy the deltas have at least

        (9 |far delta| - s_far - limit) / 18   and   (9 |delta| + limit - s) / 18

    shingles in common (the second is exceeded), and they meet in the rarest shingles
    of their deltas, as many as leave fewer than that.  What all texts of a group of
    near copies have in common is in no delta, so such a group does not meet in it.

    Heavy texts, which repeat themselves, and texts outside the base's class that are
    not far are few; their cells are compared with those of all others around it
    (``_alike``), and pairs whose cells are similar are left.
    """
    around = left.join(bases, "key").select("base", "node", "label").distinct()
    texts_of = around.join(held, "node").join(
        held.select(F.col("node").alias("base"), F.col("text").alias("base_text")), "base")
    nodes = stored(
        texts_of.select("base", "node", "label", "text", "base_text").mapInArrow(
            _deltas, "base long, node long, label long, size long, limit long, uneven boolean, delta array<long>, parity array<long>, "
                     "cells binary")
        .withColumn("d", F.size("delta").cast("long")).withColumn("far", F.expr("9 * d > size + limit"))
        .withColumn("heavy", F.expr("uneven OR size > 9 * d + limit")), "deltas")
    own = around.where("node = base").select("base", F.col("label").alias("base_label"))
    plain = F.expr("heavy OR (NOT far AND label <> base_label)")
    told = nodes.join(own, "base").select("base", "node", "label", "cells", plain.alias("plain"))
    return _ordered(_alike(told).unionByName(_sharing(nodes.where("NOT heavy"))))


def _alike(told: DataFrame) -> DataFrame:
    """Pairs of a plain and another text of different classes around a base whose cells are similar.

    Both sides are dealt to packs, and one task at a time compares a pack with a pack, so a
    large group spreads over many tasks.
    """
    def compared(mine: pa.Table, others: pa.Table) -> pa.Table:
        if not mine.num_rows or not others.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
        left, right = [np.frombuffer(b"".join(table.column(name).to_pylist()), dtype="<i8").reshape(-1, CELLS)
                       for table, name in ((mine, "cells"), (others, "other_cells"))]
        node, other = mine.column("node").to_numpy(), others.column("other").to_numpy()
        label, apart = mine.column("label").to_numpy(), others.column("other_label").to_numpy()
        found = []
        for i in range(len(left)):
            rows = np.flatnonzero(apart != label[i])
            found.append(rows[similar_cells(left[i], right[rows])])
        first = np.repeat(node, [len(rows) for rows in found])
        second = other[np.concatenate(found)]
        return pa.table({"node": pa.array(first, pa.int64()), "other": pa.array(second, pa.int64())})

    packs = told.groupBy("base").agg(F.ceil(F.count_if("plain") / PACK).alias("own_packs"),
                                     F.ceil(F.count(F.lit(1)) / PACK).alias("all_packs")).where("own_packs > 0")
    dealt = stored(told.join(packs, "base"), "packs")

    def pack(of: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(of))

    def each(of: str) -> Column:
        return F.explode(F.expr(f"sequence(0L, {of} - 1)"))

    mine = dealt.where("plain").select(
        "base", pack("own_packs").alias("i"), each("all_packs").alias("j"), "node", "label", "cells")
    others = dealt.select(
        F.col("base").alias("other_base"), each("own_packs").alias("other_i"), pack("all_packs").alias("other_j"),
        F.col("node").alias("other"), F.col("label").alias("other_label"), F.col("cells").alias("other_cells"))
    return mine.groupBy("base", "i", "j").cogroup(others.groupBy("other_base", "other_i", "other_j")).applyInArrow(
        compared, "node long, other long")


def _sharing(nodes: DataFrame) -> DataFrame:
    """Pairs of a far and another text of different classes that may differ in a ninth of their sizes' sum at most.

    Where two deltas meet for the first time, what follows in either bounds how much
    more they have in common; parities bound in how much they differ.
    """
    cut = nodes.select("base", "node", "label", F.explode("delta").alias("shingle"))
    several = cut.groupBy("base", "shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    ranked = cut.join(several.select("base", "shingle", "n"), ["base", "shingle"]).groupBy("base", "node").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("ranked"))
    known = stored(nodes.drop("delta", "cells").join(ranked, ["base", "node"]), "shared-deltas")

    def rarest(rows: DataFrame, common: Column) -> DataFrame:
        count = (F.size("ranked") - common + 1).cast("int")
        return rows.where(count > 0).select(
            "base", "node", "label", "size", "d", "parity", F.size("ranked").alias("n"),
            F.posexplode(F.slice("ranked", F.lit(1), count)).alias("at", "one")).select(
            "base", "one.shingle", "node", "label", "size", "d", (F.col("n") - F.col("at")).alias("left"), "parity")

    far = rarest(known.where("far"), F.expr("(9 * d - size - limit + 17) div 18")).alias("f")
    every = rarest(known, F.expr("(9 * d + limit - size) div 18 + 1")).alias("e")
    differ = " + ".join(f"bit_count(f.parity[{i}] ^ e.parity[{i}])" for i in range(PARITY))
    found = far.join(every, F.expr(f"""
        f.base = e.base AND f.shingle = e.shingle AND f.label <> e.label
        AND 18 * least(f.left, e.left) >= 9 * (f.d + e.d) - f.size - e.size
        AND 9 * ({differ}) <= f.size + e.size"""))
    return found.select("f.node", F.col("e.node").alias("other"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, class_id, class_size, kept`` of each row; a class is named by its lowest id, which is kept."""
    found = classes(docs, id_column, text_column)
    sizes = found.groupBy("label").agg(F.min(F.struct("_doc", "_rank")).alias("least"),
                                       F.count(F.lit(1)).alias("class_size"))
    first = F.struct("_doc", "_rank") == F.col("least")
    known = lambda column: F.when(column == LOWEST, None).otherwise(column)
    return found.join(sizes, "label").select(
        known(F.col("_doc")).alias("doc_id"), known(F.col("least._doc")).alias("class_id"), "class_size",
        first.alias("kept"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of one document of each class: the one with the lowest id."""
    found = classes(docs, id_column, text_column)
    least = found.groupBy("label").agg(F.min(F.struct("_doc", "_rank")).alias("least")).select("least._doc", "least._rank")
    _, once = keyed(docs, id_column, text_column)
    return once.join(least, ["_doc", "_rank"], "left_semi").drop("_doc", "_rank")
