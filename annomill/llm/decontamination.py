"""Finds benchmark items in documents, also reworded ones, by latent semantic retrieval.

1. Documents are cut into blocks of ``BLOCK`` words; a passage is two blocks next
   to each other.  One pass counts in how many blocks each term (a word hashed to
   2**16 slots) occurs and draws a bounded sample of blocks to begin with: the
   ``TASK_BLOCKS`` with the lowest hash of every task, of these the
   ``SAMPLE_BLOCKS`` lowest.
2. A randomised singular value decomposition of the TF-IDF rows of all blocks and
   of the items' passages gives every term ``RANK`` latent coordinates.  The sample
   only gives the directions it starts from; a further round then multiplies by the
   rows of all blocks of all documents.  The products with the matrix are taken in
   Spark; only matrices of ``RANK + OVERSAMPLE`` columns and at most 2**16 rows
   reach the driver.
3. Every block of every document is a candidate for each item of which the
   stretches that start in it may hold ``REWORDED_SHARE`` of the words, in any order.
   That is counted on the item's rarest words, ``COUNTED`` of it, of which the others
   can make up for only so many; so the count loses nothing that step 5 finds.
4. A document's candidates for an item are ranked by the cosine of the sums of the
   terms' coordinates of their passage and of the item's.  The closest is checked
   first, the others if the item is not found there: the cosine rejects nothing.
5. Candidates are checked on whole words: the longest common subsequence of the
   item and a stretch of the document twice the item's length.  An item is found
   if in any stretch it covers ``SHARE`` of the item, or ``REWORDED_SHARE`` and with
   it ``ANSWER_SHARE`` of the item's answer.  The answer is the column named, or the
   item's last quarter.  Stretches start at each word of the item or its answer; one
   that starts elsewhere holds no more than the next of these.

Items are taken in groups of about ``ITEM_GROUP``, each against all documents.

Defined cases: NULL or empty texts hold nothing; items with fewer than
``LEAST_WORDS`` words are found only if all of them stand in a row, and items
without words never; repeated documents are judged one by one, repeated items
count each; without items, or without documents, nothing is found.  Other columns
are carried along unless called as the results are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .words import Powers, Texts, give_back, letters_and_digits, mixed, slices, small_batches, texts

TERM_BITS = 16
BLOCK = 32
RANK = 64
OVERSAMPLE = 8
TASK_BLOCKS = 1_024
SAMPLE_BLOCKS = 10_000
LEAST_WORDS = 8
SHARE = 0.8
REWORDED_SHARE = 0.6
ANSWER_SHARE = 0.8
ITEM_GROUP = 2_000
PARTS = 8
SLICE = 256 << 10
#: Latent coordinates that are multiplied at once.
COLUMNS = 8
#: Blocks whose words' coordinates are looked up at once.
GATHERED = 256
#: Terms whose sums travel in one row.
SLAB = 64
#: Share of an item, its rarest words, that the blocks' words are counted against.
COUNTED = 0.65
#: Candidates whose stretches are compared at once.
ROWS = 1_024
#: Entries of the table of items' words in blocks.
CELLS = 1 << 20

RESULTS = (("contaminated", "boolean"), ("item_id", "long"), ("item_share", "double"), ("items", "array<long>"))


@dataclass
class Item:
    """One benchmark item: its words' hashes, and those of its answer."""

    item_id: int
    words: np.ndarray
    answer: np.ndarray


def words_of(part: pa.RecordBatch, column: str, powers: Powers) -> tuple[Texts, np.ndarray]:
    found = texts(part, column, letters_and_digits())
    return found, found.hashes(powers, seed=4)


def term_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def blocks_of(found: Texts) -> tuple[np.ndarray, np.ndarray]:
    """First word of every block, with one more at the end; and the text of each block."""
    counts = -(-found.counts // BLOCK)
    doc = np.repeat(np.arange(found.n), counts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.append(found.first[doc] + number * BLOCK, len(found.doc)), doc


def lists(rows: list[np.ndarray]) -> pa.Array:
    """Arrays of 32-bit integers as the rows of a list column."""
    edges = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(
        np.concatenate([np.zeros(0, np.int32), *rows]), pa.int32()))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks per term, number of blocks (term -1), and the task's share of the sample."""
    powers, counts, total, lowest = Powers(), np.zeros(1 << TERM_BITS, np.int64), 0, []
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            found, hashes = words_of(part, "text", powers)
            start, doc = blocks_of(found)
            total += len(doc)
            block = np.repeat(np.arange(len(doc)), np.diff(start))
            term = term_of(hashes)
            pairs = np.unique((block << TERM_BITS) + term)
            counts += np.bincount(pairs & ((1 << TERM_BITS) - 1), minlength=1 << TERM_BITS)
            if len(doc):
                rank = mixed(np.add.reduceat(hashes, start[:-1])) >> np.uint64(1)
                low = np.argpartition(rank, TASK_BLOCKS)[:TASK_BLOCKS] if len(rank) > TASK_BLOCKS else range(len(rank))
                # Copies: a view would keep the words of all texts around a block.
                lowest += [(int(rank[i]), term[start[i]:start[i + 1]].astype(np.int32)) for i in low]
                lowest = sorted(lowest, key=lambda x: x[0])[:TASK_BLOCKS]
    term = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.append(term, -1), pa.int32()), pa.array(np.append(counts[term], total), pa.int64()),
        pa.nulls(len(term) + 1, pa.list_(pa.int32()))], names=["term", "n", "terms"])
    if lowest:
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(lowest), pa.int32()), pa.array([rank for rank, _ in lowest], pa.int64()),
            lists([terms for _, terms in lowest])], names=["term", "n", "terms"])
    give_back()


def corpus_counts(docs: DataFrame, text_column: str) -> tuple[np.ndarray, DataFrame]:
    """Inverse block frequencies of all terms, and the sampled blocks, from which the decomposition starts."""
    counted = stored(docs.selectExpr(f"CAST(`{text_column}` AS STRING) AS text")
                     .mapInArrow(_counted, "term int, n long, terms array<int>"), "block-counts")
    sums = counted.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = sums.column("term").to_numpy(), sums.column("n").to_numpy()
    total = int(n[term < 0].sum())
    held = np.zeros(1 << TERM_BITS)
    held[term[term >= 0]] = n[term >= 0]
    sampled = counted.where("terms IS NOT NULL").orderBy("n", "terms").limit(SAMPLE_BLOCKS)
    return np.log((total + 1) / (held + 1)) + 0.05, stored(sampled.select("n", "terms"), "block-sample")


def weighted(terms: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and value of a TF-IDF matrix with rows of length 1."""
    row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    term = np.concatenate(terms).astype(np.int64) if terms else np.zeros(0, np.int64)
    pairs, tf = np.unique(row * (1 << TERM_BITS) + term, return_counts=True)
    row, term = np.divmod(pairs, 1 << TERM_BITS)
    value = tf * idf[term]
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=len(terms)))
    return row, term, value / norm[row]


def sums_by(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sum of the rows of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(rows[order], first, axis=0) if len(first) else rows[:0])


def products(row: np.ndarray, term: np.ndarray, value: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms there are, and for each its row of the matrix's transpose times the matrix times the basis."""
    found, place = np.unique(term), np.unique(row, return_inverse=True)[1]
    out = np.empty((len(found), basis.shape[1]))
    for low in range(0, basis.shape[1], COLUMNS):
        left = sums_by(row, basis[term, low:low + COLUMNS] * value[:, None])[1]
        out[:, low:low + COLUMNS] = sums_by(term, left[place] * value[:, None])[1]
    return found, out


def latent_terms(rows: DataFrame, idf: np.ndarray, rank: int = RANK, rounds: int = 2) -> np.ndarray:
    """Latent coordinates of every term: right singular vectors found by random projection.

    ``rows`` has ``terms``, a list of term slots.  Each round multiplies by the
    matrix and its transpose within the partitions, a few columns at a time; the
    partial products are summed up per term in a shuffle.
    """
    width = rank + OVERSAMPLE
    basis = np.random.default_rng(7).standard_normal((1 << TERM_BITS, width)).astype(np.float32)
    shared = rows.sparkSession.sparkContext.broadcast
    for _ in range(rounds):
        held = shared(basis)

        def product(batches, held=held):
            for batch in batches:
                terms = [np.asarray(t, dtype=np.int64) for t in batch.column("terms").to_pylist() if t]
                if terms:
                    found, out = products(*weighted(terms, idf), held.value)
                    edges = pa.array(np.arange(len(found) + 1) * width, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.int32()), pa.ListArray.from_arrays(edges, pa.array(out.reshape(-1)))],
                        names=["term", "row"])
            give_back()

        partial = rows.mapInArrow(product, "term int, row array<double>")
        added = partial.groupBy("term").agg(*[F.sum(F.col("row")[i]).cast("float").alias(f"c{i}") for i in range(width)])
        table = added.toArrow()
        held.destroy()
        basis[:] = 0
        for i in range(width):
            basis[table.column("term").to_numpy(), i] = table.column(f"c{i}").to_numpy()
        del table
        basis = orthonormal(basis)
    return np.ascontiguousarray(basis[:, :rank])


def block_rows(term: np.ndarray, start: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per block ``BLOCK`` places with a word's term and its share of the TF-IDF row, whose length is 1.

    A term that stands several times in a block takes as many places; places left over have no share.
    """
    counts, none = np.diff(start), 1 << TERM_BITS
    terms = np.full((len(counts), BLOCK), none)
    terms[np.arange(BLOCK) < counts[:, None]] = term
    terms.sort(axis=1)
    new = np.ones(terms.shape, bool)
    new[:, 1:] = terms[:, 1:] != terms[:, :-1]
    times = np.diff(np.append(np.flatnonzero(new), new.size))[np.cumsum(new) - 1].reshape(terms.shape)
    share = np.append(idf, 0)[terms]
    share /= np.sqrt((share * share * times).sum(axis=1, keepdims=True))
    terms[terms == none] = 0
    return terms, share


def add_products(terms: np.ndarray, share: np.ndarray, basis: np.ndarray, out: np.ndarray) -> None:
    """Adds the blocks' products with the basis, multiplied by their rows' transpose, to ``out``, whose rows are columns of it."""
    left = np.empty((basis.shape[1], len(terms)))
    for low in range(0, len(terms), GATHERED):
        some = slice(low, low + GATHERED)
        left[:, some] = np.matmul(share[some, None, :].astype(np.float32), basis[terms[some]])[:, 0].T
    place = terms.reshape(-1)
    for row, own in zip(out, left):
        row += np.bincount(place, (share * own[:, None]).reshape(-1), out.shape[1])


def over_all_blocks(docs: DataFrame, text_column: str, passages: list[np.ndarray], idf: np.ndarray,
                    coordinates: np.ndarray, rounds: int = 1) -> np.ndarray:
    """The latent coordinates after rounds over the blocks of all documents and the items' passages.

    ``coordinates`` are those it starts from.  A task adds up the products of all its
    blocks, so there are no more tasks than run at once: each hands on a whole matrix.
    """
    width = coordinates.shape[1] + OVERSAMPLE
    further = np.random.default_rng(11).standard_normal((1 << TERM_BITS, OVERSAMPLE)).astype(np.float32)
    basis = np.hstack([coordinates, further])
    context = docs.sparkSession.sparkContext
    read = docs.selectExpr(f"CAST(`{text_column}` AS STRING) AS text").coalesce(max(1, context.defaultParallelism))
    for _ in range(rounds):
        held = context.broadcast(basis)

        def product(batches, held=held):
            powers, out = Powers(), np.zeros((width, 1 << TERM_BITS))
            for batch in batches:
                for part in slices(batch, "text", 4 * SLICE):
                    found, hashes = words_of(part, "text", powers)
                    start, doc = blocks_of(found)
                    if len(doc):
                        add_products(*block_rows(term_of(hashes), start, idf), held.value, out)
            if out.any():
                yield from slabs(out)
            give_back()

        def added(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for slab, own in zip(batch.column("slab").to_pylist(), batch.column("sums")):
                    values = np.frombuffer(own.as_buffer(), np.float32)
                    if slab in sums:
                        sums[slab] += values
                    else:
                        sums[slab] = values.astype(np.float64)
            for slab, values in sums.items():
                yield slab_rows([slab], [values])
            give_back()

        partial = read.mapInArrow(product, "slab int, sums binary").repartition(PARTS, "slab")
        table = partial.mapInArrow(added, "slab int, sums binary").toArrow()
        held.destroy()
        following = np.zeros_like(basis)
        for slab, own in zip(table.column("slab").to_pylist(), table.column("sums")):
            following[slab * SLAB:(slab + 1) * SLAB] = np.frombuffer(own.as_buffer(), np.float32).reshape(width, SLAB).T
        del table
        for low in range(0, len(passages), ROWS):
            found, out = products(*weighted(passages[low:low + ROWS], idf), basis)
            following[found] += out
        basis = orthonormal(following)
    return np.ascontiguousarray(basis[:, :coordinates.shape[1]])


def slab_rows(numbers: list[int], sums: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(
        [own.astype(np.float32).tobytes() for own in sums], pa.binary())], names=["slab", "sums"])


def slabs(out: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The columns of a matrix, ``SLAB`` of them in a row."""
    count = out.shape[1] // SLAB
    for low in range(0, count, GATHERED):
        numbers = list(range(low, min(low + GATHERED, count)))
        yield slab_rows(numbers, [out[:, n * SLAB:(n + 1) * SLAB] for n in numbers])


def orthonormal(basis: np.ndarray) -> np.ndarray:
    """The columns' left singular vectors, by the small matrix of their products; directions without length are zero."""
    products = sum(piece.T @ piece for piece in (
        basis[at:at + 4096].astype(np.float64) for at in range(0, len(basis), 4096)))
    size, turn = np.linalg.eigh(products)
    size, turn = size[::-1], turn[:, ::-1]
    there = size > 1e-10 * max(size[0], 1e-30)
    scale = np.where(there, 1 / np.sqrt(np.where(there, size, 1)), 0)
    return basis @ (turn * scale).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def load_items(rows: list, powers: Powers) -> list[Item]:
    """Words of collected ``(item_id, text, answer)`` rows; the last quarter is the answer if none is given."""
    out = []
    for item_id, text, answer in rows:
        hashed = []
        for value in (text, answer):
            part = pa.RecordBatch.from_arrays([pa.array([value or ""], pa.string())], names=["t"])
            hashed.append(words_of(part, "t", powers)[1])
        words, answer = hashed
        if len(words):
            out.append(Item(item_id, words, answer if len(answer) else words[-max(1, len(words) // 4):]))
    return out


def common(words: list[int], masks: dict[int, int], length: int) -> int:
    """Set bits mark the item's words in a longest common subsequence, found word by word."""
    full = (1 << length) - 1
    row = full
    for word in words:
        mask = masks.get(word)
        if mask:
            kept = row & mask
            row = ((row + kept) | (row - kept)) & full
    return length - row.bit_count()


def masks_of(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, word in enumerate(words.tolist()):
        out[word] = out.get(word, 0) | 1 << i
    return out


def commons(masks: np.ndarray, row: np.ndarray, begin: np.ndarray, reach: np.ndarray, size: np.ndarray) -> np.ndarray:
    """As ``common``, for many stretches at once of items of up to 64 words.

    A stretch is ``reach`` columns of a row of masks.
    """
    full = ~np.uint64(0) >> (64 - size).astype(np.uint64)
    left = full.copy()
    for step in range(int(reach.max(initial=0))):
        kept = left & np.where(step < reach, masks[row, begin + step], np.uint64(0))
        left = ((left + kept) | (left - kept)) & full
    return size - np.bitwise_count(left)


def is_found(share, answer):
    return (share >= SHARE) | ((share >= REWORDED_SHARE) & (answer >= ANSWER_SHARE))


def share_from(item: Item, words: np.ndarray, begin: int, end: int, masks: dict[int, int], answer: dict[int, int]) -> float:
    """Best share over the stretches of ``words`` that start in ``begin:end`` and meet the rule, or 0."""
    length, best = len(item.words), 0.0
    if length < LEAST_WORDS:
        row = item.words.tobytes()
        return float(any(words[at:at + length].tobytes() == row for at in range(begin, end)))
    known = [word in masks for word in words[begin:end + 2 * length].tolist()]
    for at in range(begin, end):
        near = words[at:at + 2 * length].tolist()
        if (known[at - begin] or near[0] in answer) and sum(known[at - begin:at - begin + 2 * length]) >= least_words(length):
            share = common(near, masks, length) / length
            if share > best and is_found(share, common(near, answer, len(item.answer)) / len(item.answer)):
                best = share
    return best


def item_passages(items: list[Item]) -> tuple[list[np.ndarray], np.ndarray]:
    """Terms of each item in passages of up to two blocks, and the item of each passage."""
    terms, owner = [], []
    for i, item in enumerate(items):
        for begin in range(0, len(item.words), 2 * BLOCK):
            terms.append(term_of(item.words[begin:begin + 2 * BLOCK]))
            owner.append(i)
    return terms, np.array(owner, dtype=np.int64)


def embedded(terms: list[np.ndarray], coordinates: np.ndarray) -> np.ndarray:
    return np.array([coordinates[np.unique(t)].sum(axis=0) for t in terms], dtype=np.float32).reshape(len(terms), coordinates.shape[1])


def find(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
         item_text: str = "text", answer_column: str | None = None) -> DataFrame:
    """Adds ``contaminated``, the most covered ``item_id`` with its ``item_share``, and all found ``items``."""
    answer = F.col(f"`{answer_column}`").cast("string") if answer_column else F.lit(None).cast("string")
    asked = benchmark.select(F.col(f"`{item_column}`").cast("long").alias("id"),
                             F.col(f"`{item_text}`").cast("string").alias("text"), answer.alias("answer"))
    groups = max(1, -(-asked.count() // ITEM_GROUP))
    with small_batches(docs.sparkSession):
        idf, sampled = corpus_counts(docs, text_column)
    names = [name for name, _ in RESULTS]
    out = docs.drop(*names).withColumns({name: F.lit(None).cast(kind) for name, kind in RESULTS[1:]}).withColumn(
        "contaminated", F.lit(False)).select(*[c for c in docs.columns if c not in names], *names)
    for group in range(groups):
        rows = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(groups)) == group).collect()
        items = load_items([tuple(row) for row in rows], Powers())
        if items:
            out = _searched(out, docs, items, idf, sampled, text_column)
    return out


def _searched(docs: DataFrame, corpus: DataFrame, items: list[Item], idf: np.ndarray, sampled: DataFrame, text_column: str) -> DataFrame:
    spark = docs.sparkSession
    terms, owner = item_passages(items)
    # From Arrow: a list would be sent through further Python workers, which then stay beside those at work.
    own = spark.createDataFrame(pa.table({"n": pa.array([-1] * len(terms), pa.int64()),
                                          "terms": lists([t.astype(np.int32) for t in terms])}))
    coordinates = latent_terms(sampled.unionByName(own).repartition(PARTS, F.xxhash64("terms")), idf)
    with small_batches(spark):
        coordinates = over_all_blocks(corpus, text_column, terms, idf, coordinates)
    coordinates *= idf[:, None].astype(np.float32)
    passages = unit(embedded(terms, coordinates)).astype(np.float32)
    held = spark.sparkContext.broadcast((coordinates, passages, owner, items, idf))
    names = [name for name, _ in RESULTS]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinates, targets, owner, items, idf = held.value
        powers, known = Powers(), Known(items, idf)
        for batch in batches:
            for part in slices(batch, text_column, SLICE):
                yield _judged(part, text_column, names, coordinates, targets, owner, known, powers)
        give_back()

    return docs.mapInArrow(searched, docs.schema)


def least_words(length: int) -> int:
    """How many of an item's words a common subsequence must have."""
    return next(n for n in range(length + 1) if n / length >= REWORDED_SHARE) if length >= LEAST_WORDS else length


class Known:
    """The items' words, for a bound on common subsequences that needs no order.

    ``pairs`` are the counted words of all items, ``edges[w]:edges[w + 1]`` those of
    word w; a stretch with a common subsequence that is long enough holds ``need``
    of them, as it lacks no more of the item's words than ``least_words`` allows.
    """

    def __init__(self, items: list[Item], idf: np.ndarray):
        self.items = items
        self.vocabulary = np.unique(np.concatenate([words for item in items for words in (item.words, item.answer)]))
        self.masks = [(masks_of(item.words), masks_of(item.answer)) for item in items]
        self.length = np.array([len(item.words) for item in items])
        self.answer_length = np.array([len(item.answer) for item in items])
        self.least = np.array([least_words(n) for n in self.length.tolist()])
        self.small = (self.length >= LEAST_WORDS) & (self.length <= 64) & (self.answer_length <= 64)
        self.reach = -(-(BLOCK - 1 + 2 * self.length) // BLOCK)
        weight, pairs, self.need = idf[term_of(self.vocabulary)], [], np.zeros(len(items), np.float32)
        for i, item in enumerate(items):
            words, times = np.unique(np.searchsorted(self.vocabulary, item.words), return_counts=True)
            rarest = np.argsort(-weight[words], kind="stable")
            so_far = np.cumsum(times[rarest])
            lacking = len(item.words) - least_words(len(item.words))
            size = np.searchsorted(so_far, max(COUNTED * len(item.words), lacking + 1)) + 1
            pairs += [(word, i, n) for word, n in zip(words[rarest[:size]].tolist(), times[rarest[:size]].tolist())]
            self.need[i] = so_far[min(size, len(so_far)) - 1] - lacking
        word, self.item, self.times = np.array(sorted(pairs), dtype=np.int64).T
        self.edges = np.searchsorted(word, np.arange(len(self.vocabulary) + 1))
        both = sorted((i * len(self.vocabulary) + int(np.searchsorted(self.vocabulary, np.uint64(word))), own.get(word, 0), answer.get(word, 0))
                      for i, (own, answer) in enumerate(self.masks) if self.small[i] for word in own.keys() | answer.keys())
        self.keys = np.array([key for key, _, _ in both] + [1 << 62], dtype=np.int64)
        self.bits = np.array([[mask for _, mask, _ in both] + [0], [mask for _, _, mask in both] + [0]], dtype=np.uint64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, or -1."""
        place = np.searchsorted(self.vocabulary, hashes)
        place[place == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[place] == hashes, place, -1)

    def candidates(self, place: np.ndarray, start: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and blocks: the stretches that start there may hold enough of the item's words."""
        known = place >= 0
        number = np.repeat(np.arange(len(doc)), np.diff(start))[known]
        block, word = np.divmod(np.unique(number * len(self.vocabulary) + place[known]), len(self.vocabulary))
        reach, found, step = int(self.reach.max()), [], max(256, CELLS // len(self.items))
        for low in range(0, len(doc), step):
            high = min(len(doc), low + step)
            begin, end = np.searchsorted(block, [low, high + reach - 1])
            here, own = block[begin:end] - low, word[begin:end]
            size = self.edges[own + 1] - self.edges[own]
            pair = np.arange(size.sum()) + np.repeat(self.edges[own] - np.cumsum(size) + size, size)
            rows = min(len(doc), high + reach - 1) - low
            held = np.bincount(np.repeat(here, size) * len(self.items) + self.item[pair], self.times[pair],
                               rows * len(self.items)).reshape(rows, -1).astype(np.float32)
            sums = held[:high - low].copy()
            for k in range(1, min(reach, rows)):
                after = held[k:k + high - low]
                same = (doc[low + k:low + k + len(after)] == doc[low:low + len(after)])[:, None]
                sums[:len(after)] += np.where(same & (self.reach > k), after, 0)
            blocks, own = np.nonzero(sums >= self.need)
            found.append((own, blocks + low))
        return tuple(np.concatenate(x) for x in zip(*found))

    def shares(self, item: np.ndarray, block: np.ndarray, hashes: np.ndarray, place: np.ndarray, start: np.ndarray,
               end: np.ndarray) -> np.ndarray:
        """Of each candidate the best share over the stretches that start in its block and meet the rule, or 0.

        ``end`` is where the document of each block ends.
        """
        best = np.zeros(len(item))
        for c in np.flatnonzero(~self.small[item]).tolist():
            i, b = int(item[c]), int(block[c])
            best[c] = share_from(self.items[i], hashes[:end[b]], int(start[b]), int(start[b + 1]), *self.masks[i])
        small = np.flatnonzero(self.small[item])
        for low in range(0, len(small), ROWS):
            some = small[low:low + ROWS]
            own, here = item[some], block[some]
            size = self.length[own]
            at = start[here][:, None] + np.arange(BLOCK + 2 * size.max())
            word = np.where(at < end[here][:, None], place[np.minimum(at, len(place) - 1)], -1)
            key = own[:, None] * len(self.vocabulary) + word
            slot = np.searchsorted(self.keys, key)
            hit = (word >= 0) & (self.keys[slot] == key)
            words, answers = (np.where(hit, bits[slot], np.uint64(0)) for bits in self.bits)
            so_far = np.concatenate([np.zeros((len(some), 1), np.int64), np.cumsum(words != 0, axis=1)], axis=1)
            column = np.arange(BLOCK)
            held = np.take_along_axis(so_far, column + 2 * size[:, None], axis=1) - so_far[:, :BLOCK]
            inside = at[:, :BLOCK] < start[here + 1][:, None]
            row, begin = np.nonzero(inside & hit[:, :BLOCK] & (held >= self.least[own][:, None]))
            share = commons(words, row, begin, 2 * size[row], size[row]) / size[row]
            likely = share >= REWORDED_SHARE
            row, begin, share = row[likely], begin[likely], share[likely]
            answer = commons(answers, row, begin, 2 * size[row], self.answer_length[own[row]]) / self.answer_length[own[row]]
            met = is_found(share, answer)
            np.maximum.at(best, some[row[met]], share[met])
        return best


def closeness(item: np.ndarray, block: np.ndarray, hashes: np.ndarray, start: np.ndarray, doc: np.ndarray,
              coordinates: np.ndarray, targets: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Greatest cosine of a candidate's passage with one of its item's passages.

    A term counts once in a passage, so that one repeated word does not outweigh the rest.
    """
    own, place = np.unique(block, return_inverse=True)
    following = np.minimum(own + 1, len(doc) - 1)
    end = np.where(doc[following] == doc[own], start[following + 1], start[own + 1])
    passage = unit(embedded([term_of(hashes[b:e]) for b, e in zip(start[own], end)], coordinates))
    edges = np.searchsorted(owner, np.arange(owner.max() + 2))
    out = np.full(len(item), -1, np.float32)
    for k in range(int(np.diff(edges).max())):
        has = edges[item] + k < edges[item + 1]
        near = np.einsum("ij,ij->i", passage[place[has]], targets[edges[item[has]] + k])
        out[has] = np.maximum(out[has], near)
    return out


def _judged(part, text_column, names, coordinates, targets, owner, known, powers):
    found, hashes = words_of(part, text_column, powers)
    start, doc = blocks_of(found)
    items = known.items
    hits: dict[int, dict[int, float]] = {}
    if len(doc):
        place = known.places(hashes)
        item_of, block = known.candidates(place, start, doc)
        near = closeness(item_of, block, hashes, start, doc, coordinates, targets, owner)
        pair = doc[block] * len(items) + item_of
        order = np.lexsort((-near, pair))
        closest = np.append(True, pair[order][1:] != pair[order][:-1])[:len(order)]
        for chosen in (order[closest], order[~closest]):
            chosen = chosen[[int(i) not in hits.get(int(d), ()) for i, d in zip(item_of[chosen], doc[block[chosen]])]]
            share = known.shares(item_of[chosen], block[chosen], hashes, place, start, found.first[doc + 1])
            for c in np.flatnonzero(share).tolist():
                i, d = int(item_of[chosen[c]]), int(doc[block[chosen[c]]])
                own = hits.setdefault(d, {})
                own[i] = max(float(share[c]), own.get(i, 0.0))
    result = {name: part.column(name).to_pylist() for name in names}
    for d, own in hits.items():
        shares = sorted([(-share, items[i].item_id) for i, share in own.items()], key=lambda x: (x[0], x[1] is None, x[1]))
        before = result["item_share"][d]
        if before is None or -shares[0][0] > before:
            result["item_share"][d], result["item_id"][d] = -shares[0][0], shares[0][1]
        result["contaminated"][d] = True
        result["items"][d] = sorted([*(result["items"][d] or []), *(item for _, item in shares if item is not None)])
    kinds = {name: part.schema.field(name).type for name in names}
    columns = [pa.array(result[name], kinds[name]) if name in names else part.column(name) for name in part.schema.names]
    return pa.RecordBatch.from_arrays(columns, schema=part.schema)
