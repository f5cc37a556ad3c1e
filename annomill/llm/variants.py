"""Spelling variants: words one edit apart, found in bidirectional FM indexes.

Two words are *near* if one code point put in, taken out or replaced turns one into
the other.  Then they agree in a half: all before the middle or all behind it.

**Dealing.** A word takes a place for each half it may share with a near one (by its
own length and by that of a word one shorter).  Equal halves go to one bucket, and
buckets hold a bounded part of the vocabulary; a half that very many words share
is dealt by the halves of what is left, by the same rule.  So near words meet in some
bucket, and nobody holds the whole vocabulary.

**Searching.** A bucket writes its words as one text between delimiters and builds
an FM index of it and of its reverse.  A word is searched by two schemes: match the
first half, with the delimiter ahead, exactly, and go on to the right across the
other half and its delimiter with one error; or match the last half and go on to the
left.  A match is a pair of suffix-rank intervals, one in each index, kept in step, so
that it grows on either side.  All words of a bucket go on together, as arrays.  An
interval of a single rank holds the word itself alone and is given up.

**Grouping.** A word's form is its most frequent near word if that one is at least
``FACTOR`` times as frequent; forms are followed to the last, the root, by doubling.

Defined cases: NULL and empty words are left out; repeated rows of a vocabulary add
up; words without a near word have no form and are their own root; ties go to the
smaller word in code-point order; counts rise along forms, so there are no circles; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

FACTOR = 10
#: Code points of a bucket's places, and the words that may share a half before it is dealt further.
BUCKET_CHARS = 1 << 17
HOT_WORDS = 20_000
REFINEMENTS = 3
BUCKETS_IN_TASK = 8
#: Bytes of a table of symbol counts; a larger text has one for every few places.
TABLE_BYTES = 32 << 20
#: Searches that go on together.
TOGETHER = 4096


class Index:
    """Suffix ranks of a text's rotations, and how many smaller symbols stand ahead of a rank in the transformed text."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.n, self.symbols = len(text), symbols
        self.order = self._ranked(text)
        self.bwt = text[self.order - 1]
        self.stride = max(1, -(-self.n * (symbols + 1) * 4 // TABLE_BYTES))
        self.begins = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.table = np.zeros((self.n // self.stride + 1, symbols + 1), dtype=np.int32)
        for symbol in range(symbols):
            smaller = np.concatenate([[0], np.cumsum(self.bwt <= symbol, dtype=np.int32)])
            self.table[:, symbol + 1] = smaller[::self.stride]
        self.padded = np.concatenate([self.bwt, np.zeros(self.stride, self.bwt.dtype)])

    @staticmethod
    def _ranked(text: np.ndarray) -> np.ndarray:
        rank, reach = text.astype(np.int64), 1
        while True:
            key = rank * (len(text) + 1) + np.roll(rank, -reach)
            order = np.argsort(key, kind="stable")
            steps = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = np.empty_like(rank)
            rank[order] = steps
            if steps[-1] == len(text) - 1:
                return order
            reach *= 2

    def smaller(self, ranks: np.ndarray) -> np.ndarray:
        """For each rank and symbol, the smaller symbols ahead of the rank; one column more than symbols."""
        found = self.table[ranks // self.stride]
        if self.stride > 1:
            found = found.copy()
            first, over = ranks // self.stride * self.stride, ranks % self.stride
            for step in range(self.stride - 1):
                held = np.flatnonzero(over > step)
                symbol = self.padded[first[held] + step]
                found[held] += np.arange(self.symbols + 1)[None, :] > symbol[:, None]
        return found

    def grown(self, low: np.ndarray, other: np.ndarray, size: np.ndarray):
        """Intervals after each symbol ahead: rank here, rank in the other index and size, by search and symbol."""
        ahead, within = self.smaller(low), self.smaller(low + size)
        counts = within - ahead
        here = self.begins[None, :-1] + ahead[:, 1:] - ahead[:, :-1]
        return here, other[:, None] + counts[:, :-1], counts[:, 1:] - counts[:, :-1]

    def two(self, ranks: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each rank, the symbols ahead that are smaller than one symbol, and those that are no greater."""
        if self.stride > 1:
            found, at = self.smaller(ranks), np.arange(len(ranks))
            return found[at, symbol].astype(np.int64), found[at, symbol + 1].astype(np.int64)
        flat, at = self.table.reshape(-1), ranks * (self.symbols + 1) + symbol
        return flat[at].astype(np.int64), flat[at + 1].astype(np.int64)

    def one(self, low: np.ndarray, other: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """The same for one symbol of each search."""
        ahead, ahead_with = self.two(low, symbol)
        within, within_with = self.two(low + size, symbol)
        return (self.begins[symbol] + ahead_with - ahead, other + within - ahead,
                within_with - within - ahead_with + ahead)


def coded(words: list[str]) -> tuple[list[np.ndarray], int]:
    """Words as arrays of symbols from 1; 0 is the delimiter."""
    points = [np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for word in words]
    alphabet = np.unique(np.concatenate(points))
    return [np.searchsorted(alphabet, p).astype(np.int32) + 1 for p in points], len(alphabet) + 1


def joined(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The delimited text, and which word begins at a delimiter."""
    lengths = np.array([len(word) + 1 for word in words])
    text = np.zeros(lengths.sum() + 1, dtype=np.int32)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for word, start in zip(words, starts):
        text[start + 1:start + 1 + len(word)] = word
    owner = np.full(len(text), -1)
    owner[starts[:-1]] = np.arange(len(words))
    return text, owner


def search(near: Index, far: Index, words: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(search, rank in near)`` of all words with an equal first half of ``sizes`` symbols and one error behind.

    ``near`` grows matches to the left, ``far`` to the right.
    """
    count, lengths = len(words), np.array([len(word) for word in words])
    pattern = np.zeros((count, lengths.max() + 2), dtype=np.int32)
    for i, word in enumerate(words):
        pattern[i, :len(word)] = word
    at = np.arange(count)
    low, other, size = np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, near.n, np.int64)
    for step in range(sizes.max() + 1):
        on = np.flatnonzero(step <= sizes)
        # The delimiter ahead of the word comes last.
        symbol = np.where(step < sizes[on], pattern[on, np.maximum(sizes[on] - 1 - step, 0)], 0)
        low[on], other[on], size[on] = near.one(low[on], other[on], size[on], symbol)
    exact = (at, sizes.astype(np.int64), other, low, size)
    wrong = tuple(np.zeros(0, np.int64) for _ in range(5))
    found = [np.zeros((2, 0), np.int64)]
    while len(exact[0]) or len(wrong[0]):
        begun = []
        if len(exact[0]):
            who, place, low, other, size = exact
            here, there, sizes_after = far.grown(low, other, size)
            symbol, ends = pattern[who, place], place == lengths[who]
            some = sizes_after > 0
            some[:, 0] = False
            q, s = np.nonzero(some)
            put_in = (who[q], place[q], here[q, s], there[q, s], sizes_after[q, s])
            replaced = ~ends[q] & (s != symbol[q])
            begun.append(put_in)
            begun.append((who[q][replaced], place[q][replaced] + 1, *[x[replaced] for x in put_in[2:]]))
            left_out = tuple(x[~ends] for x in (who, place + 1, low, other, size))
            begun.append(left_out)
            rows = np.flatnonzero(~ends)
            after = sizes_after[rows, symbol[rows]]
            # A single rank is the word itself.
            rows = rows[after > 1]
            exact = (who[rows], place[rows] + 1, here[rows, symbol[rows]], there[rows, symbol[rows]],
                     sizes_after[rows, symbol[rows]])
        if len(wrong[0]):
            who, place, low, other, size = wrong
            here, there, after = far.one(low, other, size, pattern[who, place])
            done = (after > 0) & (place == lengths[who])
            found.append(np.stack([who[done], there[done]]))
            goes = (after > 0) & ~done
            begun.append((who[goes], place[goes] + 1, here[goes], there[goes], after[goes]))
        wrong = tuple(np.concatenate([b[i] for b in begun]) for i in range(5)) if begun else wrong
    return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def near_within(words: list[str], searches: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in ``words`` that are near, for searches ``(place, side, half)``; side 0 is the first half."""
    symbols, alphabet = coded(words)
    sides = []
    for side in (0, 1):
        text, owner = joined([word[::-1] for word in symbols] if side else symbols)
        sides.append((Index(text, alphabet), owner))
    pairs = []
    for side in (0, 1):
        (near, owner), (far, _) = sides[side], sides[1 - side]
        mine = sorted((s for s in searches if s[1] == side), key=lambda s: len(symbols[s[0]]))
        for begin in range(0, len(mine), TOGETHER):
            some = mine[begin:begin + TOGETHER]
            patterns = [symbols[place][::-1] if side else symbols[place] for place, _, _ in some]
            who, rank = search(near, far, patterns, np.array([half for _, _, half in some]))
            place = np.array([place for place, _, _ in some], dtype=np.int64)
            other = owner[near.order[rank]]
            # Nothing between the text's end and its beginning is no word.
            pairs.append(np.stack([place[who], other])[:, other >= 0])
    return tuple(np.unique(np.concatenate(pairs, axis=1), axis=1)) if pairs else (np.zeros(0, int), np.zeros(0, int))


def near_in_bucket(table: pa.Table) -> pa.Table:
    """Near words among a bucket's; places whose half no other word has are set aside first."""
    keys = table.column("key").to_numpy()
    _, at, count = np.unique(keys, return_inverse=True, return_counts=True)
    table = table.filter(pa.array(count[at] > 1))
    encoded = table.column("word").combine_chunks().dictionary_encode()
    encoded = encoded.combine_chunks() if isinstance(encoded, pa.ChunkedArray) else encoded
    words, place = encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False)
    n = np.zeros(len(words), dtype=np.int64)
    n[place] = table.column("n").to_numpy()
    searches = sorted(set(zip(place.tolist(), table.column("side").to_pylist(), table.column("half").to_pylist())))
    who, other = near_within(words, searches) if words else (np.zeros(0, int), np.zeros(0, int))
    names = pa.array(words, pa.string())
    return pa.table({"word": names.take(pa.array(who)), "near": names.take(pa.array(other)), "near_n": n[other]})


def places(vocabulary: DataFrame) -> DataFrame:
    """``word, n, side, half, key, rest``: the halves that a word may share, and what is left of it."""
    word = F.col("word")
    return _halved(vocabulary.withColumn("key", F.lit(0).cast("long")).withColumn("rest", word), first=True)


def _halved(rows: DataFrame, first: bool) -> DataFrame:
    """A place for each half of ``rest`` that a near word may share; the searched half is always that of the whole word."""
    n = F.length("rest")
    sizes = F.array_distinct(F.array(F.floor(n / 2), F.floor((n - 1) / 2)).cast("array<int>"))
    cut = rows.withColumn("size", F.explode(F.filter(sizes, lambda s: s >= 0))).withColumn(
        "at", F.explode(F.array(F.lit(0), F.lit(1))))
    ahead = F.col("at") == 0
    size, rest = F.col("size"), F.col("rest")
    shared = F.when(ahead, F.left(rest, size)).otherwise(F.right(rest, size))
    left = F.when(ahead, F.substring(rest, size + 1, n)).otherwise(F.left(rest, n - size))
    kept = ["word", "n", *([] if first else ["side", "half"])]
    searched = [F.col("at").alias("side"), F.col("size").alias("half")] if first else []
    return cut.select(*kept, *searched, F.xxhash64("key", "at", "size", shared).alias("key"), left.alias("rest"))


def spread(cut: DataFrame, hot_words: int, refinements: int) -> DataFrame:
    """Places whose key more than ``hot_words`` words have are dealt by the halves of what is left.

    All words of a key go on together, however little is left of one.
    """
    for _ in range(refinements):
        hot = stored(cut.groupBy("key").count().where(F.col("count") > hot_words).select("key"), "hot-halves")
        if hot.isEmpty():
            break
        finer = _halved(cut.join(hot, "key", "left_semi"), first=False)
        cut = stored(cut.join(hot, "key", "left_anti").unionByName(finer), "halves")
    return cut


def near_words(vocabulary: DataFrame, bucket_chars: int = BUCKET_CHARS, hot_words: int = HOT_WORDS,
               refinements: int = REFINEMENTS) -> DataFrame:
    """``word, near, near_n`` of all pairs of near words, both ways, from ``word, n`` without repeats."""
    cut = spread(places(vocabulary), hot_words, refinements)
    chars = cut.agg(F.sum(F.length("word").cast("long"))).first()[0] or 0
    buckets = max(1, -(-chars // bucket_chars))
    dealt = cut.select("word", "n", "side", "half", "key", F.pmod("key", F.lit(buckets)).alias("bucket"))
    # A number of its own keeps tasks of one size; by bytes, few tasks would seem enough.
    dealt = dealt.repartition(-(-buckets // BUCKETS_IN_TASK), "bucket")
    found = dealt.groupBy("bucket").applyInArrow(near_in_bucket, "word string, near string, near_n long")
    return found.repartition("word").distinct()


def roots(links: DataFrame, most: int) -> DataFrame:
    """``word, root`` from ``word, form``; ``most`` is the largest count, which bounds how far forms lead."""
    depth = max(1, math.floor(math.log(max(most, 1), FACTOR)) + 1)
    led = stored(links.select("word", F.col("form").alias("root")), "forms")
    for _ in range(math.ceil(math.log2(depth)) if depth > 1 else 0):
        on = led.select(F.col("word").alias("root"), F.col("root").alias("further"))
        led = stored(led.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return led


def group(vocabulary: DataFrame, factor: int = FACTOR, **dealing) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``word, n``."""
    known = vocabulary.where("word IS NOT NULL AND word <> '' AND n IS NOT NULL").groupBy("word").agg(
        F.sum("n").cast("long").alias("n"))
    known = stored(known, "vocabulary")
    near = near_words(known, **dealing).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    form_n = -F.col("best.n")
    follows = form_n >= F.lit(factor) * F.col("n")
    formed = stored(known.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(follows, F.col("best.word")).alias("form"), F.when(follows, form_n).alias("form_n")), "formed")
    most = known.agg(F.max("n")).first()[0] or 1
    led = roots(formed.where("form IS NOT NULL"), most)
    return formed.join(led, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


#: Maximal runs of letters.
RUN = "[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_chars: int = 1) -> DataFrame:
    """``doc, run`` of every run of at least ``least_chars`` letters in whole texts; only A to Z become small."""
    text = F.col(f"`{text_column}`").cast("string")
    found = docs.select(F.col(f"`{id_column}`").alias("doc"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    return found.where(F.length("run") >= least_chars).select("doc", F.translate("run", CAPITALS, SMALL).alias("run"))


def words(found: DataFrame, least_chars: int, least_count: int) -> DataFrame:
    """``word, n`` of the words of ``word`` that are long and frequent enough, counted before they move."""
    return found.where(F.length("word") >= least_chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
