"""Vectorised access to the words and bytes of many texts at once.

Texts are looked at as one run of UTF-8 bytes.  Hashes are polynomials modulo
2**64 over a random value per byte or word, taken as differences of running
sums, so that a window of any length costs the same.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BASE = 0x9E3779B97F4A7C15 | 1
SECOND_BASE = 0xC2B2AE3D27D4EB4F | 1
SLICE_BYTES = 1 << 20
SPACES = np.array([0x20, *range(0x09, 0x0E)], dtype=np.uint8)


#: Rows of text that move to Python at once; by default it would be ten thousand.
BATCH_ROWS = "1000"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """For jobs run within: batches of fewer rows, which keeps long texts from piling up on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Returns freed memory to the system; a worker lives on beside later tasks, which need it elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_values(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed))


class Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def running(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Running sums from which ``spans`` takes hashes; one longer than its input."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers.upto(len(values))[0], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of the spans, the same wherever a span stands."""
    return mixed((sums[ends] - sums[starts]) * powers.upto(len(sums))[1][starts])


def blank_separated() -> tuple[np.ndarray, np.ndarray]:
    """What each byte counts as in a word, and which bytes separate words; NUL does not."""
    separates = np.zeros(256, dtype=bool)
    separates[SPACES] = True
    return np.arange(256, dtype=np.uint8), separates


def letters_and_digits() -> tuple[np.ndarray, np.ndarray]:
    """As ``blank_separated``, but ASCII marks separate too and capitals count as small."""
    table, separates = blank_separated()
    for i in range(128):
        table[i], separates[i] = ord(chr(i).lower()), not chr(i).isalnum()
    return table, separates


class Texts:
    """The words of a few texts.

    ``data`` are the bytes, ``edges[i]:edges[i + 1]`` those of text i; ``starts``
    and ``ends`` are the bytes of each word, ``first[i]:first[i + 1]`` the words
    of text i, ``doc`` the text of each word.
    """

    def __init__(self, data: np.ndarray, edges: np.ndarray, table: tuple[np.ndarray, np.ndarray] | None = None):
        self.data, self.edges, self.n = data, edges, len(edges) - 1
        self.table, separates = blank_separated() if table is None else table
        inside = ~separates[data]
        new = inside.copy()
        new[1:] &= ~inside[:-1]
        inner = edges[:-1][(edges[:-1] < len(data))]
        new[inner] = inside[inner]
        self.starts = np.flatnonzero(new)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        tails = edges[1:][edges[1:] > 0] - 1
        last[tails] = inside[tails]
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, edges)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.counts)

    def hashes(self, powers: Powers, seed: int = 0) -> np.ndarray:
        sums = running(byte_values(seed)[self.table][self.data], powers)
        return spans(sums, self.starts, self.ends, powers)

    def text(self, i: int) -> bytes:
        return self.data[self.edges[i]:self.edges[i + 1]].tobytes()


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without copying them; NULL counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    edges = edges[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[edges[0]:edges[-1]], edges - edges[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch between rows so that a piece holds about ``size`` bytes of text.

    A longer text is a piece by itself.
    """
    _, edges = bytes_of(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + size, side="right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def texts(batch: pa.RecordBatch, column: str, table: tuple[np.ndarray, np.ndarray] | None = None) -> Texts:
    return Texts(*bytes_of(batch.column(column)), table)


def windows(values: np.ndarray, powers: Powers, length: int) -> np.ndarray:
    """Hash of every window of ``length`` values, whatever it runs across."""
    if len(values) < length:
        return np.zeros(0, dtype=np.uint64)
    sums = running(values, powers)
    at = np.arange(len(values) - length + 1)
    return spans(sums, at, at + length, powers)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value in every window of ``width`` values.

    Values count by their upper 33 bits; the leftmost of equals is taken.  Running
    minima from both ends of blocks of ``width`` values give each window's.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    place = np.uint64((1 << 31) - 1)
    blocks = -(-len(values) // width)
    packed = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    packed[:len(values)] = (values & ~place) | np.arange(len(values), dtype=np.uint64)
    table = packed.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & place).astype(np.int64)
