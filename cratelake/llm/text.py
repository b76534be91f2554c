"""Texts as flat byte arrays: words, hashes and shingles of many texts in a few numpy calls.

Texts are handled in slices of a bounded number of bytes; a single text longer than that is a
slice of its own, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20
SHINGLE = 5

# White space between words, as the contracts state it.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Letters A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, hence with an inverse modulo 2^64
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = np.random.default_rng(8).integers(1, 2**63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2^64 for i below n, kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, SLICE_BYTES), base, np.uint64)
        known[:1] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[ends[0]:ends[-1]] if body else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def slices(
    batch: pa.RecordBatch, text: str, budget: int = SLICE_BYTES, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Consecutive rows, ``rows`` at most if given, with at most ``budget`` bytes of text, or one row that has more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + budget, "right")))
        if rows:
            to = min(to, at + rows)
        yield batch.slice(at, to - at)
        at = to


@functools.lru_cache(1)
def _trim() -> Callable[[int], int] | None:
    """The C library's own way to return free memory; other libraries have none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return memory that was freed to the system. A Python worker lives on between tasks and stages, and what
    its allocators keep counts against its executor while others work."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def map_slices(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str, text: str = "text",
    rows: int | None = None,
) -> DataFrame:
    """``fn`` on each slice of each batch, of ``rows`` rows at most if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, rows=rows):
                yield fn(part)
            give_back()

    return df.mapInArrow(run, schema)


class Words:
    """Where the words of flat texts begin and end; ``first[d]`` is document d's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE):
        inside = ~gap[data]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        before[heads] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[heads[heads > 0] - 1] = False
        self.data, self.offsets = data, offsets
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, ends: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its bytes before ``ends``."""
        n = len(self.data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * powers(_BASE, n), out=total[1:])
        ends = self.ends if ends is None else ends
        return mix((total[ends] - total[self.starts]) * powers(pow(_BASE, -1, 2**64), n + 1)[self.starts])


def windows(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of each run of ``size`` consecutive words, documents disregarded."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += hashes[i:i + n] * _STEP[i]
    return mix(total)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document, by document, and their number per document.

    A document with fewer than five words has one shingle, all its words; one without words
    has none.
    """
    hashes, owner = words.hashes(), words.documents()
    values = windows(hashes)
    whole = owner[:len(values)] == owner[len(owner) - len(values):] if len(values) else np.zeros(0, bool)
    values, owners = values[whole], owner[:len(values)][whole]
    few = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(few):
        short = [
            int((hashes[a:b] * _STEP[:b - a]).sum(dtype=np.uint64)) + int(b - a)
            for a, b in zip(words.first[few], words.first[few + 1])
        ]
        values = np.concatenate([values, mix(np.array([x % 2**64 for x in short], np.uint64))])
        owners = np.concatenate([owners, few])
        order = np.argsort(owners, kind="stable")
        values, owners = values[order], owners[order]
    _, at = np.unique(mix(values ^ mix(owners.astype(np.uint64))), return_index=True)
    at.sort()
    return values[at], np.bincount(owners[at], minlength=len(words.counts))
