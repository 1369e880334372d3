"""Words, lines and n-grams of whole Arrow batches as numpy arrays.

A batch of texts is one UTF-8 buffer.  Polynomial prefix hashes modulo 2^64 give
the hash of any byte range, and of any run of words, in constant time, so a task
needs no Python object per word.  Long ranges can collide by their construction
whatever the base (from some thousand units on), so they get a digest instead.  Work is done in slices of some megabytes of
whole documents, which bounds the memory of a task by its longest document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: White space of the word rule, bytes 0x20 and 0x09 to 0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

SLICE_BYTES = 1 << 18
#: Units from which a range is hashed by a digest.
LONG_RANGE = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16) * 5 // 4, base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n <= 8 * SLICE_BYTES:
            _powers[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection, so no two values fall together."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """Hashes of ranges of a sequence of integers."""

    def __init__(self, units: np.ndarray) -> None:
        n = len(units)
        self.units = units
        self.prefix = np.zeros(n + 1, np.uint64)
        terms = units.astype(np.uint64) + np.uint64(1)
        terms *= powers(_BASE, n)
        np.cumsum(terms, out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = self.prefix[end] - self.prefix[start]
        if len(found):
            found *= powers(_BASE_INVERSE, len(self.prefix))[start]
        found = mixed(found)
        for i in np.flatnonzero(end - start >= LONG_RANGE):
            unit = np.ascontiguousarray(self.units[start[i] : end[i]])
            found[i] = int.from_bytes(hashlib.blake2b(unit, digest_size=8).digest(), "little")
        return found

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n units from each position on, where there are n."""
        count = len(self.prefix) - n
        if count <= 0:
            return np.zeros(0, np.uint64)
        found = self.prefix[n:] - self.prefix[:count]
        found *= powers(_BASE_INVERSE, len(self.prefix))[:count]
        return mixed(found)


@dataclass
class Texts:
    """Texts of a slice: ``bytes`` holds text ``i`` from ``bounds[i]`` to ``bounds[i + 1]``."""

    rows: slice
    bytes: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def raw(self, i: int) -> memoryview:
        return memoryview(self.bytes[self.bounds[i] : self.bounds[i + 1]])


@dataclass
class Words:
    """Byte ranges and hashes of all words; those of text ``i`` are ``first[i]:first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and bounds of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a column in order, in slices of about ``size`` bytes."""
    flat, bounds = buffer_of(column)
    at, n = 0, len(bounds) - 1
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1
        to = min(max(to, at + 1), n)
        yield Texts(slice(at, to), flat[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


def words_of(texts: Texts, lower: bool = False) -> Words:
    """Words are runs of bytes other than white space; ``lower`` folds A-Z only."""
    data, bounds = texts.bytes, texts.bounds
    n = len(data)
    solid = ~WHITE[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    if lower:
        data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    return Words(start, end, RangeHash(data).of(start, end), np.searchsorted(start, bounds))


def windows(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start units of all runs of ``n`` units that stay in one text, and their text."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[:-1][text]
    return start, text


def covered(start: np.ndarray, length: int, n: int) -> np.ndarray:
    """Marks of the units that a run of ``length`` from any start covers."""
    steps = np.bincount(start, minlength=n + 1)
    steps -= np.bincount(np.minimum(start + length, n), minlength=n + 1)
    return np.cumsum(steps[:-1]) > 0


def salted(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts, to find repetitions inside one."""
    return mixed(hashes ^ mixed(text.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)))


def repeated(values: np.ndarray) -> np.ndarray:
    """Marks of the values that occur twice or more."""
    order = np.argsort(values)
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    marks = np.zeros(len(values), bool)
    marks[order[1:][same]] = True
    marks[order[:-1][same]] = True
    return marks


def totals(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` for each range between successive bounds."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return np.diff(sums[bounds])
