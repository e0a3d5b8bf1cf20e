"""Word hashes of Arrow text columns, vectorised over bytes.

Every word gets a 64-bit hash: a polynomial over its bytes, read off one
running sum per slice of text, and a final mix. Texts are taken in slices of
bounded size, so memory does not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

#: The white space of the word contract.
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    done = 1
    while done < count:
        step = min(done, count - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


class Alphabet:
    """Which bytes separate words, and the value of every other byte (A-Z count as a-z)."""

    def __init__(self, separators: bytes = SPACES, seed: int = 0) -> None:
        self.apart = np.zeros(256, bool)
        self.apart[list(separators)] = True
        lower = np.arange(256)
        lower[65:91] += 32
        self.value = mix(lower.astype(np.uint64) + np.uint64((seed * 1_000_003 + 12_345) & _MASK))
        self._up = _powers(_BASE, 1 << 12)
        self._down = _powers(_BASE_INVERSE, 1 << 12)

    def _tables(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > len(self._up):
            size = 1 << (size - 1).bit_length()
            self._up, self._down = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
        return self._up, self._down

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of every word; a word never runs from one text into the next."""
        inside = ~self.apart[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[0] = edge[-1] = True
        cut = offsets[(offsets > 0) & (offsets < len(data))]
        edge[cut] = True
        at = np.flatnonzero(edge)
        begin, end = at[:-1], at[1:]
        keep = inside[begin]
        return begin[keep], end[keep]

    def hashes(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(begin), np.uint64)
        first = 0
        while first < len(begin):  # a very long text goes in pieces
            last = max(first + 1, int(np.searchsorted(end, begin[first] + SLICE_BYTES, "right")))
            low, high = int(begin[first]), int(end[last - 1])
            up, down = self._tables(high - low + 1)
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(self.value[data[low:high]] * up[: high - low], out=total[1:])
            b, e = begin[first:last] - low, end[first:last] - low
            out[first:last] = (total[e] - total[b]) * down[b]
            first = last
        return mix(out)


class Words(NamedTuple):
    """Words of a slice of rows: row r has those from first[r] to first[r + 1]."""

    rows: slice
    hashes: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows in runs of at most limit bytes (one row if it is longer), with their bytes and offsets; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    count = len(column)
    if not count:
        return
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, np.int64, count + 1, column.offset * 8)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < count:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, count)
        low, high = int(offsets[first]), int(offsets[last])
        yield slice(first, last), data[low:high], offsets[first : last + 1] - low
        first = last


def words(column: pa.Array, alphabet: Alphabet) -> Iterator[Words]:
    for rows, data, offsets in text_slices(column):
        if len(data):
            begin, end = alphabet.spans(data, offsets)
            first = np.searchsorted(begin, offsets)
            yield Words(rows, alphabet.hashes(data, begin, end), first, begin, end, data, offsets)
        else:
            none = np.zeros(0, np.int64)
            yield Words(rows, none.astype(np.uint64), np.zeros(len(offsets), np.int64), none, none, data, offsets)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive hash of each run of size words; empty when there are fewer."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    factor = 1
    for k in range(size):
        factor = factor * 0xD1342543DE82EF95 & _MASK
        total += hashes[k : k + count] * np.uint64(factor)
    return mix(total + np.uint64(size))


class Runs:
    """Running hashes of one text's words: one pass of prefix sums, then a run of any length costs one subtraction."""

    def __init__(self, hashes: np.ndarray) -> None:
        up, self.down = _powers(_BASE, len(hashes)), _powers(_BASE_INVERSE, len(hashes))
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)))

    def of(self, begin: np.ndarray, size: int) -> np.ndarray:
        """Order-sensitive hash of the run of size words from each of begin."""
        return (self.total[begin + size] - self.total[begin]) * self.down[begin]


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct size-word shingles of one text; fewer words make one shingle of them all."""
    count = len(hashes)
    if not count:
        return hashes
    return np.unique(grams(hashes, min(size, count)))


def free_name(table: DataFrame, name: str) -> str:
    """name, with underscores in front until table has no such column (names differ by more than case)."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
