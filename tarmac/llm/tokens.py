"""Words of Arrow text columns as numpy arrays, with no Python object per word.

A word is a maximal run of bytes that a 256-entry table marks; both tables
below keep every byte of a multi-byte UTF-8 character inside words, so a run
of bytes is also a run of code points.  Each word is represented by a 64-bit
hash of its (ASCII lower-cased) bytes; two different words share a hash with a
probability of about 2**-60.  Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of words ``[^\x20\x09-\x0D]+``.
SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower-cased.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True

_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 32
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_HASHED_AT_ONCE = 1 << 14
_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.full(max(n, 256), _BASE)
        _powers[0] = 1
        _powers = np.cumprod(_powers)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-dependent hash of a pair of hashes."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


@dataclass
class Words:
    """Words of consecutive texts: ``hash[first[i]:first[i + 1]]`` are text i's.

    ``start`` and ``end`` are byte positions in ``data``; ``text_start`` holds
    the byte position at which each text begins (one more for the last end).
    """

    data: np.ndarray
    text_start: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each text's start (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words(data: np.ndarray, text_start: np.ndarray, table: np.ndarray = SPACE_SEPARATED, lower: bool = True) -> Words:
    """All words of the texts that ``data[text_start[i]:text_start[i + 1]]`` hold."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[text_start] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, text_start)
    if not len(start):
        return Words(data, text_start, start, end, np.zeros(0, np.uint64), first)
    byte_hash = _BYTE_LOWER if lower else _BYTE
    powers = _power_table(int((end - start).max()))
    hashes = np.empty(len(start), np.uint64)
    for lo in range(0, len(start), _HASHED_AT_ONCE):  # bounds the scratch arrays of a very long text
        s, e = start[lo : lo + _HASHED_AT_ONCE], end[lo : lo + _HASHED_AT_ONCE]
        length = e - s
        at = np.cumsum(length) - length
        place = np.arange(at[-1] + length[-1]) - np.repeat(at, length)
        letters = data[s[0] : e[-1]][inside[s[0] : e[-1]]]
        hashes[lo : lo + len(s)] = np.add.reduceat(byte_hash[letters] * powers[place], at)
    return Words(data, text_start, start, end, mix(hashes), first)


def slices(text_start: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of at most ``max_bytes`` bytes, or one longer text."""
    n, lo = len(text_start) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(text_start, text_start[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def words_by_slice(
    column: pa.Array, table: np.ndarray = SPACE_SEPARATED, lower: bool = True, max_bytes: int = 1 << 20
) -> Iterator[tuple[int, int, Words]]:
    """``(lo, hi, words)`` of texts lo..hi-1, about ``max_bytes`` at a time."""
    data, text_start = text_bytes(column)
    for lo, hi in slices(text_start, max_bytes):
        at = text_start[lo : hi + 1]
        yield lo, hi, words(data[at[0] : at[-1]], at - at[0], table, lower)


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every n consecutive words inside one text, and their first word's index."""
    if len(w.hash) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.repeat(w.first[1:], w.counts)
    at = np.flatnonzero(np.arange(len(w.hash)) + n <= last)
    h = w.hash[at]
    for j in range(1, n):
        h = combine(h, w.hash[at + j])
    return h, at
