"""Log-frequency Bloom filter: quantised counts in one bit array.

Counts are quantised to levels (1, 2, 3 ... then geometric with ratio
``RATIO``).  A key of level l is inserted once for each level up to l; its
count is read back by probing level after level until one is absent, so an
error can only be an overestimate, one level with about the filter's
false-positive rate.  The array is cut into segments by the key's leading bits,
so that segments can be built apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tarmac.llm.tokens import mix

RATIO = 1.2


def _level_starts() -> np.ndarray:
    """The smallest count of each level; level 1 begins at 1."""
    starts = [1]
    while starts[-1] < 1 << 50:
        starts.append(max(starts[-1] + 1, int(np.ceil(starts[-1] * RATIO))))
    return np.array(starts, np.int64)


STARTS = _level_starts()
#: The count that a level stands for: its middle (level 0: none).
MIDDLE = np.concatenate([[0.0], (STARTS[:-1] + STARTS[1:] - 1) / 2, [float(STARTS[-1])]])


def level_of(count: np.ndarray) -> np.ndarray:
    return np.searchsorted(STARTS, count, "right")


def split_key(h: np.ndarray, segment_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of a 64-bit hash and the 32 bits after it, by which it is known there."""
    segment = (h >> np.uint64(63 - segment_bits)) >> np.uint64(1)
    return segment.astype(np.int64), (h << np.uint64(segment_bits)) >> np.uint64(32)


@dataclass
class CountFilter:
    segment_bits: int  # log2 of the number of segments
    bits: int  # log2 of the bits of one segment
    hashes: int
    data: np.ndarray | None = None  # all segments' bytes

    def _places(self, key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The first place of each key at a level, and the step to its next ones."""
        g = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))
        return g, (g >> np.uint64(32)) | np.uint64(1)

    def segment(self, key: np.ndarray, level: np.ndarray) -> bytes:
        """The bytes of a segment that holds the keys at their levels (0: not at all)."""
        bits = np.zeros(1 << self.bits, bool)
        mask = np.uint64((1 << self.bits) - 1)
        for j in range(1, int(level.max(initial=0)) + 1):
            key, level = key[level >= j], level[level >= j]
            place, step = self._places(key, j)
            for _ in range(self.hashes):
                bits[place & mask] = True
                place += step
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, key: np.ndarray, base: np.ndarray | int = 0) -> np.ndarray:
        """The level of each key of the segment that begins at bit ``base``, 0 if the filter doesn't hold it."""
        base = np.broadcast_to(np.asarray(base, np.uint64), key.shape)
        level = np.zeros(len(key), np.int64)
        mask = np.uint64((1 << self.bits) - 1)
        alive, j = np.arange(len(key)), 1
        while len(alive) and j < len(MIDDLE):
            place, step = self._places(key[alive], j)
            for _ in range(self.hashes):  # a key that one probe misses isn't probed on
                at = base[alive] + (place & mask)
                held = (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                alive, place, step = alive[held], place[held], step[held]
                place += step
            level[alive] = j
            j += 1
        return level

    def counts(self, h: np.ndarray) -> np.ndarray:
        """The count that each hash's level stands for, 0 if the filter doesn't hold it."""
        segment, key = split_key(h, self.segment_bits)
        return MIDDLE[self.levels(key, segment << self.bits)]
