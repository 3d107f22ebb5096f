"""Patched frame-of-reference coding of unsigned 32-bit integers.

A segment is (little-endian): the magic ``PFR1``, the block length, the number
of integers and of blocks (u32, u64, u32); per block its minimum (u32), width
(u8), number of exceptions (u32) and start in the payload (u64); the payload.
A block's payload is its values less the minimum, packed at ``width`` bits, the
positions (u16) and values less the minimum (u32) of its exceptions.  The width
is what the given percentile of the block's values needs; wider values are
exceptions, packed as 0.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"PFR1"
BLOCK = 1024
PERCENTILE = 0.95
_HEAD = struct.Struct("<4sIQI")


def _pack(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width], bitorder="little").tobytes()


def _unpack(raw: np.ndarray, n: int, width: int) -> np.ndarray:
    bits = np.zeros((n, 32), np.uint8)
    if width:
        bits[:, :width] = np.unpackbits(raw, count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def encode(values: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """A segment that holds ``values``."""
    if not 0 < block <= 1 << 16:
        raise ValueError("a block has 1 to 65536 values")
    least, width, wrong, start, payload, at = [], [], [], [], [], 0
    for lo in range(0, len(values), block):
        part = values[lo : lo + block].astype(np.uint32)
        low = part.min()
        part = part - low
        k = min(int(len(part) * percentile), len(part) - 1)
        bits = int(np.partition(part, k)[k]).bit_length()
        over = np.flatnonzero(part >> np.uint32(bits)) if bits < 32 else np.zeros(0, np.int64)
        patched = part.copy()
        patched[over] = 0
        data = _pack(patched, bits) + over.astype("<u2").tobytes() + part[over].astype("<u4").tobytes()
        for column, x in ((least, low), (width, bits), (wrong, len(over)), (start, at), (payload, data)):
            column.append(x)
        at += len(data)
    head = _HEAD.pack(MAGIC, block, len(values), len(least))
    index = [np.array(x, t).tobytes() for x, t in ((least, "<u4"), (width, "u1"), (wrong, "<u4"), (start, "<u8"))]
    return b"".join([head, *index, *payload])


class Segment:
    """Reads a segment; ``block(i)`` decodes one block by the index of block starts."""

    def __init__(self, raw: bytes):
        magic, self.length, self.n, blocks = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a PFR1 segment")
        at = _HEAD.size
        columns = []
        for kind in ("<u4", "u1", "<u4", "<u8"):
            columns.append(np.frombuffer(raw, kind, blocks, at))
            at += columns[-1].nbytes
        self.least, self.width, self.wrong, self.start = columns
        self.payload = np.frombuffer(raw, np.uint8, offset=at)

    def block(self, i: int) -> np.ndarray:
        n = min(self.length, self.n - i * self.length)
        width, wrong, at = int(self.width[i]), int(self.wrong[i]), int(self.start[i])
        end = at + -(-n * width // 8)
        values = _unpack(self.payload[at:end], n, width)
        places = self.payload[end : end + 2 * wrong].copy().view("<u2")
        values[places] = self.payload[end + 2 * wrong : end + 6 * wrong].copy().view("<u4")
        return values + self.least[i]

    def all(self) -> np.ndarray:
        return np.concatenate([self.block(i) for i in range(len(self.start))]) if len(self.start) else np.zeros(0, np.uint32)
