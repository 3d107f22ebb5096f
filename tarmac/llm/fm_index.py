"""FM-index of one shard of text: search phrases backward, locate by sampled positions.

The text is an integer sequence that ends in the only 0.  The index keeps the
Burrows-Wheeler transform in a wavelet matrix (one rank table per bit of the
alphabet) and every ``sample``-th suffix position.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Positions of all suffixes in order, by prefix doubling.

    The first sort packs as many symbols as fit into one 62-bit key; later
    rounds sort only the suffixes that are still tied.
    """
    n = len(text)
    bits = max(1, int(symbols - 1).bit_length())
    h = max(1, min(62 // bits, 16))
    key = np.zeros(n, np.int64)
    for j in range(h):
        key <<= bits
        key[: max(n - j, 0)] |= text[j:]
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = np.diff(key[order]) != 0
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        alone = new & np.append(new[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            return order
        tied = order[at]
        composite = rank[tied] * n + rank[tied + h]  # a tied suffix is longer than h
        by = np.argsort(composite, kind="stable")
        order[at], composite = tied[by], composite[by]
        first = np.ones(len(at), bool)
        first[1:] = np.diff(composite) != 0
        new[at] |= first
        rank[order[at]] = np.maximum.accumulate(np.where(first, at, 0))
        h *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int, sample: int = 16):
        order = suffix_array(text, symbols)
        self.n, self.sample = len(text), sample
        self.bwt = text[order - 1]
        # C[c]: suffixes that begin with a smaller symbol than c
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        kept = order % sample == 0
        self.sampled = kept
        self.sample_rank = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
        self.positions = order[kept].astype(np.int32)
        # wavelet matrix: ones[l][i] counts set bits of bit l before i, in that level's order
        self.levels: list[tuple[int, np.ndarray, int]] = []
        row, zero = self.bwt, np.zeros(symbols, np.int64)
        every = np.arange(symbols)
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            one = (row >> bit & 1).astype(bool)
            ones = np.concatenate([[0], np.cumsum(one)]).astype(np.int32)
            zeros = self.n - int(ones[-1])
            self.levels.append((bit, ones, zeros))
            zero = np.where(every >> bit & 1, zeros + ones[zero], zero - ones[zero])
            row = np.concatenate([row[~one], row[one]])
        self.start_of = zero  # where a symbol's run begins in the last level

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs in the transform before row i."""
        for bit, ones, zeros in self.levels:
            seen = ones[i]
            i = np.where(symbol >> bit & 1, zeros + seen, i - seen)
        return i - self.start_of[symbol]

    def search(self, symbols: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(phrase, first row, end row)`` of the phrases that occur; phrase i is the ``n`` symbols from ``starts[i]``."""
        alive = np.arange(len(starts))
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), self.n)
        for j in range(n - 1, -1, -1):
            c = symbols[starts[alive] + j]
            lo, hi = self.before[c] + self.rank(c, lo), self.before[c] + self.rank(c, hi)
            found = lo < hi
            alive, lo, hi = alive[found], lo[found], hi[found]
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back to a sampled row, count the steps."""
        out = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            here = self.sampled[rows]
            out[todo[here]] = self.positions[self.sample_rank[rows[here]]] + steps
            todo, rows = todo[~here], rows[~here]
            c = self.bwt[rows]
            rows = self.before[c] + self.rank(c, rows)
            steps += 1
        return out
